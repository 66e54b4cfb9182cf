import os
import time

import pytest
from pyspark.sql import functions as F

from cantora.operators import wordfreq
from cantora.plans.refresh import LyricsMarts
from cantora.sources import partitioned
from cantora.streaming import incremental
from tests.landed_fixture import write_text

DDL = "track_id long, album_id long, text string, deleted boolean, modified int"


def lyrics(spark, texts):
    return spark.createDataFrame([(t, a, x) for t, (a, x) in texts.items()], "track_id long, album_id long, text string")


def files_of(root):
    return {os.path.join(d, n) for t in ("lyrics", "words_track", "words_album") for d, _, ns in os.walk(f"{root}/{t}") for n in ns if n.startswith("part-")}


def content(marts, spark):
    return {t: sorted(map(tuple, marts.read(spark, t).select(*sorted(marts.read(spark, t).columns)).collect()), key=str)
            for t in ("lyrics", "words_track", "words_album")}


def texts_at_first():
    return {t: (t % 7, f"love song number{t} river river w{t % 5}") for t in range(60)}


def test_changes_equal_a_rebuild_and_rewrite_only_their_partitions(spark, tmp_path):
    texts = texts_at_first()
    marts = LyricsMarts(str(tmp_path / "marts"), parts=64)
    marts.build(lyrics(spark, texts))
    before = files_of(marts.root)
    changes = [
        (3, 3, "rain", False, 1), (3, 3, "river rain rain", False, 2),  # the later one counts
        (10, 5, texts[10][1], False, 1),  # moved to another album
        (20, 6, None, True, 1), (999, 1, None, True, 1),  # gone, and never there
        (100, 50, "brand new album", False, 1), (21, 0, None, False, 1),
    ]
    rows = spark.createDataFrame(changes, DDL)
    marts.apply(rows)
    texts |= {3: (3, "river rain rain"), 10: (5, texts[10][1]), 100: (50, "brand new album"), 21: (0, None)}
    del texts[20]
    other = LyricsMarts(str(tmp_path / "other"), parts=64)
    other.build(lyrics(spark, texts))
    assert content(marts, spark) == content(other, spark)

    touched = set(marts.tables.touched(rows, "lyrics"))
    rewritten = {int(f.split("part=")[1].split("/")[0]) for f in before - files_of(marts.root) if "/lyrics/" in f}
    assert rewritten and rewritten <= touched and len(touched) < 10

    state = content(marts, spark)
    marts.apply(rows)  # once more
    assert content(marts, spark) == state
    marts.apply(rows.limit(0))
    assert content(marts, spark) == state


def test_album_that_loses_its_last_words_is_gone(spark, tmp_path):
    marts = LyricsMarts(str(tmp_path / "marts"), parts=16)
    marts.build(lyrics(spark, {1: (1, "only words"), 2: (2, "other words")}))
    marts.apply(spark.createDataFrame([(1, 1, None, True, 1)], DDL))
    assert {r["album_id"] for r in marts.read(spark, "words_album").collect()} == {2}
    assert {r["track_id"] for r in marts.read(spark, "lyrics").collect()} == {2}


@pytest.mark.parametrize("complete", [True, False])
def test_stopped_replacement_is_finished_or_dropped(spark, tmp_path, monkeypatch, complete):
    marts = LyricsMarts(str(tmp_path / "marts"), parts=8)
    marts.build(lyrics(spark, texts_at_first()))
    state = content(marts, spark)
    rows = spark.createDataFrame([(1, 1, "quite different", False, 1)], DDL)
    with monkeypatch.context() as m:
        m.setattr(partitioned.PartitionedTables, "recover", lambda self, spark: None)
        marts.apply(rows)
    if not complete:
        partitioned.delete(spark, f"{marts.root}/next/plan")
    marts.tables.recover(spark)
    assert (content(marts, spark) != state) == complete
    marts.apply(rows)
    assert ("different", 1) in {(r["word"], r["count"]) for r in marts.read(spark, "words_track").where("track_id = 1").collect()}


def test_pending_metrics_rewrite_only_their_partitions(spark, tmp_path):
    marts = LyricsMarts(str(tmp_path / "marts"), parts=32)
    marts.build(lyrics(spark, texts_at_first()))
    state = content(marts, spark)
    assert marts.refresh_pending(spark) == 0
    touched = marts.tables.touched(spark.range(5, 7).withColumnRenamed("id", "track_id"), "lyrics")
    stale = marts.tables.read(spark, "lyrics", touched).withColumns({
        c: F.when(F.col("track_id").isin(5, 6), None).otherwise(F.col(c)) for c in ("word_count", "metrics_version")})
    marts.tables.replace(spark, {"lyrics": (stale, touched)})
    before = files_of(marts.root)
    assert marts.refresh_pending(spark) == len(touched) < 32
    assert content(marts, spark) == state
    assert {int(f.split("part=")[1].split("/")[0]) for f in before - files_of(marts.root)} == set(touched)


def test_files_new_changed_and_deleted(spark, tmp_path):
    """After every kind of change the word tables equal a recount of the files."""
    root, marts = tmp_path / "in", LyricsMarts(str(tmp_path / "marts"), parts=8)
    album = root / "Art" / "Alb"
    for name in "abc":
        write_text(album / f"{name}.txt", f"love river {name}{name} song")
    empty = spark.createDataFrame([], "path string, modified timestamp")
    marts.build(incremental.file_changes(spark, str(root), empty).select("track_id", "album_id", "text"))
    ledger = spark.createDataFrame(incremental.listed(spark, str(root)).collect(), "path string, modified timestamp")
    write_text(album / "a.txt", "rain rain")
    os.utime(album / "a.txt", (time.time() + 5,) * 2)
    os.remove(album / "b.txt")
    write_text(root / "Art" / "New, [x]" / "d.txt", "late love")
    os.utime(root / "Art" / "New, [x]" / "d.txt", (1_000_000_000,) * 2)
    changes = incremental.file_changes(spark, str(root), ledger)
    assert changes.count() == 3
    marts.apply(changes)
    whole = incremental.file_changes(spark, str(root), empty)
    per_track = wordfreq.track_words(whole)
    assert sorted(map(tuple, marts.read(spark, "words_track").select("track_id", "word", "count").collect())) == sorted(map(tuple, per_track.collect()))
    per_album = per_track.join(whole.select("track_id", "album_id"), "track_id").groupBy("album_id", "word").agg(F.sum("count").alias("count"))
    assert sorted(map(tuple, marts.read(spark, "words_album").select("album_id", "word", "count").collect())) == sorted(map(tuple, per_album.collect()))


def test_stream_of_changes(spark, tmp_path):
    marts = LyricsMarts(str(tmp_path / "marts"), parts=8)
    texts = texts_at_first()
    marts.build(lyrics(spark, texts))
    landing = str(tmp_path / "changes")
    for row in ((1, 2, "rain", False, 1), (2, 2, None, True, 1)):
        spark.createDataFrame([row], DDL).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(landing)
    query = incremental.maintain(stream, marts, str(tmp_path / "check"))
    query.awaitTermination(120)
    assert query.exception() is None
    texts[1] = (2, "rain")
    del texts[2]
    other = LyricsMarts(str(tmp_path / "other"), parts=8)
    other.build(lyrics(spark, texts))
    assert content(marts, spark) == content(other, spark)


def test_sync_finds_the_changes_itself(spark, tmp_path):
    texts = texts_at_first()
    marts = LyricsMarts(str(tmp_path / "marts"), parts=64)
    assert marts.sync(lyrics(spark, texts)) == 60
    before = files_of(marts.root)
    assert marts.sync(lyrics(spark, texts)) == 0 and files_of(marts.root) == before
    texts |= {4: (4, "rain"), 9: (1, texts[9][1]), 200: (3, None)}
    del texts[30]
    assert marts.sync(lyrics(spark, texts)) == 4
    other = LyricsMarts(str(tmp_path / "other"), parts=64)
    other.build(lyrics(spark, texts))
    assert content(marts, spark) == content(other, spark)
    assert len(before - files_of(marts.root)) < len(before) / 3


def test_words_of_a_track_are_counted_without_a_shuffle(spark):
    texts = {1: (1, "river rain river the River"), 2: (1, None), 3: (2, ""), 4: (2, "the of"), 5: (2, "don't stop, don't\nstop now")}
    rows = lyrics(spark, texts)
    got = wordfreq.unpacked_counts(wordfreq.packed_counts(rows.drop("album_id")))
    want = wordfreq.track_words(rows)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.schema.simpleString() == want.schema.simpleString()
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_new_contents_are_written_once(spark, tmp_path, monkeypatch):
    """What has been written aside takes its place as it is."""
    marts = LyricsMarts(str(tmp_path / "marts"), parts=8)
    marts.build(lyrics(spark, texts_at_first()))
    rows = spark.createDataFrame([(1, 1, "quite different", False, 1)], DDL)
    with monkeypatch.context() as m:
        m.setattr(partitioned.PartitionedTables, "recover", lambda self, spark: None)
        marts.apply(rows)
    aside = {n for d, _, ns in os.walk(f"{marts.root}/next") if "part=" in d for n in ns if n.startswith("part-")}
    marts.tables.recover(spark)
    assert aside and aside <= {os.path.basename(f) for f in files_of(marts.root)}


def test_a_text_is_split_once(spark, tmp_path, monkeypatch):
    """The words of a text serve the table of tracks and that of albums."""
    calls, packed = [], wordfreq.packed_counts
    monkeypatch.setattr(wordfreq, "packed_counts", lambda *a, **k: calls.append(1) or packed(*a, **k))
    marts = LyricsMarts(str(tmp_path / "marts"), parts=8)
    marts.build(lyrics(spark, texts_at_first()))
    assert len(calls) == 1
    marts.apply(spark.createDataFrame([(1, 1, "quite different", False, 1)], DDL))
    assert len(calls) == 2


def test_albums_without_changes_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Only rows of altered albums, those without an id among them, go through the sums."""
    marts = LyricsMarts(str(tmp_path / "marts"), parts=2)
    texts = texts_at_first() | {70: (None, "without album"), 71: (None, "without love")}
    marts.build(lyrics(spark, texts))
    seen, summed = [], partitioned.PartitionedTables.summed
    with monkeypatch.context() as m:
        m.setattr(partitioned.PartitionedTables, "summed", lambda self, rows, *a: seen.append(rows.select("album_id").distinct().collect()) or summed(self, rows, *a))
        marts.apply(spark.createDataFrame([(71, None, "without rain", False, 1), (3, 3, "rain", False, 1)], DDL))
    assert {r["album_id"] for r in seen[0]} == {None, 3}
    texts |= {71: (None, "without rain"), 3: (3, "rain")}
    other = LyricsMarts(str(tmp_path / "other"), parts=2)
    other.build(lyrics(spark, texts))
    assert content(marts, spark) == content(other, spark)
