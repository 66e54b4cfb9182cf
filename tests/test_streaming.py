import os
import time

from cantora.sources.landed import read_lyrics
from cantora.streaming import incremental
from tests.landed_fixture import write_text


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return [p for p in query.recentProgress if p["numInputRows"] > 0]


def test_stream_equals_batch_and_reruns_do_nothing(spark, tmp_path):
    root, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    for i in range(5):
        write_text(root / "Art" / "Alb" / f"Song {i}.txt", f"Song Lyrics\nlove number {i}\n")
    stream = incremental.lyrics_stream(spark, str(root))
    assert finish(incremental.append_new_files(stream, out, check))
    batch = sorted(map(str, incremental.enriched(read_lyrics(spark, str(root))).collect()))
    assert sorted(map(str, spark.read.parquet(out).collect())) == batch and len(batch) == 5

    assert finish(incremental.append_new_files(incremental.lyrics_stream(spark, str(root)), out, check)) == []
    write_text(root / "Art" / "Alb" / "New.txt", "fresh")
    finish(incremental.append_new_files(incremental.lyrics_stream(spark, str(root)), out, check))
    assert spark.read.parquet(out).count() == 6


def test_late_files_are_ingested(spark, tmp_path):
    root, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    write_text(root / "Art" / "Alb" / "a.txt", "one")
    finish(incremental.append_new_files(incremental.lyrics_stream(spark, str(root)), out, check))
    write_text(root / "Art" / "Alb" / "old.txt", "restored")
    long_ago = time.time() - 400 * 86_400
    os.utime(root / "Art" / "Alb" / "old.txt", (long_ago, long_ago))
    finish(incremental.append_new_files(incremental.lyrics_stream(spark, str(root)), out, check))
    assert spark.read.parquet(out).count() == 2


def test_upsert_takes_new_late_and_changed_files(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    album = root / "Art" / "Alb"
    for name, text in (("a", "one"), ("b [x], {y}", "two"), ("c", "three")):
        write_text(album / f"{name}.txt", text)
    assert incremental.upsert_files(spark, str(root), out) == 3
    assert incremental.upsert_files(spark, str(root), out) == 0
    write_text(album / "a.txt", "changed")
    os.utime(album / "a.txt", (time.time() + 5,) * 2)
    write_text(album / "late.txt", "late")
    os.utime(album / "late.txt", (1_000_000_000,) * 2)
    assert incremental.upsert_files(spark, str(root), out) == 2
    now = incremental.current(spark, out)
    assert sorted((r.title, r.text) for r in now.collect()) == [("a", "changed"), ("b [x], {y}", "two"), ("c", "three"), ("late", "late")]
