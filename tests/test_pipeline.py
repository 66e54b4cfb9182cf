import datetime

import pytest

from cantora.operators import loading
from cantora.plans import catalog, pipeline
from cantora.plans.tables import StoredModel
from cantora.schemas import RULES, TABLES
from cantora.sources import landed, sinks
from tests import landed_fixture

DB = "music"


@pytest.fixture(scope="module")
def landed_tree(tmp_path_factory):
    return landed_fixture.build(tmp_path_factory.mktemp("landed"))


@pytest.fixture(scope="module")
def layout(landed_tree, tmp_path_factory):
    t = landed_tree
    return pipeline.Layout(t["catalog"], t["lyrics"], t["profiles"], str(tmp_path_factory.mktemp("stages")))


@pytest.fixture(scope="module")
def model(spark, layout):
    pipeline.run(spark, layout, DB)
    return StoredModel(spark, DB)


def test_readers_decode_paths_and_number_rows(spark, landed_tree):
    rows = landed.read_tracks(spark, landed_tree["catalog"]).collect()
    first = sorted((r.row_no, r.Name) for r in rows if r.album_dir == "First")
    assert first == [(1, "Don't Go, \"Now\""), (2, "Love Story"), (3, "Silence"), (4, "Love Story"), (5, None)]
    assert {r.artist_dir for r in rows} == {landed_tree["ada"], landed_tree["bo"]}
    files = {(r.artist_dir, r.album_dir, r.title) for r in landed.read_lyrics(spark, landed_tree["lyrics"]).collect()}
    assert (landed_tree["bo"], "Second", "Rio") in files and len(files) == 6


def test_tables(spark, model, landed_tree):
    artists = {r.name: r for r in model.artists().collect()}
    assert set(artists) == {landed_tree["ada"], landed_tree["bo"], "Solo"}
    ada, bo, solo = artists[landed_tree["ada"]], artists[landed_tree["bo"]], artists["Solo"]
    assert (ada.genres, ada.country, ada.followers, ada.popularity, ada.birth_date, ada.active_years) == ("folk, pop", "DE", 5000000000, 0, None, 1990)
    assert (bo.genres, bo.followers, bo.popularity) == ("", 0, 7)
    assert solo.birth_date == datetime.date(1970, 2, 3)

    albums = {r.name: r for r in model.albums().collect()}
    assert set(albums) == {"First", "Second"}, "Alive is excluded, Half is incomplete"
    assert albums["First"].release_date == datetime.date(2014, 10, 1)
    assert (albums["Second"].release_date, albums["Second"].popularity) == (datetime.date(1962, 1, 1), 0)
    assert albums["First"].artist_id == ada.id

    tracks = {(r.name, r.album_id): r for r in model.tracks().collect()}
    assert len(tracks) == 6 == model.tracks().count()
    love = tracks["Love Story", albums["First"].id]
    assert (love.track_number, love.duration_ms, love.explicit) == (2, 2000, True), "the first of two equal names stays"
    dont = tracks["Don't Go, \"Now\"", albums["First"].id]
    assert (dont.popularity, dont.explicit) == (0, False)
    assert tracks["Silence", albums["First"].id].explicit is None


def test_lyrics_and_metrics(spark, model):
    names = {r.id: r.name for r in model.tracks().collect()}
    texts = {}
    for r in model.lyrics().collect():
        texts.setdefault(names[r.track_id], []).append(r)
    assert texts["Don't Go, \"Now\""][0].text == "stay with me\nI love it\n"
    assert texts["Empty"][0].text == "" and texts["Río"][0].text == "agua\n"
    assert texts["Silence"][0].text == "" and texts["Silence"][0].readability_score is None
    assert sorted(t.text for t in texts["Love Story"]) == ["hate, hate, \"terrible\" story\n", "no marker, love love story\nend"]
    row = next(t for t in texts["Love Story"] if t.text.startswith("hate"))
    assert (row.word_count, row.line_count, row.char_count) == (4, 2, len(row.text)) and row.sentiment_score < 0
    assert all(r.metrics_version == 1 for rows in texts.values() for r in rows)


def test_word_tables_add_up(model):
    per_track = model.track_words().collect()
    albums = {r.id: r.album_id for r in model.tracks().collect()}
    total = {}
    for r in per_track:
        key = (albums[r.track_id], r.word)
        total[key] = total.get(key, 0) + r["count"]
    assert {(r.album_id, r.word): r["count"] for r in model.album_words().collect()} == total
    assert ("hate", 2) in {(r.word, r["count"]) for r in per_track}


def test_integrity(model):
    tables = {name: model._table(name) for name in TABLES}
    assert all(r.violations == 0 for r in loading.violations(tables, RULES).collect())


def test_rerun_changes_nothing(spark, model, layout):
    before = {t: sorted(map(str, model._table(t).collect())) for t in TABLES}
    pipeline.run(spark, layout, DB)
    assert {t: sorted(map(str, StoredModel(spark, DB)._table(t).collect())) for t in TABLES} == before


def test_audits(spark, model, layout, landed_tree):
    out = layout.stages
    failed = {(r.artist, r.album, r.line) for r in spark.read.parquet(f"{out}/audit/failed_albums").collect()}
    assert failed == {(landed_tree["ada"], "First", f"{landed_tree['ada']}|||First")}
    outcomes = {(r.outcome, r.line) for r in spark.read.parquet(f"{out}/audit/matches").collect()}
    assert ("missing", "Silence") in outcomes and ("matched", "Love Story --> Love Story (Long Version).txt") in outcomes
    assert ("matched", "Río --> Rio.txt") in outcomes
    missing = {(r.album, r.song) for r in spark.read.parquet(f"{out}/audit/failed_lyrics").collect()}
    assert missing == {("First", "Silence"), ("Second", "Empty")}
    assert {r.album_dir for r in spark.read.parquet(f"{out}/audit/skipped_albums").collect()} == {"Alive"}


def test_canned_analyses_run_on_stored_tables(model, landed_tree):
    ada = landed_tree["ada"]
    frames = [
        catalog.all_artists(model), catalog.artists_like(model, "ada"), catalog.artist_genres(model), catalog.albums_of_artist(model, ada),
        catalog.albums_by_popularity(model), catalog.unique_words_per_album(model), catalog.tracks_of_album(model, "First"),
        catalog.explicit_songs_per_artist(model), catalog.longest_tracks(model), catalog.lyrics_of_track(model, "Love Story"),
        catalog.lyrics_of_album(model, "First"), catalog.top_by_metric(model, "line_count"), catalog.top_by_metric(model, "word_count"),
        catalog.hard_to_read(model, 200), catalog.top_by_metric(model, "lexical_density"), catalog.density_per_album(model),
        catalog.ranked_albums(model), catalog.density_per_artist(model), catalog.readability_per_album(model),
        catalog.sentiment_extremes(model), catalog.sentiment_extremes(model, False), catalog.top_words_of_track(model, "Love Story"),
        catalog.top_words_of_album(model, ada, "First"), catalog.top_words_of_artist(model, ada), catalog.compare_artists(model, [ada]),
        catalog.motifs_by_album(model, ["love", "hate"]), catalog.sentiment_by_year(model), catalog.explicit_share_by_year(model),
    ]
    assert all(f.count() > 0 for f in frames)
    assert [r.track for r in catalog.lyrics_of_album(model, "First").collect()] == ["Don't Go, \"Now\"", "Love Story", "Silence"]


def test_bucketed_model_equals_the_plain_one_and_joins_without_a_shuffle(spark, model, layout, landed_tree, tmp_path):
    own = pipeline.Layout(layout.catalog, layout.lyrics, layout.profiles, str(tmp_path))
    pipeline.run(spark, own, "bucketed", buckets=3)
    bucketed = StoredModel(spark, "bucketed")
    for t in TABLES:
        assert sorted(map(str, bucketed._table(t).collect())) == sorted(map(str, model._table(t).collect())), t
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        joined = bucketed.track_words().join(bucketed.tracks().withColumnRenamed("id", "track_id"), "track_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)


def test_create_is_idempotent_and_drop_needs_confirmation(spark):
    sinks.create_tables(spark, "scratch")
    sinks.create_tables(spark, "scratch")
    with pytest.raises(ValueError):
        sinks.drop_tables(spark, "scratch")
    sinks.drop_tables(spark, "scratch", confirm=True)
    assert spark.catalog.listTables("scratch") == []


def test_csv_export_round_trip(spark, tmp_path):
    rows = [("S", "1", "True", "2", "A", "2000-01-01", "3", "u", 'line "one"\nline two, x\n'), ("T", "1", None, "2", "A", None, "3", "u", None)]
    from cantora.schemas import FINAL_CSV

    target = tmp_path / "export" / "Art" / "Alb" / "Alb_final.csv"
    sinks.export_csv(spark.createDataFrame(rows, FINAL_CSV).coalesce(1), str(target))
    back = spark.read.schema(FINAL_CSV).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').csv(str(target))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_append_new_never_overwrites(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_new(spark.createDataFrame([("a", 1)], "path string, v int"), path, ["path"])
    sinks.append_new(spark.createDataFrame([("a", 2), ("b", 3)], "path string, v int"), path, ["path"])
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 3)}


@pytest.mark.parametrize("crash_after", ["DROP TABLE IF EXISTS crash.lyrics", "ALTER TABLE"])
def test_replacement_survives_a_crash(spark, monkeypatch, crash_after):
    """Stopped right after the drop, or right before the rename: the next run has the new rows."""
    from pyspark.sql import SparkSession

    sinks.create_tables(spark, "crash")
    sinks.drop_tables(spark, "crash", confirm=True)
    sinks.create_tables(spark, "crash")
    names = TABLES["lyrics"].fieldNames()
    row = spark.createDataFrame([tuple([7, "la la"] + [None] * (len(names) - 2))], TABLES["lyrics"])
    sql = SparkSession.sql

    def failing(self, query, *args, **kw):
        if query.startswith("ALTER TABLE") and crash_after == "ALTER TABLE":
            raise RuntimeError("crash")
        result = sql(self, query, *args, **kw)
        if query == crash_after:
            raise RuntimeError("crash")
        return result

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError):
            sinks.replace_table(row, "lyrics", "crash")
    sinks.create_tables(spark, "crash")
    assert [r["track_id"] for r in sinks.stored(spark, "lyrics", "crash").collect()] == [7]
    sinks.replace_table(sinks.stored(spark, "lyrics", "crash"), "lyrics", "crash")
    assert sinks.stored(spark, "lyrics", "crash").count() == 1


def test_nothing_pending_writes_nothing(spark, model):
    before = spark.table(f"{DB}.lyrics").inputFiles()
    pipeline.analyze(spark, DB)
    assert spark.table(f"{DB}.lyrics").inputFiles() == before


def test_tracks_are_inserted_without_texts(spark, layout, model, monkeypatch):
    plans = {}

    def record(df, table, *args):
        plans[table] = df._jdf.queryExecution().executedPlan().toString()

    monkeypatch.setattr(sinks, "append_rows", record)
    final = spark.read.parquet(f"{layout.stages}/final")
    pipeline.load(spark, spark.read.parquet(f"{layout.stages}/artists"), final, DB)
    assert "Lyrics#" not in plans["tracks"] and "Lyrics#" in plans["lyrics"]
    assert "<=>" not in plans["tracks"] and "<=>" not in plans["lyrics"]


def test_integrity_is_audited(spark, layout, model):
    found = spark.read.parquet(f"{layout.stages}/audit/integrity")
    assert found.select("table_name", "rule", "columns").distinct().count() == len(RULES)
    assert found.where("violations > 0").count() == 0


def test_counters_of_the_stage_writes(spark, model, layout):
    """The counts taken while writing are those of the written rows."""
    got = {r["name"]: r["n"] for r in spark.read.parquet(f"{layout.stages}/audit/counts").collect()}
    final = spark.read.parquet(f"{layout.stages}/final")
    assert got["final_rows"] == final.count() > 0
    assert got["final_missing"] == final.where("match_path is null").count() > 0
    assert got["final_skipped"] == final.where("album_dir = 'Alive'").count()
    assert got["final_empty"] == final.where("Lyrics = ''").count() > 0
    assert got["tracks_rows"] == spark.read.parquet(f"{layout.stages}/tracks").count()
    assert got["lyrics_rows"] == spark.read.parquet(f"{layout.stages}/lyrics").count()


def test_marts_hold_what_a_rebuild_holds(spark, model, layout, tmp_path):
    from cantora.plans.refresh import LyricsMarts

    marts = LyricsMarts(str(tmp_path / "marts"), parts=8)
    pipeline.run(spark, layout, DB, marts=marts)
    other = StoredModel(spark, DB, marts)
    for name, columns in (("track_words", ["track_id", "word", "count"]), ("album_words", ["album_id", "word", "count"]),
                          ("lyrics", ["track_id", "text", "word_count", "sentiment_score"])):
        got, want = (sorted(map(str, getattr(m, name)().select(*columns).collect())) for m in (other, model))
        assert got == want and got
    assert [tuple(r) for r in catalog.unique_words_per_album(other).collect()] == [tuple(r) for r in catalog.unique_words_per_album(model).collect()]
    assert marts.sync(pipeline.placed_lyrics(spark, DB)) == 0
