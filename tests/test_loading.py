from pyspark.sql import Window
from pyspark.sql import functions as F

from cantora.operators import loading, numbering, shape
from cantora.operators.loading import ChildOf, Rule


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_insert_ignore_is_null_safe_and_first_wins(spark):
    target = spark.createDataFrame([("a", None, 1)], "name string, born string, v int")
    incoming = spark.createDataFrame([("a", None, 2), ("b", None, 4), ("b", None, 3), ("a", "1990", 5)], "name string, born string, v int")
    fresh = loading.insert_ignore(target, incoming, ["name", "born"], [F.col("v")])
    assert sorted(fresh.collect(), key=str) == sorted([("b", None, 3), ("a", "1990", 5)], key=str)
    again = loading.insert_ignore(target.unionByName(fresh), incoming, ["name", "born"], [F.col("v")])
    assert again.count() == 0


def test_upsert_last_wins(spark):
    target = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    incoming = spark.createDataFrame([(2, 21, 1), (2, 22, 2), (3, 30, 1)], "k int, v int, at int")
    assert rows(loading.upsert(target, incoming, ["k"], [F.col("at")])) == [(1, 10), (2, 22), (3, 30)]


def test_cascade_and_violations(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    b = spark.createDataFrame([(10, 1), (20, 2), (21, 2)], "id int, a_id int")
    c = spark.createDataFrame([(100, 10), (200, 20), (300, 99)], "id int, b_id int")
    links = (ChildOf("b", "a_id", "a"), ChildOf("c", "b_id", "b"))
    left = loading.cascade_delete({"a": a, "b": b, "c": c}, "a", F.col("name") == "y", links)
    assert rows(left["a"]) == [(1, "x")] and rows(left["b"]) == [(10, 1)] and rows(left["c"]) == [(100, 10), (300, 99)]
    rules = (Rule("foreign", "c", ("b_id",), "b"), Rule("unique", "b", ("a_id",)), Rule("not_null", "a", ("name",)))
    assert [r.violations for r in loading.violations({"a": a, "b": b, "c": c}, rules).collect()] == [1, 1, 0]


def test_inputs_complete_and_not_done(spark):
    inv = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "k string, kind string")
    assert rows(loading.inputs_complete(inv, ["k"], "kind", ["x", "y"])) == [("a",)]
    assert rows(loading.not_done(inv.select("k").distinct(), spark.createDataFrame([("a",)], "k string"), ["k"])) == [("b",)]


def test_numbers_of_a_dominant_group(spark):
    """One group holds most rows; numbering equals the plain window's."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 8, F.lit(0)).otherwise(F.col("id") % 7).alias("g"), ((F.col("id") * 7919) % 100003).alias("k")
    )
    got = numbering.number_by(df, ["g"], "k", "n", slice_rows=100)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy("k")).cast("bigint"))
    assert rows(got) == rows(plain)


def test_slices_split_a_hot_group_of_adjacent_keys(spark):
    """Keys of the hot group lie next to each other, far from those of the many other rows."""
    hot = spark.range(500_000, 503_000).select(F.lit(0).alias("g"), F.col("id").alias("k"))
    df = hot.union(spark.range(20_000).select((F.col("id") % 5000 + 1).cast("int").alias("g"), (F.col("id") * 1000).alias("k")))
    got = numbering.number_by(df, ["g"], "k", "n", slice_rows=1000)
    assert got.where("g = 0 AND n <> k - 499999").count() == 0 and got.count() == 23_000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__cuts" in plan


def test_dense_ids_continue_and_hash_ids_tell_null_apart(spark):
    df = spark.createDataFrame([(f"n{i}",) for i in range(500)], "name string")
    ids = [r.id for r in numbering.dense_ids(df, ["name"], "id", F.lit(100)).collect()]
    assert sorted(ids) == list(range(101, 601))
    keys = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), (None, "a")], "x string, y string")
    assert keys.select(numbering.hash_id(F.col("x"), F.col("y")).alias("h")).distinct().count() == 4


def test_shape_ignores_missing_columns_and_fans_out(spark):
    tracks = spark.createDataFrame([("t1", "A"), ("t2", "B")], "Name string, Album string")
    albums = spark.createDataFrame([("A", "1962", "x"), ("A", "2014-10-27", "3"), ("C", "1999", "1")], "Name string, `Release Date` string, Popularity string")
    joined = shape.join_album_metadata(tracks, albums)
    assert joined.count() == 3
    cleaned = shape.clean_tracks(joined.withColumnRenamed("Release Date", "Release Date_album"))
    assert cleaned.columns == ["SongName", "SongPopularity", "AlbumName", "ReleaseDateAlbum"]


def test_pending_skips_rows_handled_by_this_version(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 1), (3, 5, None)], "id int, m int, metrics_version int")
    assert [r.id for r in shape.pending(df, ["m"]).collect()] == [1, 2]
    assert [r.id for r in shape.pending(df, ["m"], 1).collect()] == [1]
