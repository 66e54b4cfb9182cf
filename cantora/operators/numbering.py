"""Row numbers that never gather a whole group in one task.

A plain ``row_number()`` sorts each group in a single task, which fails when one group holds a
large share of the rows. Here rows are numbered inside (group, slice of the order key), and
each slice is shifted by the rows of the slices before it. Only the slice counts, at most
``SLICES`` per group, are ever summed up in sequence.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64
SLICE_ROWS = 100_000  # a group this small is sorted in one task


def _numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], out: str) -> DataFrame:
    """Number rows of ``df``, which has its slice in ``__slice`` (ascending with the order)."""
    keys = [*group, "__slice"]
    before = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        .select(
            *[F.col(g).alias(f"__g_{g}") for g in group],
            F.col("__slice").alias("__s"),
            F.coalesce(
                F.sum("__n").over(
                    Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("__shift"),
        )
    )
    inner = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    same = F.col("__slice") == F.col("__s")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"__g_{g}"))
    return (
        inner.join(before, same)
        .withColumn(out, (F.col("__rn") + F.col("__shift")).cast("bigint"))
        .drop("__slice", "__s", "__rn", "__shift", *[f"__g_{g}" for g in group])
    )


def number_by(df: DataFrame, group: Sequence[str], key: str, out: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Position of each row in its group, by a numeric key without ties inside a group.

    Groups of more than ``slice_rows`` rows are cut into slices at the quantiles of their own keys,
    whatever the keys of other groups; a smaller group is one slice. The result is the same.
    """
    large = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > slice_rows).drop("__n")
    cuts = [i / SLICES for i in range(1, SLICES)]
    named = large.select(*[F.col(g).alias(f"__b_{g}") for g in group])

    def same(other: str) -> Column:
        return reduce(and_, [F.col(g).eqNullSafe(F.col(f"{other}{g}")) for g in group])

    borders = (
        df.join(named, same("__b_"), "left_semi").groupBy(*group)
        .agg(F.percentile_approx(F.col(key), cuts, F.lit(1000)).alias("__cuts"))
        .select(*[F.col(g).alias(f"__c_{g}") for g in group], "__cuts")
    )
    placed = df.join(borders, same("__c_"), "left")
    # Where the key would stand among the borders of its group.
    slice_no = F.size(F.filter("__cuts", lambda c: c < F.col(key)))
    sliced = placed.withColumn("__slice", F.when(F.col("__cuts").isNull(), 0).otherwise(slice_no))
    return _numbered(sliced.drop("__cuts", *[f"__c_{g}" for g in group]), group, [F.col(key)], out)


def dense_ids(df: DataFrame, natural_key: Sequence[str], out: str, start: Column | None = None) -> DataFrame:
    """Ids 1..n for distinct natural keys, stable for a given set of keys.

    Keys are ordered by their digest, so 4,096 even slices are known without looking at the
    data. ``start`` is the highest id already in use.
    """
    text = F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in natural_key])
    digest = F.md5(text) if len(natural_key) > 1 else F.md5(F.coalesce(F.col(natural_key[0]).cast("string"), F.lit("\u0000")))
    sliced = df.withColumn("__digest", digest).withColumn("__slice", F.substring("__digest", 1, 3))
    out_df = _numbered(sliced, [], [F.col("__digest"), *[F.col(k) for k in natural_key]], out).drop("__digest")
    return out_df if start is None else out_df.withColumn(out, F.col(out) + F.coalesce(start, F.lit(0)))


def hash_id(*natural_key: Column) -> Column:
    """Surrogate key straight from the natural key: parallel, stable and NULL-safe."""
    parts = []
    for k in natural_key:
        parts += [k.isNull(), F.coalesce(k.cast("string"), F.lit(""))]
    return F.xxhash64(*parts)
