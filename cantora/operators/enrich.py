"""Metrics of lyrics tables: adding, finding and refreshing them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.functions import batches, sentiment
from cantora.functions import metrics as M
from cantora.operators.loading import update_rows
from cantora.operators.shape import pending
from cantora.schemas import METRICS

METRICS_VERSION = 1


def metric_columns(
    text: str,
    only: Sequence[str] = METRICS,
    rules: sentiment.Rules | None = None,
    density: Callable[[Column], Column] = M.lexical_density,
) -> dict[str, Column]:
    """Metrics of a text column by name; a missing text counts as the empty text."""
    safe = F.coalesce(F.col(text), F.lit(""))
    make = {
        "readability_score": lambda: M.readability(safe),
        "sentiment_score": lambda: sentiment.compound(f"`{text}`", rules),
        "word_count": lambda: M.words(safe),
        "line_count": lambda: M.lines(safe),
        "char_count": lambda: M.chars(safe),
        "lexical_density": lambda: density(safe),
    }
    return {name: make[name]() for name in only}


def with_metrics(
    lyrics: DataFrame, text: str = "text", only: Sequence[str] = METRICS, rules: sentiment.Rules | None = None, **kw
) -> DataFrame:
    """Lyrics with the metrics named in ``only``; row-local, so no shuffle.

    The metrics come out of a one-element ``explode``: filters on a metric cannot be pushed
    below it, which would evaluate the metric twice.
    """
    found = metric_columns(text, only, rules, **kw)
    packed = F.struct(*[c.alias(name) for name, c in found.items()])
    kept = [F.col(f"`{c}`") for c in lyrics.columns if c not in found]
    return lyrics.select(*kept, F.explode(F.array(packed)).alias("__m")).select(
        *kept, *[F.col(f"__m.{name}").alias(name) for name in found]
    )


def with_all_metrics(lyrics: DataFrame, rules: sentiment.Rules | None = None) -> DataFrame:
    """All metrics of ``text`` as ``with_metrics`` gives them, for whole tables.

    What they are made of is counted for many texts at once; the few texts with unusual characters are left
    to the expressions.
    """
    native = metric_columns("text", METRICS, rules)
    kept = [F.col(f"`{c}`") for c in lyrics.columns if c not in native]
    rows = lyrics.select(*kept, batches.scores(F.coalesce("text", F.lit("")), rules).alias("__b"))
    n = {c: F.col(f"__b.{c}") for c in batches.SCORES}
    counted = {
        "readability_score": M.flesch(n["words"], n["sentences"], n["syllables"]),
        "sentiment_score": sentiment.compound("`text`", rules, total="__b.rating"),
        "lexical_density": M.density(n["content"], n["tokens"]),
        **{c: n[c] for c in ("word_count", "line_count", "char_count")},
    }
    packed = [F.struct(*[made[m].alias(m) for m in METRICS]) for made in (counted, native)]
    chosen = F.when(F.col("__b").isNotNull(), packed[0]).otherwise(packed[1])
    return rows.select(*kept, F.explode(F.array(chosen)).alias("__m")).select(*kept, *[F.col(f"__m.{m}").alias(m) for m in METRICS])


def spread(df: DataFrame, key: str) -> DataFrame:
    """Input of heavy row-local work on at least as many tasks as there are cores.

    A table read from many splits comes back unchanged. One that arrives in a few large splits
    (a single row group cannot be split) is hashed over the cores by ``key``. Meant for plain
    scans, of which only the plan is looked at, no data.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    # By the hash, not the key itself: a later exchange on the key, put there so that the work is
    # done once, would count as redundant.
    return df.repartition(cores, F.xxhash64(key))


def refresh_metrics(lyrics: DataFrame, rules: sentiment.Rules | None = None, **kw) -> DataFrame:
    """Lyrics table in which the rows with a missing metric are computed and the rest stays."""
    todo = pending(lyrics, METRICS, METRICS_VERSION)
    done = with_metrics(todo, rules=rules, **kw).withColumn("metrics_version", F.lit(METRICS_VERSION))
    return update_rows(lyrics, done, "track_id")
