"""Resolving catalog objects: search hits, paged results, labels, inventory."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.operators.loading import first_per_key


def union_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """Rows of all pages, matched by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def page_items(pages: DataFrame, items: str = "items") -> DataFrame:
    """Items of landed result pages, one row each, with their position in the page."""
    others = [c for c in pages.columns if c != items]
    return pages.select(*others, F.posexplode(items).alias("pos", "item"))


def unique_names(df: DataFrame, scope: Sequence[str], name: str, order: Sequence[Column]) -> DataFrame:
    """First row per name, compared without case, inside the scope."""
    return first_per_key(df, [*[F.col(s) for s in scope], F.lower(F.col(name))], order)


def top_hit(hits: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Best hit of each search."""
    return first_per_key(hits, [F.col(k) for k in key], order)


def resolve_albums(requests: DataFrame, hits: DataFrame) -> DataFrame:
    """Id of the album asked for: the first hit whose name and one of whose artists are equal.

    ``requests``: request_id, artist, album. ``hits``: request_id, pos, id, name,
    artists array<struct<name>>. Requests without such a hit keep a NULL id.
    """
    same = F.lower("album") == F.lower(F.trim("name"))
    by_artist = F.exists("artists", lambda a: F.lower(a["name"]) == F.lower(F.col("artist")))
    found = (
        requests.join(hits, "request_id").where(same & by_artist)
        .groupBy("request_id").agg(F.min_by("id", "pos").alias("album_id"))
    )
    return requests.join(found, "request_id", "left")


def attach_labels(entities: DataFrame, key: str, ids: str, labels: DataFrame, out: str) -> DataFrame:
    """Entity with the labels of its ids, in the order of the ids; an id stands for a missing label."""
    exploded = entities.select(key, F.posexplode(ids).alias("pos", "qid"))
    named = exploded.join(labels, "qid", "left").select(
        key, F.struct("pos", F.coalesce("label_en", "qid").alias("label")).alias("entry")
    )
    lists = named.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["label"]).alias(out)
    )
    return entities.join(lists, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def inventory(files: DataFrame, parent: str = "artist", child: str = "album") -> DataFrame:
    """Distinct children of each parent, one row per pair."""
    return files.select(parent, child).where(F.col(child).isNotNull()).distinct()

