"""Keyed loading: first-wins dedupe, insert-ignore, upsert, lookups, cascade, integrity.

Survivors are chosen with ``min_by``/``max_by`` aggregates, which combine before the shuffle,
so a key that holds a large share of the rows is reduced where it lies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def first_per_key(df: DataFrame, key: Sequence[Column], order: Sequence[Column], last: bool = False) -> DataFrame:
    """One row per key: the first in the given order (or the last)."""
    pick = F.max_by if last else F.min_by
    named = [k.alias(f"__k{i}") for i, k in enumerate(key)]
    row = F.struct(*_columns(df.columns))
    rank = F.struct(*order) if len(order) > 1 else order[0]
    return df.groupBy(*named).agg(pick(row, rank).alias("__row")).select("__row.*")


def same_key(left: DataFrame, right: DataFrame, keys: Sequence[str], nullable: Sequence[str] | None = None) -> Column:
    """Equality of keys, NULL-safe on the ``nullable`` ones (all by default).

    Plain equality on a key that is never NULL lets a table bucketed by it join without a shuffle.
    """
    safe = keys if nullable is None else nullable
    return reduce(and_, [left[k].eqNullSafe(right[k]) if k in safe else left[k] == right[k] for k in keys])


def insert_ignore(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column], nullable: Sequence[str] | None = None
) -> DataFrame:
    """Rows to append: the first per key among the incoming, unless the target has the key.

    Keys compare NULL-safe, so an artist without a birth date is not loaded twice; ``nullable`` names
    the keys that need it.
    """
    fresh = first_per_key(incoming, _columns(keys), order)
    return fresh.join(target, same_key(fresh, target, keys, nullable), "left_anti")


def upsert(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None,
    nullable: Sequence[str] | None = None,
) -> DataFrame:
    """Target with incoming rows added or replacing those of the same key; the last one wins."""
    new = incoming if order is None else first_per_key(incoming, _columns(keys), order, last=True)
    new = new.select(*_columns(target.columns))
    kept = target.join(new, same_key(target, new, keys, nullable), "left_anti")
    return kept.unionByName(new)


def not_done(todo: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Work that has no result yet."""
    return todo.join(done.select(*keys), list(keys), "left_anti")


def inputs_complete(inventory: DataFrame, keys: Sequence[str], kind: str, required: Sequence[str]) -> DataFrame:
    """Keys for which every required kind of input is present."""
    flags = [F.max(F.col(kind) == r).alias(f"__has{i}") for i, r in enumerate(required)]
    have_all = reduce(and_, [F.col(f"__has{i}") for i in range(len(required))])
    return inventory.groupBy(*keys).agg(*flags).where(have_all).select(*keys)


def lookup(children: DataFrame, parents: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Children with their parent's columns, and the children that have no parent.

    No broadcast hint: Spark broadcasts the parent side only when its measured size allows.
    """
    return children.join(parents, list(on)), children.join(parents, list(on), "left_anti")


def update_rows(table: DataFrame, recomputed: DataFrame, key: str) -> DataFrame:
    """Table in which the recomputed rows replace their old versions; ``key`` is never NULL."""
    return upsert(table, recomputed, [key], nullable=())


# ---- integrity --------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """One integrity rule: ``unique`` and ``not_null`` take columns, ``foreign`` a parent."""

    kind: str
    table: str
    columns: tuple[str, ...]
    parent: str | None = None
    parent_column: str = "id"


def violations(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Number of violations per rule: surplus rows, NULLs or orphans."""

    def one(rule: Rule) -> DataFrame:
        df = tables[rule.table]
        if rule.kind == "unique":
            # With no NULL in the key, as unique constraints see it.
            usable = df.where(reduce(and_, [F.col(c).isNotNull() for c in rule.columns]))
            counted = usable.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            found = counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations"))
        elif rule.kind == "not_null":
            missing = reduce(or_, [F.col(c).isNull() for c in rule.columns])
            found = df.where(missing).agg(F.count(F.lit(1)).alias("violations"))
        elif rule.kind == "foreign":
            child = rule.columns[0]
            parent = tables[rule.parent].select(F.col(rule.parent_column).alias("__parent"))
            orphans = df.where(F.col(child).isNotNull()).join(parent, F.col(child) == F.col("__parent"), "left_anti")
            found = orphans.agg(F.count(F.lit(1)).alias("violations"))
        else:
            raise ValueError(f"unknown rule kind {rule.kind}")
        return found.select(
            F.lit(rule.table).alias("table_name"),
            F.lit(rule.kind).alias("rule"),
            F.lit(",".join(rule.columns)).alias("columns"),
            "violations",
        )

    return reduce(DataFrame.unionByName, [one(r) for r in rules])


@dataclass(frozen=True)
class ChildOf:
    table: str
    column: str
    parent: str
    parent_column: str = "id"


def cascade_delete(
    tables: Mapping[str, DataFrame], root: str, doomed: Column, links: Sequence[ChildOf]
) -> dict[str, DataFrame]:
    """Tables after deleting rows of ``root`` and, down the links, every row under them.

    ``links`` are in parent-first order. Deleted keys flow down through semi-joins; what stays
    is the anti-join.
    """
    gone = {root: tables[root].where(doomed)}
    left = {root: tables[root].where(~F.coalesce(doomed, F.lit(False)))}
    for link in links:
        if link.parent not in gone:
            continue
        dead_keys = gone[link.parent].select(F.col(link.parent_column).alias("__dead")).distinct()
        child = tables[link.table]
        match = F.col(link.column) == F.col("__dead")
        gone[link.table] = child.join(dead_keys, match, "left_semi")
        left[link.table] = child.join(dead_keys, match, "left_anti")
    return {name: left.get(name, df) for name, df in tables.items()}
