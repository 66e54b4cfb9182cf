"""Prefix trie of conversations with subtree totals, rolled up band by band.

1. Turns are numbered and their digests XORed up in ranges of (conversation, turn). A range holds a part of
   a long conversation, many short ones or both; what a conversation brings along from earlier ranges is
   one row a range. The digests hold the depth, so the running XOR names the sequence so far.
2. Nodes are the distinct sequences, aggregated before the shuffle.
3. Roll-up: depths are cut into bands of a fixed height. In a band every node adds its own value to its
   ancestors inside the band only. The band roots with these sums are a trie of their own, lower by the
   height of a band, and are rolled up the same way until one band is left; then each completed total of
   a band root goes to its ancestors in the band above. A node is copied at most ``BAND`` times a round, and
   the rounds grow with the logarithm of the depth.

Equal turn numbers are ordered by a digest of role and text. Null roles and texts count as empty, rows
without a conv_id are in no conversation, repeated rows are turns of their own, other columns are ignored,
an empty table has no nodes. Two different sequences share a node with probability 2^-128 a pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantora.llm.common import stored

BAND = 16  # depths in a band
FAMILY, HEADS = 100, 6  # conversations c - c % FAMILY lend up to HEADS - 1 first turns
PIECE = 1 << 18  # ids joined to one text before they are hashed

_KEY = ["d", "p1", "p2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _half(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def turns(conversations: DataFrame) -> DataFrame:
    """(c, turn, g1, g2, size): digest and code points of each turn; no text goes further."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return (
        conversations.where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), digest.alias("g"),
                F.length(text).cast("long").alias("size"))
        .select("c", "turn", _half(F.col("g"), 1).alias("g1"), _half(F.col("g"), 17).alias("g2"), "size")
    )


def running(df: DataFrame, order: list[Column], x1: str, x2: str) -> DataFrame:
    """``df`` with the running count ``n`` and XORs ``s1``, ``s2`` of two columns, per ``c`` in ``order``.

    One row per range reaches the driver.
    """
    ranged = df.repartitionByRange("c", *order).sortWithinPartitions("c", *order).withColumn("_part", F.spark_partition_id())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, (0, 0, 0)
        for batch in batches:
            if not len(batch):
                continue
            c = batch.column("c").to_numpy()
            start = np.r_[True, c[1:] != c[:-1]]
            at = np.maximum.accumulate(np.where(start, np.arange(len(c)), 0))  # first row of the same c
            found = [np.arange(len(c)) - at + 1]
            for name in (x1, x2):
                x = batch.column(name).to_numpy()
                up = np.bitwise_xor.accumulate(x)
                found.append(up ^ up[at] ^ x[at])
            if last == c[0]:
                same = at == 0
                found[0][same] += carried[0]
                found[1][same] ^= carried[1]
                found[2][same] ^= carried[2]
            last, carried = c[-1], tuple(f[-1] for f in found)
            for name, values in zip(("n", "s1", "s2"), found):
                batch = batch.append_column(name, pa.array(values.astype(np.int64)))
            yield batch

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    local = stored(ranged.mapInArrow(scan, f"{fields}, n long, s1 long, s2 long"))
    ends = local.groupBy("_part").agg(
        F.min("c").alias("first"), F.max(F.struct("c", "n", "s1", "s2")).alias("last")
    ).orderBy("_part").toLocalIterator()
    carry, before = [], None
    for row in ends:
        end = row["last"]
        goes_on = before is not None and before[0] == row["first"]
        if goes_on:
            carry.append((row["_part"], *before))
        before = (end["c"], end["n"], end["s1"], end["s2"])
        if goes_on and end["c"] == row["first"]:
            _, c, n, s1, s2 = carry[-1]
            before = (c, before[1] + n, before[2] ^ s1, before[3] ^ s2)
    brought = df.sparkSession.createDataFrame(carry, "_part int, c long, _n long, _s1 long, _s2 long")
    zero = F.lit(0).cast("long")
    return (
        local.join(F.broadcast(brought), ["_part", "c"], "left")  # at most one row per range
        .withColumn("n", F.col("n") + F.coalesce("_n", zero))
        .withColumn("s1", F.col("s1").bitwiseXOR(F.coalesce("_s1", zero)))
        .withColumn("s2", F.col("s2").bitwiseXOR(F.coalesce("_s2", zero)))
        .drop("_part", "_n", "_s1", "_s2")
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(c, d, g1, g2, size): the rebuilt turns, from depth 1; and (c): all conversations, turnless ones too."""
    own = running(turns(conversations), [F.col("turn").asc_nulls_first(), F.col("g1"), F.col("g2"), F.col("size")], "g1", "g2")
    own = own.select("c", F.col("n").alias("pos"), "g1", "g2", "size")
    convs = stored(own.groupBy("c").agg(F.count(F.lit(1)).alias("own")))
    base = F.col("c") - F.col("c") % FAMILY
    lent = convs.select(F.col("c").alias("base"), F.col("own").alias("there"))
    members = (
        convs.select("c", base.alias("base"), (F.crc32(F.col("c").cast("string").cast("binary")) % HEADS).alias("h"))
        .join(lent, "base", "left")
        .withColumn("heads", F.least("h", F.coalesce("there", F.lit(0))))
    )
    rest = (
        own.join(members.select("c", "h", "heads"), "c").where("pos > h")
        .select("c", (F.col("pos") - F.col("h") + F.col("heads")).alias("d"), "g1", "g2", "size")
    )
    first = own.where(F.col("pos") < HEADS).select(F.col("c").alias("base"), F.col("pos").alias("d"), "g1", "g2", "size")
    lead = members.select("c", "base", "h").join(first, "base").where("d <= h").select("c", "d", "g1", "g2", "size")
    return rest.unionByName(lead), convs.select("c")


def paths(conversations: DataFrame) -> DataFrame:
    """(c, d, p1, p2, e1, e2, size): each conversation's nodes from the root on, named by depth and prefix."""
    rows, convs = rebuilt(conversations)

    def element(n: int) -> Column:
        return F.xxhash64(F.lit(n), F.col("d"), F.col("g1"), F.col("g2"))

    hashed = rows.select("c", "d", "size", element(1).alias("e1"), element(2).alias("e2"))
    deep = running(hashed, [F.col("d")], "e1", "e2").select(
        "c", "d", F.col("s1").alias("p1"), F.col("s2").alias("p2"), "e1", "e2", "size")
    zero = F.lit(0).cast("long")
    root = convs.select("c", *[zero.alias(x) for x in (*_KEY, "e1", "e2", "size")])
    return stored(deep.unionByName(root))


def roll_up(rows: DataFrame, values: list[str], deepest: int) -> DataFrame:
    """Sums of ``values`` over each node's subtree, its top included.

    ``rows`` are paths (c, d, p1, p2, top, values): every node has one row with ``top``, on which its own
    values are; other rows only name the ancestors of a conversation.
    """
    entry = F.struct("d", "p1", "p2", "top", *values)
    bands = rows.groupBy("c", F.floor(F.col("d") / BAND).alias("band")).agg(F.sort_array(F.collect_list(entry)).alias("path"))

    def up(exploded: DataFrame) -> DataFrame:
        return exploded.groupBy(*[F.col(f"node.{k}").alias(k) for k in _KEY]).agg(*[F.sum(v).alias(v) for v in values])

    tops = bands.select("path", F.posexplode("path").alias("i", "own")).where("own.top")
    inside = up(tops.select(F.explode(F.expr("slice(path, 1, i + 1)")).alias("node"), *[F.col(f"own.{v}").alias(v) for v in values]))
    if deepest < BAND:
        return inside
    inside = stored(inside)
    roots = rows.where(F.col("d") % BAND == 0)
    named = inside.select(*_KEY, *[F.col(v).alias(f"_{v}") for v in values])
    tops_of_bands = roots.where("top").select("c", *_KEY, "top").join(named, _KEY).select(
        "c", *_KEY, "top", *[F.col(f"_{v}").alias(v) for v in values])
    others = roots.where("not top").select("c", *_KEY, "top", *values)
    contracted = tops_of_bands.unionByName(others).withColumn("d", (F.col("d") / BAND).cast("long"))
    complete = roll_up(stored(contracted), values, deepest // BAND).withColumn("d", F.col("d") * BAND)
    below = tops_of_bands.where("d > 0").select("c", *_KEY).join(stored(complete), _KEY)
    handed = below.withColumn("band", (F.col("d") / BAND).cast("long") - 1).select("c", "band", *values).join(
        bands.select("c", "band", "path"), ["c", "band"])
    above = up(handed.select(F.explode("path").alias("node"), *values))
    return inside.unionByName(above).groupBy(*_KEY).agg(*[F.sum(v).alias(v) for v in values])


def end_digests(ends: DataFrame) -> DataFrame:
    """(d, p1, p2, ends_sha256) of the conversations (c, d, p1, p2) that end in a node.

    Ids are sorted in ranges, so a node where very many end is sorted by many tasks; the joined texts of a
    node are then hashed one after the other, as the digest demands, piece by piece.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for key, rows in groupby(zip(*[batch.column(k).to_pylist() for k in (*_KEY, "c")]), key=lambda r: r[:3]):
                ids = [r[3] for r in rows]
                for i in range(0, len(ids), PIECE // 16):
                    part = ids[i : i + PIECE // 16]
                    found.append((*key, part[0], ",".join(map(str, part))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*found), [pa.int64()] * 4 + [pa.string()])] if found
                else [pa.array([], t) for t in [pa.int64()] * 4 + [pa.string()]],
                names=[*_KEY, "first", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            columns = list(zip(*found)) if found else [[]] * 4
            return pa.record_batch([pa.array(list(columns[i]), pa.int64() if i < 3 else pa.string()) for i in range(4)],
                                   names=[*_KEY, "ends_sha256"])

        key, sha = None, None
        for batch in batches:
            found = []
            for d, p1, p2, ids in zip(*[batch.column(k).to_pylist() for k in (*_KEY, "ids")]):
                if (d, p1, p2) == key:
                    sha.update(b",")
                else:
                    if key:
                        found.append((*key, sha.hexdigest()))
                    key, sha = (d, p1, p2), hashlib.sha256()
                sha.update(ids.encode())
            yield out(found)
        yield out([(*key, sha.hexdigest())] if key else [])

    order = [*_KEY, "c"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        join, "d long, p1 long, p2 long, first long, ids string")
    return pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(
        digest, "d long, p1 long, p2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    """
    rows = paths(conversations)
    nodes = stored(rows.groupBy(*_KEY).agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("size").alias("size"),
        F.first("e1").alias("e1"), F.first("e2").alias("e2")))
    parent = [(F.col("d") - 1).alias("d"), F.col("p1").bitwiseXOR(F.col("e1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("e2")).alias("p2")]
    upward = nodes.where("d > 0").select(*parent, F.col("conv_id").alias("c"))
    children = upward.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n_children"))
    parents = upward.join(nodes.select(*_KEY, F.col("conv_id").alias("parent_conv_id")), _KEY).select(
        "c", (F.col("d") + 1).alias("d"), "parent_conv_id")

    zero = F.lit(0).cast("long")
    own = stored(nodes.join(children, _KEY, "left").select(
        *_KEY, "conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")))
    values = ["n_leaves", "saved_tokens"]
    # a conversation has one node of a depth, so (smallest member, depth) names a node as well
    tops = own.select(F.col("conv_id").alias("c"), "d", F.lit(True).alias("top"), *values)
    marked = stored(rows.select("c", *_KEY).join(tops, ["c", "d"], "left").select(
        "c", *_KEY, F.coalesce("top", F.lit(False)).alias("top"), *[F.coalesce(v, zero).alias(v) for v in values]))
    deepest = rows.agg(F.max("d")).first()[0] or 0
    totals = roll_up(marked, values, deepest)

    ends = rows.groupBy("c").agg(F.max(F.struct(*_KEY)).alias("end")).select("c", "end.*")
    found = own.drop(*values).join(totals, _KEY).join(end_digests(ends), _KEY, "left")
    found = found.join(parents.withColumnRenamed("c", "conv_id"), ["conv_id", "d"], "left")
    return found.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
