"""Approximate nearest neighbours: one navigable small-world hierarchy per shard, results merged.

A shard's graph is a few flat arrays: the neighbours of every node on the ground level, and of the
nodes of each upper level. Building and searching move a whole batch of points through the graph in
step, so that numpy does the work.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cantora.llm.common import stored

SHARD_ROWS = 4096  # about as many distinct vectors in a shard
BLOCK_ROWS = 2048  # about as many queries meet a shard in one task
LINKS = 12  # neighbours of a node on upper levels, twice as many on the ground
BEAM_BUILD, BEAM_SEARCH = 64, 128  # candidates kept while building and searching
BATCH = 256  # points that move in step
STEP = 4  # nodes each point expands at once

INDEX_SCHEMA = (
    "dim int, shard int, n int, vectors binary, members array<array<long>>, ground binary, upper_nodes binary, "
    "upper_links binary, level_sizes array<int>"
)


@dataclass
class Graph:
    """``ground``: neighbours (node x 2 LINKS, -1 for none). ``levels``: (nodes, neighbours) from level 1 up."""

    unit: np.ndarray
    ground: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]


def _beam(unit: np.ndarray, links: np.ndarray, points: np.ndarray, entries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, similarities) of the ``width`` best nodes found for each point, best first; -1 pads."""
    q = len(points)
    ids = np.full((q, width), -1, np.int64)
    sims = np.full((q, width), -np.inf, np.float32)
    done = np.zeros((q, width), bool)
    seen = np.zeros((q, len(links)), bool)
    rows = np.arange(q)
    start = entries.reshape(q, -1)[:, :width]
    ids[:, : start.shape[1]] = start
    sims[:, : start.shape[1]] = np.einsum("qkd,qd->qk", unit[start], points)
    seen[rows[:, None], start] = True
    active = rows
    while len(active):
        open_sims = np.where(done[active] | (ids[active] < 0), -np.inf, sims[active])
        best = np.argpartition(-open_sims, STEP - 1, axis=1)[:, :STEP] if width > STEP else np.argsort(-open_sims, axis=1)
        ok = np.take_along_axis(open_sims, best, 1) > -np.inf
        alive = ok.any(axis=1)
        active, best, ok = active[alive], best[alive], ok[alive]
        if not len(active):
            break
        nodes = np.where(ok, ids[active[:, None], best], -1)
        done[active[:, None], best] |= ok
        near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(active), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[active[:, None], near]
        at, _ = np.nonzero(fresh)
        found = near[fresh]
        seen[active[at], found] = True
        got = np.full(near.shape, -np.inf, np.float32)
        got[fresh] = np.einsum("kd,kd->k", unit[found], points[active[at]])
        all_sims = np.concatenate([sims[active], got], axis=1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[active] = np.take_along_axis(all_sims, top, 1)
        all_ids = np.concatenate([ids[active], np.where(fresh, near, -1)], axis=1)
        ids[active] = np.take_along_axis(all_ids, top, 1)
        all_done = np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1)
        done[active] = np.take_along_axis(all_done, top, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _spread(unit: np.ndarray, candidates: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Up to ``keep`` candidates (best first), none closer to a kept one than to the point itself.

    Places left over go to the best of the rest, so sparse corners stay reachable.
    """
    between = unit[candidates] @ unit[candidates].T
    chosen, others = [], []
    blocked = np.full(len(candidates), -np.inf, np.float32)
    for i in range(len(candidates)):
        if blocked[i] > sims[i]:
            others.append(i)
            continue
        chosen.append(i)
        if len(chosen) == keep:
            break
        np.maximum(blocked, between[i], out=blocked)
    return candidates[(chosen + others[: keep - len(chosen)])]


def _linked(unit: np.ndarray, nodes: np.ndarray, width: int) -> np.ndarray:
    """Neighbours of a small level, from all its similarities; ids are places in ``nodes``."""
    links = np.full((len(nodes), width), -1, np.int32)
    own = unit[nodes]
    take = min(len(nodes), 4 * width)
    for at in range(0, len(nodes), BATCH):
        sims = own[at : at + BATCH] @ own.T
        sims[np.arange(len(sims)), at + np.arange(len(sims))] = -np.inf
        order = np.argsort(-sims, axis=1, kind="stable")[:, :take]
        for i, c in enumerate(order):
            c = c[c != at + i]
            kept = _spread(own, c, sims[i, c], width)
            links[at + i, : len(kept)] = kept
    return links


def build(vectors: np.ndarray) -> Graph:
    """Graph of the rows of ``vectors``, all distinct and not zero.

    Nodes draw their level by place, as rows come in the order of a hash. Upper levels hold one in
    ``LINKS`` of the level below and are linked outright; the ground starts from level 1 and takes the
    rest in batches, each point linked to what its beam search and its batch offer.
    """
    n = len(vectors)
    wide = vectors.astype(np.float64)
    unit = (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)
    levels, nodes = [], np.arange(0, n, LINKS)
    while len(nodes) > 1:
        levels.append((nodes.astype(np.int32), _linked(unit, nodes, LINKS)))
        nodes = nodes[::LINKS]
    width = 2 * LINKS
    first = levels[0][0].astype(np.int64) if levels else np.arange(n)
    ground = np.full((n, width), -1, np.int32)
    local = _linked(unit, first, width)
    ground[first] = np.where(local >= 0, first[local], -1)
    rest = np.setdiff1d(np.arange(n), first)
    graph = Graph(unit, ground, levels)
    for at in range(0, len(rest), BATCH):
        batch = rest[at : at + BATCH]
        points = unit[batch]
        ids, sims = _beam(unit, ground, points, _descend(graph, points), BEAM_BUILD)
        among = points @ points.T
        np.fill_diagonal(among, -np.inf)
        ids = np.concatenate([ids, np.broadcast_to(batch, among.shape)], axis=1)
        sims = np.concatenate([sims, among], axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :BEAM_BUILD]
        back: dict[int, list[int]] = {}
        for i, node in enumerate(batch):
            c = ids[i, order[i]]
            good = (c >= 0) & (c != node)
            kept = _spread(unit, c[good], sims[i, order[i]][good], LINKS)
            ground[node, : len(kept)] = kept
            for other in kept.tolist():
                back.setdefault(other, []).append(node)
        for other, new in back.items():
            have = ground[other][ground[other] >= 0]
            both = np.unique(np.concatenate([have, new]))
            if len(both) > width:
                s = unit[both] @ unit[other]
                best = np.argsort(-s, kind="stable")
                both = _spread(unit, both[best], s[best], width)
            ground[other, : len(both)] = both
            ground[other, len(both) :] = -1
    return graph


def _descend(graph: Graph, points: np.ndarray) -> np.ndarray:
    """Ground entry of each point: the best node of a narrow beam through the upper levels."""
    entries = np.zeros(len(points), np.int64)
    for nodes, links in reversed(graph.levels):
        found, _ = _beam(graph.unit[nodes], links, points, np.searchsorted(nodes, entries), 2 * STEP)
        entries = nodes[found[:, 0]].astype(np.int64)
    return entries


def search(graph: Graph, points: np.ndarray, k: int, width: int = BEAM_SEARCH) -> np.ndarray:
    """Ids of about the ``k`` nearest nodes of each point, best first, -1 for none."""
    found = []
    for at in range(0, len(points), BATCH):
        part = points[at : at + BATCH]
        ids, _ = _beam(graph.unit, graph.ground, part, _descend(graph, part), max(width, k))
        found.append(ids[:, :k])
    return np.concatenate(found) if found else np.zeros((0, k), np.int64)


def valid_vector(v: Column) -> Column:
    """Not NULL, not zero, no NULL or non-finite component."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def build_index(rows: DataFrame, keep: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard and dimension: vectors, members and graph of the rows (vec_id, embedding).

    Equal vectors are one node with its ``keep`` least ids: no search for fewer neighbours can need
    more of them. They are cut down before the shuffle, so a vector of a third of all rows costs a few
    rows per task.
    """
    least = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    nodes = stored(
        rows.distinct().withColumn("_n", least).where(f"_n <= {keep}")
        .groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    )
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    sharded = nodes.withColumn("dim", F.size("embedding")).withColumn(
        "shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int"))

    def build_shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("order").reset_index(drop=True)
        vectors = np.vstack(part["embedding"].to_numpy()).astype(np.float32)
        graph = build(vectors)
        return pd.DataFrame({
            "dim": [vectors.shape[1]], "shard": [int(part["shard"][0])], "n": [len(vectors)], "vectors": [vectors.tobytes()],
            "members": [[list(m) for m in part["members"]]], "ground": [graph.ground.tobytes()],
            "upper_nodes": [b"".join(nodes.tobytes() for nodes, _ in graph.levels)],
            "upper_links": [b"".join(links.tobytes() for _, links in graph.levels)],
            "level_sizes": [[len(nodes) for nodes, _ in graph.levels]],
        })

    order = sharded.withColumn("order", F.xxhash64("embedding", F.lit(1)))
    index = order.groupBy("dim", "shard").applyInPandas(build_shard, INDEX_SCHEMA)
    return stored(index)


def _graph_of(row: pd.Series) -> tuple[np.ndarray, Graph]:
    vectors = np.frombuffer(row["vectors"], np.float32).reshape(row["n"], row["dim"])
    wide = vectors.astype(np.float64)
    unit = (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)
    levels, at = [], 0
    nodes, links = np.frombuffer(row["upper_nodes"], np.int32), np.frombuffer(row["upper_links"], np.int32)
    for size in row["level_sizes"]:
        levels.append((nodes[at : at + size], links[at * LINKS : (at + size) * LINKS].reshape(size, LINKS)))
        at += size
    return vectors, Graph(unit, np.frombuffer(row["ground"], np.int32).reshape(row["n"], 2 * LINKS), levels)


def nearest(queries: DataFrame, index: DataFrame, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest rows found for each query (vec_id, embedding).

    Blocks of queries meet every shard, one block and one shard in a task; each returns its own ``k``
    best by exact double-precision cosine of all its graph found, and a ranking per query merges them.
    """
    shards = index.select(F.col("dim").alias("shard_dim"), F.col("shard").alias("shard_no"))
    dim_of = F.size("embedding")
    blocks = max(1, math.ceil(queries.count() / block_rows))
    placed = queries.select(
        F.col("vec_id").alias("query_id"), "embedding", dim_of.alias("dim"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
    ).join(shards, F.col("dim") == F.col("shard_dim")).select(
        "query_id", "embedding", "dim", F.col("shard_no").alias("shard"), "block")
    grid = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search_shard(asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(asked) or not len(shard):
            return empty
        vectors, graph = _graph_of(shard.iloc[0])
        members = shard.iloc[0]["members"]
        points = np.vstack(asked["embedding"].to_numpy()).astype(np.float64)
        norms = np.linalg.norm(points, axis=1)
        # the whole beam: single precision cannot rank vectors of nearly one direction
        found = search(graph, (points / norms[:, None]).astype(np.float32), max(BEAM_SEARCH, k + 1))
        # and all nodes of the directions in it: links among equal directions do not reach all of them
        direction = np.unique(graph.unit, axis=0, return_inverse=True)[1].reshape(-1)
        by_direction = np.argsort(direction, kind="stable")
        ends = np.cumsum(np.bincount(direction))
        lengths: dict[int, float] = {}
        out = []
        for i, query in enumerate(asked["query_id"].tolist()):
            met = np.unique(direction[found[i][found[i] >= 0]])
            nodes = [n for d in met.tolist() for n in by_direction[ends[d - 1] if d else 0 : ends[d]].tolist()]
            wide = vectors[nodes].astype(np.float64)
            for node, w in zip(nodes, wide):
                if node not in lengths:
                    lengths[node] = np.linalg.norm(w)
            scores = [float(np.dot(points[i], w) / (norms[i] * lengths[node])) for node, w in zip(nodes, wide)]
            near = sorted((-s, m) for s, node in zip(scores, nodes) for m in members[node] if m != query)[:k]
            out += [(query, m, -s) for s, m in near]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty

    partial = (
        placed.groupBy("dim", "shard", "block").cogroup(grid.groupBy("dim", "shard", "block"))
        .applyInPandas(search_shard, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")


def search_every(rows: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The ``k`` nearest rows of each row of ``rows`` (vec_id, embedding) whose vec_id is divisible by ``every``.

    Defined cases: a NULL vec_id, and a vector that is NULL, empty, zero or holds a NULL or non-finite
    component, take no part; vectors of different length are not compared; equal scores go to the
    smaller vec_id; rows repeated under one id count once, and of several vectors under one id the
    least is asked for; fewer candidates give fewer rows, an empty table none; further columns are
    ignored.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & valid_vector(F.col("embedding")))
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    return nearest(queries, build_index(rows, keep=k + 1), k)
