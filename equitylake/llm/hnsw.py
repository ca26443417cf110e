"""Operator 2, approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt by hash to shards. Each shard's task builds its
graph and returns it as a table, one row per vector with its neighbours at all
levels in one flat array, padded with -1. For a search, a shard's task reads
its graph and then the queries as they come, block by block, scores the finds
on the original vectors in double precision, and the shards' best are merged
per query. Every query visits every shard, so shards grow with the table, as
far as a task's memory allows: the work then grows by the few shards it takes
to keep the cluster busy, not by one for every few thousand vectors.

Copies of a vector are one node, which lists its smallest ids: as many as an
answer can hold, and one for the query's own.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from equitylake.llm.common import cut, matrix, only, usable

#: Vectors in a shard: at least, and at most (at 64 dimensions some 300 MB of vectors and links in a task).
SHARD_ROWS, MOST_SHARD_ROWS = 8192, 262_144
QUERY_BLOCK = 4096
DEGREE = 16  # neighbours at the upper levels; twice as many at the lowest
BUILD_WIDTH = 64
SEARCH_WIDTH = 128
BATCH = 256
WIDE = 4  # nodes of a beam expanded at a time


# ------------------------------------------------------------------ graph
def _beam(x: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for a block of queries at one level: (nodes, cosines), ``width`` each, unordered; -1 pads.

    ``entry`` [query, any] are start nodes (-1: none). Each step expands the
    best few unexpanded nodes of every query's beam, until all are expanded.
    """
    rows, cap, wide = len(queries), links.shape[1], min(WIDE, width)
    seen = np.zeros((rows, len(links) + 1), bool)  # the last column takes the padding
    seen[:, -1] = True
    first = np.sort(entry, axis=1)
    first[:, 1:][first[:, 1:] == first[:, :-1]] = -1
    size = max(width, first.shape[1])
    ids = np.full((rows, size), -1)
    ids[:, :first.shape[1]] = first
    sims = np.where(ids >= 0, np.einsum("bkd,bd->bk", x[ids], queries), -np.inf)
    np.put_along_axis(seen, ids, True, axis=1)
    done = ids < 0  # expanded, or padding
    if size > width:
        top = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        ids, sims, done = (np.take_along_axis(v, top, 1) for v in (ids, sims, done))
    active = np.flatnonzero(~done.all(1))
    while len(active):
        score = np.where(done[active], -np.inf, sims[active])
        pick = np.argpartition(-score, wide - 1, axis=1)[:, :wide] if wide < width else np.tile(np.arange(width), (len(active), 1))
        live = np.take_along_axis(score, pick, 1) > -np.inf
        nodes = np.where(live, np.take_along_axis(ids[active], pick, 1), -1)
        mark = done[active]
        np.put_along_axis(mark, pick, True, axis=1)
        done[active] = mark
        near = links[nodes]
        near[nodes < 0] = -1
        near = np.sort(near.reshape(len(active), wide * cap), axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[active[:, None], near]] = -1
        seen[active[:, None], near] = True
        new = np.where(near >= 0, np.einsum("bkd,bd->bk", x[near], queries[active]), -np.inf)
        all_ids, all_sims = np.hstack((ids[active], near)), np.hstack((sims[active], new))
        all_done = np.hstack((done[active], near < 0))
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[active], sims[active], done[active] = (np.take_along_axis(v, top, 1) for v in (all_ids, all_sims, all_done))
        active = active[~done[active].all(1)]
    return ids, sims


def _diverse(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Up to ``degree`` of each row's candidates: one is taken if it is nearer to the row's vector than to all taken before.

    Places left over go to the nearest of the others, so that no node is left with few links.
    """
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    rows, width = ids.shape
    vectors = x[ids]
    between = np.matmul(vectors, vectors.transpose(0, 2, 1))
    taken, count = np.zeros((rows, width), bool), np.zeros(rows, np.int64)
    valid = ids >= 0
    for c in range(width):
        blocked = (taken & (between[:, c, :] > sims[:, c, None])).any(1)
        take = valid[:, c] & ~blocked & (count < degree)
        taken[:, c] = take
        count += take
    rank = np.where(taken, 0, np.where(valid, 1, 2))
    chosen = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    out = np.where(np.take_along_axis(valid, chosen, 1), np.take_along_axis(ids, chosen, 1), -1)
    return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)


def _connect(x: np.ndarray, links: np.ndarray, nodes: np.ndarray, chosen: np.ndarray) -> None:
    """Set the new nodes' links and link back; a node with too many keeps a diverse choice."""
    cap = links.shape[1]
    links[nodes, :chosen.shape[1]] = chosen
    source = np.repeat(nodes, chosen.shape[1])[chosen.ravel() >= 0]
    target = chosen.ravel()[chosen.ravel() >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    heads = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.empty(0, np.int64)
    nodes_hit, sizes = target[heads], np.diff(np.r_[heads, len(target)])
    rank = np.arange(len(target)) - np.repeat(heads, sizes)
    added = np.full((len(heads), int(sizes.max(initial=0))), -1)
    added[np.repeat(np.arange(len(heads)), sizes), rank] = source
    held = links[nodes_hit]
    if held.size:
        added[(added[:, :, None] == held[:, None, :]).any(2)] = -1
    both = np.hstack((held, added))
    both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
    count = (both >= 0).sum(1)
    room = count <= cap
    links[nodes_hit[room]] = both[room][:, :cap]
    full = both[~room][:, :int(count.max(initial=0))]
    if len(full):
        hit = nodes_hit[~room]
        sims = np.where(full >= 0, np.einsum("bkd,bd->bk", x[full], x[hit]), -np.inf)
        links[hit] = _diverse(x, full, sims, cap)


def levels_of(n: int, degree: int = DEGREE) -> np.ndarray:
    """How many nodes reach each level: a share of 1 / degree of the level below, one at least."""
    top = int(np.floor(np.log(max(1, n)) / np.log(degree)))
    return np.array([max(1, int(n / degree**k)) for k in range(top + 1)])


def build(x: np.ndarray, degree: int = DEGREE, width: int = BUILD_WIDTH) -> list[np.ndarray]:
    """The graph of unit vectors in a random order: per level its flat neighbour array [node, degree], -1 padded.

    Level k holds the first ``levels_of(n)[k]`` nodes; node 0 is the entry.
    Nodes are inserted in batches no larger than the graph so far; nodes of a
    batch may link to each other.
    """
    x = np.asarray(x, np.float32)
    reach = levels_of(len(x), degree)
    links = [np.full((m, degree * (2 if k == 0 else 1)), -1) for k, m in enumerate(reach)]
    at = 1
    while at < len(x):
        level = int((reach > at).sum()) - 1  # the highest level of node ``at``
        end = min(len(x), at + BATCH, 2 * at, reach[level])
        nodes = np.arange(at, end)
        q = x[nodes]
        entry = np.zeros((len(nodes), 1), np.int64)
        for k in range(len(reach) - 1, -1, -1):
            found, sims = _beam(x, links[k], q, entry, 1 if k > level else width)
            if k <= level:
                peers = q @ q.T
                np.fill_diagonal(peers, -np.inf)
                near = np.argsort(-peers, axis=1, kind="stable")[:, :degree]
                mine = np.where(np.isfinite(np.take_along_axis(peers, near, 1)), nodes[near], -1)
                ids = np.hstack((found, mine))
                both = np.hstack((sims, np.where(mine >= 0, np.take_along_axis(peers, near, 1), -np.inf)))
                _connect(x, links[k], nodes, _diverse(x, ids, both, degree))
            entry = found
        at = end
    return links


def search(x: np.ndarray, links: list[np.ndarray], queries: np.ndarray, width: int = SEARCH_WIDTH) -> np.ndarray:
    """The nodes found nearest to each unit query, ``width`` at most (-1 pads), unordered."""
    out = []
    for at in range(0, len(queries), BATCH):
        q = queries[at:at + BATCH].astype(np.float32)
        entry = np.zeros((len(q), 1), np.int64)
        for k in range(len(links) - 1, 0, -1):
            entry, _ = _beam(x, links[k], q, entry, 1)
        out.append(_beam(x, links[0], q, entry, max(1, min(width, len(x))))[0])
    return np.vstack(out)


# ------------------------------------------------------------------ tasks
INDEX_SCHEMA = "shard int, dim int, node int, ids array<bigint>, vector array<double>, neighbours array<int>"


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _build_task(key, rows: pd.DataFrame, degree: int, width: int) -> pd.DataFrame:
    rows = rows.sort_values(["place", "id"]).reset_index(drop=True)
    x = np.stack(rows["vector"].to_list()).astype(np.float64)
    links = build(_unit(x), degree, width)
    flat = [np.concatenate([part[i] for part in links if i < len(part)]).astype(np.int32) for i in range(len(x))]
    return pd.DataFrame({"shard": key[0], "dim": key[1], "node": np.arange(len(x)), "ids": rows["ids"],
                         "vector": list(x), "neighbours": flat})


class _Graph:
    """A shard's graph, from its rows in the order of their nodes."""

    def __init__(self, rows: pa.Table, degree: int):
        self.x = matrix(rows.column("vector"))
        self.ids = rows.column("ids").to_pylist()
        flat = rows.column("neighbours").combine_chunks()
        values, offsets = flat.flatten().to_numpy(), flat.offsets.to_numpy()
        starts = offsets[:-1] - offsets[0]
        self.links, at = [], 0
        for level, m in enumerate(levels_of(len(self.x), degree)):
            cap = degree * (2 if level == 0 else 1)
            self.links.append(values[starts[:m, None] + at + np.arange(cap)].astype(np.int64))
            at += cap
        self.near = _unit(self.x).astype(np.float32)
        self.lengths = np.sqrt(np.einsum("nd,nd->n", self.x, self.x))

    def answer(self, queries: pa.Table, k: int, width: int) -> list[tuple[int, int, int, float]]:
        """(row, query_id, id, score) of the k best of each query."""
        q, out = matrix(queries.column("vector")), []
        found = search(self.near, self.links, _unit(q), width)
        for row, own, v, nodes in zip(queries.column("row").to_pylist(), queries.column("query_id").to_pylist(), q, found):
            nodes = nodes[nodes >= 0]
            score = np.einsum("nd,d->n", self.x[nodes], v) / (self.lengths[nodes] * np.sqrt(np.einsum("d,d->", v, v)))
            best = np.argsort(-score, kind="stable")
            floor = score[best[min(k, len(best) - 1)]]  # k besides the own node; ties at the end included
            # The query's own row is its id at its vector; its id at another vector is a row like any other.
            hits = sorted((-s, i) for s, n in zip(score, nodes) if s >= floor for i in self.ids[n] if i != own or (self.x[n] != v).any())
            out += [(row, own, i, -s) for s, i in hits[:k]]
        return out


_FOUND = "row bigint, query_id bigint, id bigint, score double"


def _search(batches, k: int, degree: int, width: int, block: int):
    """Answers of each shard to its queries; rows come sorted by shard, dimension and block, the graph before the queries."""
    key, parts, graph, asked = None, [], None, []

    def answers():
        nonlocal graph, parts, asked
        if asked and (parts or graph):
            if graph is None:
                graph, parts = _Graph(pa.concat_tables(parts), degree), []
            rows = graph.answer(pa.concat_tables(asked), k, width)
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["row", "query_id", "id", "score"])
        asked = []

    for batch in batches:
        part = pa.Table.from_batches([batch])
        keys = np.column_stack([part.column(c).to_numpy() for c in ("shard", "dim", "block", "kind")])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)] if len(keys) else [0]
        for a, b in zip(cuts, cuts[1:]):
            if key != tuple(keys[a, :3]):
                yield from answers()
                key, parts, graph = tuple(keys[a, :3]), [], None
            if keys[a, 3] == 0:
                parts.append(part.slice(a, b - a))
                continue
            for at in range(a, b, block):
                asked.append(part.slice(at, min(block, b - at)))
                if sum(t.num_rows for t in asked) >= block:
                    yield from answers()
    yield from answers()


# ------------------------------------------------------------------ operator
def index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, width: int = BUILD_WIDTH) -> DataFrame:
    """The graphs of ``vectors`` (id, vector; usable ones), one row per distinct vector, for answers of up to ``k`` rows."""
    ranked = vectors.withColumn("rank", F.row_number().over(W.partitionBy("vector").orderBy("id"))).where(F.col("rank") <= k + 1)
    nodes = ranked.groupBy("vector").agg(F.min("id").alias("id"), F.array_sort(F.collect_list("id")).alias("ids"))
    nodes = cut(nodes.withColumn("vector", F.col("vector").cast("array<double>")).withColumn("dim", F.size("vector"))
                     .withColumn("place", F.xxhash64(F.col("id"))))
    shards = max(1, -(-nodes.count() // shard_rows))
    return cut(nodes.withColumn("shard", F.pmod("place", F.lit(shards)).cast("int")).groupBy("shard", "dim").applyInPandas(
        lambda key, rows: _build_task(key, rows, degree, width), INDEX_SCHEMA))


def shard_rows_for(n: int, slots: int) -> int:
    """Vectors in a shard of a table of ``n``: two shards for each of the cluster's ``slots``, within the bounds."""
    return max(SHARD_ROWS, min(MOST_SHARD_ROWS, n // (2 * slots)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
            shard_rows: int | None = None, query_block: int = QUERY_BLOCK, degree: int = DEGREE,
            build_width: int = BUILD_WIDTH, search_width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, id, score): each query's ``k`` nearest found among the other rows, by cosine; ties to the smaller id.

    ``queries`` has the columns of ``vectors``. Rows with a null id, and
    vectors that are null, zero or hold null or non-finite components, take
    no part on either side; vectors of another length than the query's are no
    candidates. Rows that repeat an id and its vector are one; rows that
    repeat an id with another vector are rows of their own, each a candidate,
    and each a query with ranks of its own. A query with fewer candidates than
    ``k`` gets them all; with none, no row. ``shard_rows``: by default as
    ``shard_rows_for``.
    """
    def clean(df: DataFrame) -> DataFrame:
        rows = only(df, id_col, vector_col).toDF("id", "vector").where("id is not null")
        return rows.where(usable(F.col("vector"))).withColumn("id", F.col("id").cast("bigint")).distinct()

    slots = vectors.sparkSession.sparkContext.defaultParallelism
    graphs = index(clean(vectors), k, shard_rows or shard_rows_for(vectors.count(), slots), degree, build_width)
    asked = cut(clean(queries).select(F.col("id").alias("query_id"), F.col("vector").cast("array<double>").alias("vector"))
                              .withColumn("dim", F.size("vector")).withColumn("row", F.monotonically_increasing_id()))
    shards = graphs.select("shard", "dim").distinct()  # a few rows: one for each shard
    # A graph is sent to a few tasks, as many as keep the cluster busy, however many queries there are.
    blocks = max(1, -(-2 * slots // max(1, shards.count())))
    empty = F.lit(None)
    questions = asked.join(F.broadcast(shards.withColumnRenamed("dim", "of")), F.col("dim") == F.col("of")).select(
        "shard", "dim", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("kind"), "vector", "query_id", "row",
        F.lit(0).alias("node"), empty.cast("array<bigint>").alias("ids"), empty.cast("array<int>").alias("neighbours"))
    nodes = graphs.select("shard", "dim", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("kind"), "vector",
                          empty.cast("bigint").alias("query_id"), empty.cast("bigint").alias("row"), "node", "ids", "neighbours")
    each = nodes.unionByName(questions).repartition("shard", "dim", "block").sortWithinPartitions("shard", "dim", "block", "kind", "node")
    found = each.mapInArrow(partial(_search, k=k, degree=degree, width=search_width, block=query_block), _FOUND)
    best = found.withColumn("rank", F.row_number().over(W.partitionBy("row").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
