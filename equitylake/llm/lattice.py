"""Operator 7, embedding near-dedup by E8 lattice hashing.

In each of several tables a unit vector is projected by random normal rows to
16 or more dimensions, shifted, and each eight of them decoded to the nearest
point of the E8 lattice; the points together are its home cell. The nearest neighbouring cells are
probed too. Two vectors that share a cell in any table are compared by their
true cosine. Equal vectors form one class, hashed and compared once.

A pair may share cells in many tables, but is counted in the first table and
smallest cell they share, so links are counted without listing pairs: a task
returns, for the vectors of a cell, numbers of links and the edges of a
spanning forest. A cell of many vectors is dealt in pairs of bounded blocks.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitylake.llm.common import components, cut, hot_blocks, matrix, only, usable, whole_groups



@dataclass(frozen=True)
class Grid:
    """Tables of cells, each of so many E8 points of so much space, and how many of the cells around are probed."""

    tables: int
    halves: int
    scale: float
    probes: int


#: 0.99 of the pairs of cosine 0.95 share a cell, and nearly all closer ones. The first grid is that of every table, so
#: that whether two vectors meet depends on them alone. What a cell holds of pairs that are not near grows with the
#: table, and a caller may ask for the second grid, of finer cells and more tables of them: pairs of cosine 0.6 meet about
#: ten times less often in it (measured: 0.0007 against 0.009 meetings a pair), for 2.5 times the cells.
GRIDS = ((500_000, Grid(12, 2, 1.5, 2)), (1 << 62, Grid(18, 3, 1.6, 4)))
BLOCK_ROWS = 1024
SEED = 8


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to the neighbouring cells."""
    found = []
    for i, j in itertools.combinations(range(8), 2):
        for signs in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            found.append(v)
    found += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(found)


ROOTS = _roots()


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Integer points of even sum nearest to ``y``: round, and where the sum is odd move the worst-rounded coordinate."""
    near = np.rint(y)
    off = y - near
    worst = np.abs(off).argmax(-1)[..., None]
    step = np.where(np.take_along_axis(off, worst, -1) >= 0, 1.0, -1.0)
    odd = near.sum(-1, keepdims=True) % 2 != 0
    np.put_along_axis(near, worst, np.take_along_axis(near, worst, -1) + np.where(odd, step, 0.0), -1)
    return near


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """The points of E8, the union of D8 and D8 + 1/2, nearest to ``y`` (last axis 8)."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    closer = ((y - whole) ** 2).sum(-1, keepdims=True) <= ((y - half) ** 2).sum(-1, keepdims=True)
    return np.where(closer, whole, half)


def grid_for(n: int) -> Grid:
    """The grid to ask for where most pairs of ``n`` vectors are far from near; another grid may miss other pairs."""
    return next(grid for most, grid in GRIDS if n <= most)


def cell_codes(vectors: np.ndarray, grid: Grid = GRIDS[0][1]) -> np.ndarray:
    """Codes [row, table, 1 + probes] of each vector's home cell and of the nearest cells around it."""
    tables, halves, scale, probes = grid.tables, grid.halves, grid.scale, grid.probes
    n, dim = vectors.shape
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rng = np.random.default_rng([SEED, dim])
    codes = np.empty((n, tables, 1 + probes), np.int64)
    for t in range(tables):
        rows, shift = rng.normal(size=(8 * halves, dim)), rng.uniform(size=8 * halves)
        mix = rng.integers(1, 2**62, size=8 * halves, dtype=np.int64) * 2 + 1
        # Summed in a fixed order: equal vectors get equal cells in any batch.
        y = np.einsum("nd,rd->nr", unit, rows, optimize=False) / scale + shift
        y = y.reshape(n, halves, 8)
        cell = nearest_e8(y)
        points = np.rint(2 * cell).astype(np.int64).reshape(n, -1)
        home = (points * mix).sum(1) + (t << 56) + dim
        gain = np.einsum("nhe,re->nhr", y - cell, ROOTS, optimize=False).reshape(n, -1)
        best = np.argpartition(-gain, probes - 1, axis=1)[:, :probes] if probes else np.empty((n, 0), np.int64)
        steps = np.rint(2 * ROOTS).astype(np.int64)
        moved = np.stack([(steps * mix.reshape(halves, 8)[h]).sum(1) for h in range(halves)])  # a step's change of the code
        codes[:, t, 0] = home
        codes[:, t, 1:] = home[:, None] + moved.reshape(-1)[best]
    return codes


def _hashed(batches, grid: Grid):
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(1).value_lengths().to_numpy()
        for dim in np.unique(lengths):
            part = batch.filter(pa.array(lengths == dim))
            codes = cell_codes(matrix(part.column(1)), grid).reshape(part.num_rows, -1)
            width = codes.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*part.columns,
                 pa.ListArray.from_arrays(np.arange(0, codes.size + 1, width, dtype=np.int32), codes.ravel())], names=["id", "vector", "copies", "codes"])


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index each of ``n`` nodes reaches over the links (a, b)."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _first_shared(a: np.ndarray, b: np.ndarray, code: int, table: int) -> np.ndarray:
    """Whether ``code`` of ``table`` is the smallest code of the first table in which each row of a and b [row, table, cells] meet."""
    earlier = (a[:, :table, :, None] == b[:, :table, None, :]).any((1, 2, 3))
    same = a[:, table, :, None] == b[:, table, None, :]
    smaller = (same & (a[:, table, :, None] < code)).any((1, 2))
    return ~(earlier | smaller)


def _links(batches, least: float, tables: int):
    """(id, cls, links, to_id, to_cls): links of the vectors of each cell, and their spanning edges."""
    for part, starts in whole_groups(batches, 3):
        code, lo, hi, blk, ids, classes, copies = (part.column(c).to_numpy() for c in ("code", "lo", "hi", "blk", "id", "cls", "copies"))
        dims = pa.compute.list_value_length(part.column("vector")).to_numpy()
        codes = matrix(part.column("codes"), np.int64).reshape(part.num_rows, tables, -1)
        ends = np.append(starts[1:], part.num_rows)
        got, links, to = [], [], []  # of vectors: their rows
        for s, e in zip(starts.tolist(), ends.tolist()):
            rows = np.arange(s, e)
            for dim in np.unique(dims[s:e]):  # cells of different dimensions meet by chance only
                own = rows[dims[s:e] == dim]
                found = _pairs(part, own, code[s], lo[s] == hi[s], blk[own] == lo[s], codes, least)
                if found is None:
                    continue
                a, b = found
                where = np.searchsorted(own, np.concatenate((a, b)))
                count = np.bincount(where, copies[np.concatenate((b, a))].astype(np.float64), len(own)).astype(np.int64)
                low = _forest(np.searchsorted(own, a), np.searchsorted(own, b), len(own))
                hit = np.flatnonzero(count)
                got.append(own[hit])
                links.append(count[hit])
                to.append(own[low[hit]])
        if got:
            a, n, b = (np.concatenate(x) for x in (got, links, to))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[a], classes[a], n, ids[b], classes[b])], names=["id", "cls", "links", "to_id", "to_cls"])


def _pairs(part, own, code, within, in_lo, codes, least):
    """Linked pairs (row numbers) of a cell's block pair that are counted here."""
    left, right = (own, own) if within else (own[in_lo], own[~in_lo])
    if not len(left) or not len(right) or len(own) < 2:
        return None
    def unit(rows):
        v = matrix(part.column("vector").take(pa.array(rows)))
        return v / np.linalg.norm(v, axis=1, keepdims=True)
    u = unit(left)
    near = (u @ (u if within else unit(right)).T) >= least
    if within:
        near = np.triu(near, 1)
    if not near.any():
        return None
    table = int(np.flatnonzero((codes[own[0]] == code).any(1))[0])
    for t in range(table):  # most pairs that met earlier have met in a home cell
        near &= codes[left, t, 0][:, None] != codes[right, t, 0][None, :]
    i, j = np.nonzero(near)
    keep = [np.empty(0, bool)]
    for at in range(0, len(i), 20_000):
        keep.append(_first_shared(codes[left[i[at:at + 20_000]]], codes[right[j[at:at + 20_000]]], code, table))
    keep = np.concatenate(keep)
    return (left[i[keep]], right[j[keep]]) if keep.any() else None


def near_duplicates(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                    grid: Grid = GRIDS[0][1]) -> DataFrame:
    """Per row of ``vectors``: id, n_links, component_id (smallest id reachable), kept (id = component_id).

    Vectors that are null, zero or hold null or non-finite components, and
    rows without an id, link with nothing (component: their own id, kept).
    Vectors of different lengths do not link. Rows that repeat an id and its
    vector are one vector, and each gets its result; rows that repeat an id
    with another vector are vectors of their own, each with its own links and
    component. Copies of a vector under other ids count as links like any
    other. Empty table: no rows. ``grid``: the same by default whatever the
    table's size, so that other rows never change whether two vectors meet.
    """
    rows = only(vectors, id_col, vector_col).toDF("id", "vector").withColumn(
        "ok", usable(F.col("vector")) & F.col("id").isNotNull())
    fit = rows.where("ok").select(F.col("id").cast("bigint").alias("id"), "vector").distinct()
    classes = fit.groupBy("vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    kind = rows.schema["vector"].dataType.simpleString()
    # A class has a number of its own: an id may stand at several vectors, and then names no class.
    hashed = cut(classes.select("id", "vector", "copies").mapInArrow(
        partial(_hashed, grid=grid), f"id bigint, vector {kind}, copies bigint, codes array<bigint>")
        .withColumn("cls", F.monotonically_increasing_id()))
    members = hashed.select("cls", F.explode(F.array_distinct("codes")).alias("code"))
    dealt = hot_blocks(members, ["code"], "cls", BLOCK_ROWS)
    met = dealt.join(hashed, "cls").select("code", "lo", "hi", "blk", "id", "cls", "vector", "copies", "codes")
    ordered = met.repartition("code", "lo", "hi").sortWithinPartitions("code", "lo", "hi")
    found = cut(ordered.mapInArrow(partial(_links, least=least, tables=grid.tables), "id bigint, cls bigint, links bigint, to_id bigint, to_cls bigint"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    # The smallest node of a component, by id and then class, has its smallest id.
    edges = found.select(F.struct("id", "cls").alias("a"), F.struct(F.col("to_id").alias("id"), F.col("to_cls").alias("cls")).alias("b"))
    linked = components(edges).select(F.col("node.cls").alias("cls"), F.col("component.id").alias("component"))
    state = (hashed.select("cls", "id", "vector", "copies").join(links, "cls", "left").join(linked, "cls", "left")
                    .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                            F.coalesce("component", "id").alias("component_id")))
    out = rows.withColumn("key", F.when(F.col("ok"), F.col("vector"))).join(
        state.withColumnRenamed("vector", "key"), "key", "left")
    component = F.coalesce("component_id", F.col("id").cast("bigint"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
