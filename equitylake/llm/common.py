"""Helpers shared by the corpus operators: lineage cuts, fresh column names, connected components."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equitylake.session import checkpoint_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder.

    The files are readable from every executor, so a lost executor costs no
    earlier stage. Spark's cleaner removes them once the frame is gone if
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is on, which is set
    when the context starts: ``get_session`` does; a cluster's own session
    must, or the folder keeps them.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` with underscores added until none clashes with a column of ``df`` (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, by position: extra columns of any name do no harm."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Alternating large-star and small-star rounds: each round links a node's
    neighbours to its smallest one, so paths halve and a hub never gathers
    its neighbours anywhere (minima are pre-aggregated, the join back is one
    AQE can split). Rounds grow with the logarithm of the largest component.
    Nulls and self-links are dropped.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _signature(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a")
                      .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
                      .select("e.*").where("a <> b").distinct())
        e = cut(small)
        last, state = state, _signature(e)
        if state == last:
            break
    # Every edge now points from a node to its component's smallest node.
    return (e.select(F.col("a").alias("node"), F.col("b").alias("component"))
             .unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


#: Facts of at most so many rows go to every executor whole.
BROADCAST_ROWS = 100_000
#: At most so many keys can each hold more than 1 / HOT_KEYS of all rows.
HOT_KEYS = 10_000
SALTS = 1024


def looked_up(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int, spread: Sequence[str]) -> DataFrame:
    """``rows`` left-joined to ``facts``, which has one row for a ``key`` and is computed already (``cut``).

    ``weight`` counts the rows that hold a key and sums to ``total`` at most.
    Facts that are counted to be few are broadcast. Of more, those of the keys
    that hold over 1 / HOT_KEYS of the rows are HOT_KEYS at most and are
    broadcast; the others meet their rows in a shuffle, in which the rows of
    the hot keys, already served, are spread by the columns ``spread``.
    """
    values = [c for c in facts.columns if c not in (key, weight)]
    found = F.struct(*values)
    if facts.count() <= BROADCAST_ROWS:
        near = facts.select(F.col(key).alias("__key"), found.alias("__hot"))
        out = rows.join(F.broadcast(near), F.col(key) == F.col("__key"), "left")
        return out.select(*rows.columns, *[F.col("__hot")[c].alias(c) for c in values])
    hot = F.col(weight) > max(1, total // HOT_KEYS)
    near = facts.where(hot).select(F.col(key).alias("__key"), found.alias("__hot"))
    far = facts.where(~hot).select(F.col(key).alias("__far"), found.alias("__cold"), hot.cast("int").alias("__none"))
    served = F.col("__hot").isNotNull() | F.col(key).isNull()
    out = (rows.join(F.broadcast(near), F.col(key) == F.col("__key"), "left")
               .withColumn("__salt", F.when(served, 1 + F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).otherwise(0)))
    out = out.join(far, (F.col(key) == F.col("__far")) & (F.col("__salt") == F.col("__none")), "left")
    return out.select(*rows.columns, *[F.coalesce("__hot", "__cold")[c].alias(c) for c in values])


def hot_blocks(members: DataFrame, key: Sequence[str], salt: str, size: int) -> DataFrame:
    """``members`` of groups of two or more, dealt so that no task meets a whole hot group.

    A group of n rows becomes ceil(n / size) blocks by ``salt`` hash, and each
    row goes to every pair of blocks (lo, hi) that holds its own block (``blk``):
    each pair of rows of a group meets in at least one task of about 2 * size rows.
    """
    counts = (members.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select(*key, F.ceil(F.col("n") / size).cast("int").alias("nb")))
    dealt = members.join(counts, list(key)).withColumn("blk", F.pmod(F.xxhash64(salt), F.col("nb")).cast("int"))
    return (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
                 .withColumn("lo", F.least("blk", "other")).withColumn("hi", F.greatest("blk", "other"))
                 .drop("other", "nb"))


def whole_groups(batches, n_keys: int):
    """Tables of whole groups from record batches sorted by their first ``n_keys`` columns: (table, starts of its groups).

    The batches of an open group are kept as they are and put together once,
    when it ends: a group of many batches costs no more than its rows.
    """
    held, rows = [], 0  # the open group
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        starts = _starts(part, n_keys)
        if held and not _same_key(held[-1], part, n_keys):
            yield pa.concat_tables(held), np.zeros(1, np.int64)
            held, rows = [], 0
        if len(starts) > 1:
            first = starts[:-1] + rows
            first[0] = 0
            yield pa.concat_tables([*held, part.slice(0, starts[-1])]), first
            held, rows, part = [], 0, part.slice(starts[-1])
        held.append(part)
        rows += part.num_rows
    if held:
        yield pa.concat_tables(held), np.zeros(1, np.int64)


def _same_key(before: pa.Table, after: pa.Table, n_keys: int) -> bool:
    return all(before.column(i)[-1].as_py() == after.column(i)[0].as_py() for i in range(n_keys))


def _starts(part: pa.Table, n_keys: int) -> np.ndarray:
    new = np.zeros(part.num_rows, bool)
    new[0] = True
    for i in range(n_keys):
        values = part.column(i).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def lots(texts: pa.Array, most: int):
    """(start, end) of neighbouring texts of at most ``most`` bytes together; a longer one alone."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = 0
    while start < len(sizes):
        upto = np.cumsum(sizes[start:start + 100_000], dtype=np.int64)
        end = start + max(1, int(np.searchsorted(upto, most, side="right")))
        yield start, end
        start = end


def matrix(column, dtype=np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return rows.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(rows), -1)


def usable(vector: Column) -> Column:
    """True for a vector that has a direction: not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))
