"""Operator 1, SimHash near-dedup by covering locality-sensitive hashing.

A fingerprint of 64 bits summarises a text's word shingles. For radius r the
2^(r+1) - 1 bit masks of a covering family are used as tables: bit i carries
a non-zero vector m(i) of r+1 bits and belongs to mask v when <m(i), v> is
odd. Any r differing bits span at most r of the r+1 dimensions, so some v is
orthogonal to all of them, and that table's masked fingerprints agree: every
pair within the radius collides, none is missed.

Colliding fingerprints are verified on their exact bit distance. Copies share
one fingerprint and are compared once. A bucket of many different
fingerprints is not paired: with radius 2, two members are linked exactly if
flipping at most one of the bits outside the mask takes both to a common
point, so each member lists its points and every point (reached by few
members, by construction) links them to its smallest: linear, and exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from equitylake.llm.common import components, cut, fresh, only

BITS = 64
SEED = 42
#: Buckets up to this many fingerprints are compared directly.
SMALL_BUCKET = 32
_BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)  # most significant first


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the shingles' XXH64, as an unsigned integer (no word: 0).

    Words are runs of non-space (ASCII white space), lower-cased A-Z; a text
    of fewer words than a shingle has one shingle, the whole sequence.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    spans = zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    octets = hashes.astype(">u8").view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(octets[:, i], minlength=256) @ _BIT_OF_BYTE for i in range(8)])
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["id", "fp"])


def simhash(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the 64-bit fingerprint of each row's whole text (null text: empty, fingerprint 0)."""
    rows = only(docs, id_col, text_col).toDF("id", "text").select("id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(partial(_fingerprints, shingle=shingle), f"id {kind}, fp bigint")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks; any two words within ``radius`` agree under at least one."""
    dims = 2 ** (radius + 1) - 1
    carried = [1 + i % dims for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (carried[i] & v).bit_count() % 2) for v in range(1, dims + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) whose closure joins all of ``prints`` (fp, distinct) within ``radius`` bits (1 or 2)."""
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for v, m in enumerate(masks)])
    rows = prints.select("fp", F.explode(tables).alias("t")).select("fp", "t.v", "t.key")
    counts = rows.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut(rows.join(counts, ["v", "key"]))

    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= radius
    small = (met.where(F.col("n") <= SMALL_BUCKET).groupBy("v", "key").agg(F.collect_list("fp").alias("m"))
                .select(F.explode("m").alias("a"), "m")
                .select("a", F.explode(F.filter("m", lambda y: (y > F.col("a")) & near(y, F.col("a")))).alias("b")))
    flips = F.array(*[F.array(*[F.lit(_signed(x)).cast("bigint") for x in (0, *(1 << i for i in range(BITS) if not m >> i & 1))])
                      for m in masks])
    points = (met.where(F.col("n") > SMALL_BUCKET)
                 .select("fp", "v", F.explode(F.element_at(flips, F.col("v") + 1)).alias("flip"))
                 .groupBy("v", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
                 .agg(F.collect_list("fp").alias("m"), F.min("fp").alias("least"), F.max(F.col("flip") == 0).alias("own")))
    # Two members share a point if they are within two bits; within one if the point is one of them.
    hub = points.where("own").withColumn("a", F.col("point")) if radius == 1 else points.withColumn("a", F.col("least"))
    large = hub.where(F.size("m") > 1).select("a", F.explode("m").alias("b")).where("a <> b")
    return small.unionByName(large).distinct()


def _grouped(docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str) -> DataFrame:
    """(id, fp, component, component_id) per row; the component is named by a fingerprint, component_id is its smallest id."""
    rows = cut(simhash(docs, shingle, id_col, text_col))
    prints = cut(rows.groupBy("fp").agg(F.min("id").alias("first")))
    linked = components(fingerprint_links(prints.select("fp"), radius))
    placed = prints.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    placed = cut(placed)
    lowest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = placed.join(lowest, "component").select("fp", "component", "component_id")
    return rows.join(by_print, "fp").select("id", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``; component_id is the smallest id reachable by links.

    A null text counts as empty; an empty text has fingerprint zero and links
    like any other. Repeated rows and ids are kept, one output row each. A
    row with a null id is compared too, but null is never a component's
    smallest id unless it has no other. An empty table gives no rows.
    """
    out = _grouped(docs, shingle, radius, id_col, text_col).select(
        "id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    return out.withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest id.

    Rows that repeat an id are told apart by their fingerprints, and by all
    their columns where those agree too; the smallest stays. Rows without an
    id are not compared and stay.
    """
    known = docs.where(F.col(f"`{id_col}`").isNotNull())
    found = cut(_grouped(known, shingle, radius, id_col, text_col).select("id", "fp", "component", "component_id"))
    key, prints, fp, turn = fresh(docs, "kept_id", "kept_prints", "kept_fp", "kept_turn")
    least = (found.where("id = component_id").groupBy("component").agg(F.min(F.struct("id", "fp")).alias("k"))
                  .groupBy(F.col("k.id").alias(key)).agg(F.collect_set("k.fp").alias(prints)))
    unknown = docs.where(F.col(f"`{id_col}`").isNull())
    again = found.groupBy("id").count().where("count > 1").select(F.col("id").alias(key))
    repeats = again.limit(1).count() > 0
    if repeats:  # null where one row has the id: that row stays
        least = least.join(again.withColumn(turn, F.lit(True)), key, "left").withColumn(prints, F.when(F.col(turn), F.col(prints))).drop(turn)
    out = docs.join(least.hint("shuffle_hash"), F.col(f"`{id_col}`") == F.col(key), "inner")
    if repeats:
        several = F.col(prints).isNotNull()
        text = F.when(several, F.coalesce(F.col(f"`{text_col}`").cast("binary"), F.lit(b"")))
        out = out.withColumn(fp, _print_of(shingle)(text)).where(~several | F.array_contains(prints, F.col(fp)))
        whole = F.when(several, F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns])))
        out = out.withColumn(turn, F.row_number().over(W.partitionBy(key, fp).orderBy(whole))).where(F.col(turn) == 1)
    return only(out, *docs.columns).unionByName(unknown)


def _print_of(shingle: int):
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else _signed(fingerprint(t, shingle)) for t in texts], dtype="Int64")

    return F.pandas_udf(prints, "bigint")
