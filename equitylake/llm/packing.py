"""Operator 4, packing into optimal length buckets.

Texts are cut into sequences of at most ``max_len`` words. The histogram of
their lengths (at most ``max_len`` bins, whatever the corpus holds) goes
through a dynamic programme that chooses the bucket boundaries with the least
padding; each bucket is then dealt into batches of a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from equitylake.llm.common import cut, only

MAX_LEN = 2048
BUCKETS = 8
TOKEN_BUDGET = 65_536
SLICE_ROWS = 50_000
#: Copies of a row that one task makes at a time.
COPIES = 100_000


def marked(docs: DataFrame, max_len: int = MAX_LEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sequences`` with ``mark``, a hash of the row's id, text and number among the rows that repeat both.

    So neither rows of one id, nor of none, nor repeated rows share a mark,
    and a row's mark does not depend on where it lies.
    """
    rows = only(docs, id_col, text_col).toDF("id", "text")
    n = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("bigint")
    kinds = cut(rows.select("id", F.xxhash64("text").alias("t"), n.alias("n")).groupBy("id", "t", "n").agg(F.count(F.lit(1)).alias("copies")))
    chunks = kinds.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES))))
    if (kinds.agg(F.max("copies")).first()[0] or 0) > COPIES:
        chunks = chunks.repartition("id", "t", "chunk")  # the copies of a row are made by several tasks
    copies = F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(COPIES).cast("bigint"), F.col("copies") - F.col("chunk") * COPIES))
    each = chunks.select("id", "n", "t", "chunk", F.explode(copies).alias("c")).select(
        "id", "n", F.xxhash64("id", "t", F.col("chunk") * COPIES + F.col("c")).alias("mark"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / max_len) - 1).cast("bigint")
    return (each.select("id", "n", "mark", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("piece"))
                .select("id", "piece", (F.col("piece") * max_len).alias("start"),
                        F.least(F.lit(max_len).cast("bigint"), F.col("n") - F.col("piece") * max_len).alias("n_tokens"), "mark"))


def sequences(docs: DataFrame, max_len: int = MAX_LEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, n_tokens): each text's words [start, start + n_tokens) by pieces of ``max_len``.

    Words are runs of non-space. A null, empty or blank text is one piece of
    no token. Repeated rows give repeated pieces.
    """
    return marked(docs, max_len, id_col, text_col).drop("mark")


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """The bucket boundaries (padded lengths, ascending) of least total padding; at most ``buckets``.

    ``lengths`` are distinct and ascending. Of equally good choices the one
    with the smallest boundaries from the last bucket back is taken.
    """
    if not lengths:
        return []
    size = np.array(lengths, np.int64)
    rows = np.concatenate(([0], np.cumsum(np.array(counts, np.int64))))
    k, n = min(buckets, len(lengths)), len(lengths)
    far = np.iinfo(np.int64).max // 4
    best, back = np.full(n + 1, far), np.zeros((k, n + 1), np.int64)
    best[0] = 0
    for b in range(k):
        new = np.full(n + 1, far)
        new[0] = 0
        for j in range(1, n + 1):
            padded = best[:j] + size[j - 1] * (rows[j] - rows[:j])  # the tokens themselves are a constant
            back[b, j] = i = int(padded.argmin())
            new[j] = padded[i]
        best = new
    found, j = [], n
    for b in range(k - 1, -1, -1):
        if j:
            found.append(int(size[j - 1]))
            j = int(back[b, j])
    return found[::-1]


def pack(docs: DataFrame, max_len: int = MAX_LEN, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per sequence: id, piece, start, n_tokens, bucket (padded length), batch, slot.

    A batch is numbered within its bucket and holds token_budget // bucket
    sequences (one at least); all batches of a bucket but the last are full.
    Sequences are dealt in the order of a hash of their content (``marked``),
    so batches mix sources, and rows that share an id, or have none, are spread
    like any others.
    A sequence of no token is in no batch (nulls). An empty table gives no rows.
    """
    rows = cut(marked(docs, max_len, id_col, text_col))
    histogram = {r["n_tokens"]: r["n"] for r in
                 rows.where("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths = sorted(histogram)
    bounds = boundaries(lengths, [histogram[x] for x in lengths], buckets)
    held = {b: sum(n for x, n in histogram.items() if (lo < x <= b)) for lo, b in zip([0, *bounds], bounds)}
    bucket, slices = F.lit(None).cast("bigint"), F.lit(1)
    for b in reversed(bounds):  # the smallest boundary that holds the sequence
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("bigint")).otherwise(bucket)
        slices = F.when(F.col("bucket") == b, F.lit(-(-held[b] // SLICE_ROWS))).otherwise(slices)
    bucket = F.when(F.col("n_tokens") > 0, bucket)
    dealt = (rows.withColumn("bucket", bucket).withColumn("h", F.xxhash64("mark", "piece"))
                 .withColumn("slice", F.pmod(F.shiftright("h", 32), slices.cast("bigint")).cast("int")))
    full = dealt.where("bucket is not null")
    # A bucket's sequences are numbered slice by slice: a slice is a task's
    # work, and only the slices' counts are summed along the bucket.
    per_slice = full.groupBy("bucket", "slice").agg(F.count(F.lit(1)).alias("rows"))
    offsets = per_slice.select("bucket", "slice", (F.sum("rows").over(W.partitionBy("bucket").orderBy("slice")) - F.col("rows")).alias("before"))
    ranked = full.withColumn("rank", F.row_number().over(
        W.partitionBy("bucket", "slice").orderBy("h", "id", "piece", "n_tokens")))
    capacity = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket"))).cast("bigint")
    at = F.col("before") + F.col("rank") - 1
    placed = ranked.join(offsets, ["bucket", "slice"]).select(
        "id", "piece", "start", "n_tokens", "bucket", F.floor(at / capacity).cast("bigint").alias("batch"),
        (at % capacity).cast("int").alias("slot"))
    none = dealt.where("bucket is null").select("id", "piece", "start", "n_tokens", "bucket",
                                                F.lit(None).cast("bigint").alias("batch"), F.lit(None).cast("int").alias("slot"))
    return placed.unionByName(none).withColumnRenamed("id", id_col)
