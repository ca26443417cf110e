"""SRT1: where a row stands in an ordered frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from equitylake.operators.joins import once

#: Below it, the row in its partition; above it, the partition (as ``monotonically_increasing_id`` puts them).
_ROW_BITS = 33


def with_row_number(ordered: DataFrame, name: str = "row_number") -> DataFrame:
    """``ordered`` with the number (from 1) at which each row comes out of it: rows of a partition follow those of all before.

    No row moves: each partition counts its rows, and the sums over the
    partitions before (as many numbers as there are partitions) are broadcast.
    """
    placed = once(ordered.withColumn("__id", F.monotonically_increasing_id()))
    part = F.shiftright("__id", _ROW_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
                    .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")))
    row = F.col("__id") - F.call_function("shiftleft", F.col("__part"), F.lit(_ROW_BITS))
    return (placed.withColumn("__part", part).join(F.broadcast(starts), "__part")
                  .select(*[F.col(f"`{c}`") for c in ordered.columns], (F.col("__start") + row + 1).alias(name)))
