"""Turns of conversations in order, however long a conversation is.

Turns are range-partitioned, so one conversation may lie in many tasks, and
cut into segments of bounded length: a segment's rows are contiguous in one
partition, and the segments of a conversation, by number, are in its order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SEGMENT_TURNS = 1024
#: What string functions strip: the ASCII white space.
BLANKS = " \t\n\x0b\x0c\r"


def _numbered(batches: Iterator[pa.RecordBatch], size: int, said: int) -> Iterator[pa.RecordBatch]:
    task, number, conv, place, seen = TaskContext.get().partitionId() << 40, 0, None, 0, set()
    for batch in batches:
        numbers, places, again = [], [], []
        values = batch.column(said).to_pylist()
        for key, value in zip(batch.column(0).to_pylist(), values):
            if not number or key != conv or place >= size:
                number, conv, place, seen = number + 1, key, 0, set()
            numbers.append(task + number)
            places.append(place)
            again.append(value is not None and value in seen)
            seen.add(value)
            place += 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(numbers, pa.int64()), pa.array(places, pa.int32()), pa.array(again, pa.bool_())],
            names=[*batch.schema.names, "segment", "place", "again"])


def in_order(rows: DataFrame, order: Sequence[str], said: str, size: int = SEGMENT_TURNS) -> DataFrame:
    """``rows``, sorted by the first column, the conversation, then ``order`` (nulls first), with segment, place in it, and
    again: whether an earlier row of the segment holds the same (non-null) value of the column ``said``."""
    by = [rows.columns[0], *order]
    at = rows.columns.index(said)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return (rows.repartitionByRange(*by).sortWithinPartitions(*by)
                .mapInArrow(lambda b: _numbered(b, size, at), f"{schema}, segment bigint, place int, again boolean"))


def long_ones(numbered: DataFrame) -> DataFrame:
    """(conversation, segment, n, offset, last) of the conversations with several segments, few of all: one row per segment."""
    key = numbered.columns[0]
    whole = Window.partitionBy(key)
    before = whole.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (numbered.groupBy(key, "segment").agg(F.count(F.lit(1)).alias("n"))
                    .select(key, "segment", "n", F.count(F.lit(1)).over(whole).alias("all"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                            F.lead("segment").over(whole.orderBy("segment")).isNull().alias("last"))
                    .where("all > 1").drop("all"))
