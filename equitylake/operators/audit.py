"""Counts and spans (AGG2-AGG5), all single-pass aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def date_span(df: DataFrame, column: str = "date", with_rows: bool = False) -> DataFrame:
    """AGG2: first and last date (both null on empty input), optionally the row count."""
    aggs = [F.min(column).alias("first_date"), F.max(column).alias("last_date")]
    if with_rows:
        aggs.append(F.count(F.lit(1)).alias("rows"))
    return df.agg(*aggs)


def rows_by_year(df: DataFrame, column: str = "date") -> DataFrame:
    """AGG3 per calendar year (the unit the backfill loads in)."""
    return (df.groupBy(F.year(column).cast("int").alias("year"))
              .agg(F.count(F.lit(1)).alias("rows")))


def shard_audit(df: DataFrame, part: str, kept: Column) -> DataFrame:
    """AGG4: rows seen and rows kept per shard, plus the running kept total.

    The running total is a window over at most a few dozen shard rows, after
    the per-shard aggregate has collapsed the data.
    """
    per_part = df.groupBy(part).agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(kept).alias("rows_kept"),
    )
    running = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_part.withColumn("kept_so_far", F.sum("rows_kept").over(running))


def ledger_symbols(ledger: DataFrame) -> DataFrame:
    """AGG5: every symbol a ledger has recorded, once."""
    return ledger.select(F.explode("symbols").alias("symbol")).distinct()
