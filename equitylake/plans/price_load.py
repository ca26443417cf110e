"""J2 (refresh prices) and J3 (resumable backfill: stage, then load).

Refresh: landed history documents -> price rows -> one range upsert.

Backfill keeps the reference's two phases, but each phase is one distributed
job instead of a per-symbol loop:

* **stage** picks the symbols not yet in the done-ledger (anti join), assigns
  them to shards of about ``shard_size`` symbols by hash, and in one pass
  over their landed lines writes their rows to a staging table partitioned
  by shard (dynamic overwrite: a retried shard replaces only itself). Rows
  of a malformed history are flagged, not raised; only then are ledger rows
  appended, for every symbol whose landed history staged cleanly (one that
  landed as ``{}`` included, so it is not asked for again). A failed symbol
  is reported and tried again next run; a symbol with nothing landed yet
  stays pending; the others go on.
* **load** upserts the staged rows the ledger records into ``daily_prices``:
  the ledger, written last, is the source of truth, so rows of a failed
  symbol or of a run that crashed before recording are never loaded. The
  month partitioning already bounds each rewrite; no per-year loop is needed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equitylake.operators.audit import ledger_symbols
from equitylake.operators.joins import anti_join, attach, semi_join
from equitylake.functions.text import normalize_symbols
from equitylake.operators.predicates import calendar_year, date_between
from equitylake.sources import files, landed
from equitylake.sources.store import Store
from equitylake.specs import DAILY_PRICES

# The text that rejects a load with nothing staged, and the symbols per staged shard.
NO_SHARDS_MESSAGE = "No staged shards in"
SHARD_SIZE = 100
LEDGER_SCHEMA = "part int, symbols array<string>, rows bigint"
# Staged rows: shaped prices, their feed order, the bad-row flag, the shard.
STAGED_SCHEMA = ("symbol string, date date, open double, high double, low double, close double, "
                 "adj_close double, volume bigint, _landed timestamp, _file string, _block bigint, _row bigint, "
                 "pos int, _bad boolean, part int")
REJECTS_SCHEMA = "symbol string, part int"
# Up to so many pending symbols (a list of short strings on the driver, as long as the landing's own
# listing there) are read by their own directories; beyond it the whole landing is scanned and joined,
# as it is where they are more than a part in LEAST_SHARE of the directories: Spark goes through the
# whole list of paths for each of them.
MAX_DIRECTORIES = 500_000
LEAST_SHARE = 4
# Shard directories of one run: each is a rename on the driver and a file at least, so beyond it shards hold more symbols.
MAX_SHARDS = 1_000


def landed_prices(spark: SparkSession, landing: str, symbols: Iterable[str] | None = None,
                  start: date | None = None, end: date | None = None) -> DataFrame:
    """SRC4 + PRJ6 + SET1: landed histories as price rows with feed order.

    ``symbols`` reads only their directories, so a malformed document of a
    symbol that is not asked for cannot fail the job; ``start`` and ``end``
    bound the dates.
    """
    wanted = normalize_symbols(symbols)
    rows = landed.shape_prices(landed.parse_history_docs(landed.read_history_lines(spark, landing, wanted)))
    bounds = date_between("date", start, end)
    return rows if bounds is None else rows.filter(bounds)


def refresh_prices(store: Store, landing: str, symbols: Iterable[str] | None = None,
                   start: date | None = None, end: date | None = None) -> int:
    """J2: upsert landed histories (all, or of some symbols and days); returns the rows seen before de-duplication."""
    fresh = landed_prices(store.spark, landing, symbols, start, end)
    return store.upsert(DAILY_PRICES, fresh, order=list(landed.PRICE_ORDER))


# ------------------------------------------------------------------ stage
def _ledger_path(staging: str) -> str:
    return f"{staging}/ledger"


def _data_path(staging: str) -> str:
    return f"{staging}/data"


def read_staged(spark: SparkSession, staging: str) -> DataFrame:
    """SRC5: the staging table, read against its declared schema."""
    return spark.read.schema(STAGED_SCHEMA).parquet(_data_path(staging))


def read_ledger(spark: SparkSession, staging: str) -> DataFrame:
    path = _ledger_path(staging)
    if not files.exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _rejects_path(staging: str) -> str:
    return f"{staging}/rejects"


def read_rejects(spark: SparkSession, staging: str) -> DataFrame:
    """(symbol, part) of every symbol set aside, by the shard of the run that met it."""
    path = _rejects_path(staging)
    if not files.exists(spark, path):
        return spark.createDataFrame([], REJECTS_SCHEMA)
    return spark.read.schema(REJECTS_SCHEMA).parquet(path)


def staging_todo(universe_symbols: DataFrame, ledger: DataFrame) -> DataFrame:
    """JN3 + AGG5: symbols still to stage."""
    return anti_join(universe_symbols.select("symbol").distinct(), ledger_symbols(ledger), "symbol")


def stage(spark: SparkSession, universe_symbols: DataFrame, landing: str, staging: str,
          shard_size: int = SHARD_SIZE) -> tuple[int, int]:
    """Stage every symbol not yet in the ledger.

    Returns (symbols recorded, symbols set aside). A symbol with a bad landed
    document is listed in the rejects table (``read_rejects``) and not
    recorded, so ``load`` ignores it and the next run tries it again; the
    others go on.
    """
    ledger = read_ledger(spark, staging)
    # The symbol list is used three times (count, shard rows, ledger rows);
    # keep it cached (lost blocks are simply recomputed from the lineage).
    todo = staging_todo(universe_symbols, ledger).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _stage_todo(spark, todo, ledger, landing, staging, shard_size)
    finally:
        todo.unpersist()


def _stage_todo(spark: SparkSession, todo: DataFrame, ledger: DataFrame, landing: str, staging: str,
                shard_size: int) -> tuple[int, int]:
    n = todo.count()
    if n == 0:
        return 0, 0
    last = ledger.agg(F.max("part")).first()[0]
    first = 0 if last is None else last + 1
    shards = min(max(1, math.ceil(n / shard_size)), MAX_SHARDS)
    todo = todo.withColumn("part", (F.lit(first) + F.pmod(F.xxhash64("symbol"), F.lit(shards))).cast("int"))

    _drop_unrecorded_shards(spark, staging, first)
    # One pass: the pending symbols' lines (restricted before parsing), each
    # tagged with its shard, parsed leniently so bad rows are flagged.
    chosen = n <= MAX_DIRECTORIES and LEAST_SHARE * n <= landed.named_directories(spark, landing)
    wanted = [r["symbol"] for r in todo.select("symbol").collect()] if chosen else None
    lines = attach(landed.read_history_lines(spark, landing, wanted), todo, "symbol", known_rows=n)
    rows = landed.shape_prices(landed.parse_history_docs(lines, strict=False), strict=False, carry=["part"])
    # Rebalance on the shard: about one file per shard, and AQE splits a shard
    # holding a third of the rows over several tasks; no sampling pass over
    # the landing is needed (staging is transient and carries its own order).
    (rows.hint("rebalance", "part").write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy("part").parquet(_data_path(staging)))

    # Per symbol of this run: was anything landed, and did any row fail?
    # (bounded by the universe; a symbol with nothing landed stays pending).
    staged = read_staged(spark, staging).filter(F.col("part") >= first)
    seen = staged.groupBy("symbol").agg(F.max(F.col("_bad").cast("int")).alias("bad"))
    seen = seen.persist(StorageLevel.MEMORY_AND_DISK)
    summary = seen.agg(F.count_if(F.col("bad") == 0).alias("ok"), F.count_if(F.col("bad") == 1).alias("failed")).first()
    ok, failed = int(summary["ok"] or 0), int(summary["failed"] or 0)
    if failed:
        (attach(todo, seen.filter("bad = 1").select("symbol"), "symbol", known_rows=failed).select("symbol", "part")
            .write.mode("append").parquet(_rejects_path(staging)))
    done = attach(todo, seen.filter("bad = 0").select("symbol"), "symbol", known_rows=ok)
    counts = (staged.filter(~F.col("_bad") & F.col("pos").isNotNull())
                    .groupBy("part").agg(F.count(F.lit(1)).alias("rows")))
    entries = (done.groupBy("part").agg(F.array_sort(F.collect_list("symbol")).alias("symbols"))
                   .join(counts, "part", "left")
                   .select("part", "symbols", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")))
    entries.write.mode("append").parquet(_ledger_path(staging))
    seen.unpersist()
    return ok, failed


def _drop_unrecorded_shards(spark: SparkSession, staging: str, first: int) -> None:
    """Remove shard directories a crashed run wrote but never recorded."""
    for name in files.list_dirs(spark, _data_path(staging), "part="):
        if int(name[5:]) >= first:
            files.delete(spark, f"{_data_path(staging)}/{name}")


# ------------------------------------------------------------------- load
def load(store: Store, staging: str, year: int | None = None) -> int:
    """J3 load (SNK7): upsert every recorded staged row; returns the rows loaded.

    Only (shard, symbol) pairs the ledger records are loaded, so rows of a
    symbol that failed, or of a run that crashed before recording, never
    reach the table. One upsert covers all years: the month partitions
    already bound each rewrite. ``year`` loads a single calendar year (FLT12),
    for callers that want to spread a very large backfill over commits.
    """
    spark = store.spark
    if not files.list_dirs(spark, _data_path(staging), "part="):
        raise RuntimeError(f"{NO_SHARDS_MESSAGE} {staging}")
    recorded = read_ledger(spark, staging).select("part", F.explode("symbols").alias("symbol"))
    staged = semi_join(read_staged(spark, staging), recorded, ["part", "symbol"]).filter(F.col("pos").isNotNull())
    if year is not None:
        staged = staged.filter(calendar_year("date", year))
    return store.upsert(DAILY_PRICES, staged, order=["part", *landed.PRICE_ORDER])
