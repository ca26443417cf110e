"""STR1: incremental landing ingest as a Structured Streaming query.

The file source picks up only history documents it has not seen (its
checkpoint records every file taken), ``trigger(availableNow=True)`` drains
what is there and stops, and each micro-batch is one range upsert into
``daily_prices``. A rerun with no new file runs no batch. A batch replayed
after a crash rewrites the same partitions with the same rows, because the
upsert is idempotent, so the sink is effectively exactly-once.

Late data needs no watermark: an old date simply lands in an old partition.
Order: a later batch wins over an earlier one; inside a batch the landing
time, file and position decide (cap batch size with ``maxFilesPerTrigger``).

A micro-batch is evaluated once: its parsed rows, those of bad documents
marked, are written to the checkpoint folder, and rejects and upsert read them
there. ``archive`` moves files whose batch is done out of the landing, so that
the listing of each batch does not grow with all that has ever landed.

A bad document (torn, of a wrong type, with an entry that has no date) does
not stop the others: it goes to the rejects table, one folder per batch, so a
replayed batch replaces its own rejects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from equitylake.operators.joins import once
from equitylake.sources import files, landed
from equitylake.sources.store import Store
from equitylake.specs import DAILY_PRICES


def start_landing_ingest(spark: SparkSession, store: Store, landing: str, checkpoint: str,
                         max_files_per_trigger: int | None = None,
                         processing_time: str | None = None, archive: str | None = None) -> StreamingQuery:
    """Start the ingest. By default it drains what has landed and stops
    (``availableNow``); with ``processing_time`` (e.g. ``"1 hour"``) it keeps
    running and picks up new landings on that cadence. ``archive`` names a
    folder outside the landing, on its file system; done files go there when a
    later batch starts, under their old path."""
    rejects = rejects_path(store)
    reader = spark.readStream.schema("value string, symbol string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    symbol, document = landed.named_line()
    lines = reader.text(landing).select(document.alias("value"), symbol.alias("symbol"),
                                        F.col("_metadata.file_modification_time").alias("_landed"),
                                        F.col("_metadata.file_path").alias("_file"),
                                        F.col("_metadata.file_block_start").alias("_block"))

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        docs = landed.parse_history_docs(batch.withColumn("_row", F.monotonically_increasing_id()), strict=False)
        rows = once(landed.shape_prices(docs, strict=False))  # a bad document is one row, marked
        (rows.filter("_bad").select("symbol", "_file", "_block", "_row", "_landed")
             .write.mode("overwrite").parquet(f"{rejects}/batch={epoch_id}"))
        fresh = rows.filter(~F.col("_bad") & F.col("pos").isNotNull())
        store.upsert(DAILY_PRICES, fresh, order=list(landed.PRICE_ORDER), computed=True)

    writer = lines.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start()


REJECTS_SCHEMA = "symbol string, _file string, _block bigint, _row bigint, _landed timestamp, batch int"


def rejects_path(store: Store) -> str:
    return f"{store.root}/_rejected_histories"


def read_rejects(store: Store) -> DataFrame:
    """The bad documents the stream has met: where each one is, and its batch."""
    path = rejects_path(store)
    if not files.list_dirs(store.spark, path, "batch="):
        return store.spark.createDataFrame([], REJECTS_SCHEMA)
    return store.spark.read.schema(REJECTS_SCHEMA).parquet(path)


def ingest_available(spark: SparkSession, store: Store, landing: str, checkpoint: str,
                     max_files_per_trigger: int | None = None, archive: str | None = None) -> None:
    """Run the stream until everything landed so far is ingested."""
    query = start_landing_ingest(spark, store, landing, checkpoint, max_files_per_trigger, archive=archive)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
