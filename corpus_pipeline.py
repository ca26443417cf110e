"""The corpus pipeline: quality, line dedup, near-duplicates, personal data, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equitylake.llm import linededup, packing, pii, quality, simhash
from equitylake.llm.common import table
from equitylake.session import scratch_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model of ``labels`` rates good, at even odds or better."""
    model = quality.fit(docs, quality.graded(table(spark, sf_dir, "labels")), n_grades=3)
    return quality.select(docs, model, grade=2)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points that five documents share go, but in the largest of them."""
    index = linededup.line_index(spark, docs)
    return (linededup.dedup_lines(docs, index.decide())
                     .withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group within two bits of 3-word SimHash stays."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data is replaced by its kind."""
    return pii.redact(docs, chars_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences in length buckets and token-budget batches."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack),
]

#: SQL has no SimHash and no model fitting: the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    folder = scratch_dir(spark, "corpus-pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
