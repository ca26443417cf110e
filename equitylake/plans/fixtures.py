"""Views over the driver's generated tables that stand in for the vendor feeds.

Each view is derived by Spark from the given parquet tables, so its work
grows with them. The same views are written as SQL for the DuckDB oracle in
``equitylake.plans.oracle``; the two must stay in step.

F1 price feed (repeated keys on purpose), F2 universe, F3 typed statements,
F4 raw statement text, F5 raw listing profiles, F7 a long price history
(one row per order, about 80 monthly partitions). F6, the landed price
histories, is written from F1 by ``sources.landed.write_price_histories``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equitylake.operators.latest import latest_wins


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _u(c: str):
    return F.concat(F.lit("U"), F.col(c).cast("string"))


def price_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one price row per event; ``seq`` is the feed order, ``feed`` the
    event type (used to split a stored part from a fresh part)."""
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        _u("user_id").alias("symbol"),
        F.col("ts").cast("date").alias("date"),
        v.alias("open"), (v + 1).alias("high"), (v - 1).alias("low"), v.alias("close"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("double")).otherwise(v * 0.97).alias("adj_close"),
        (F.col("event_id") * 10).cast("bigint").alias("volume"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("feed"),
    )


def universe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one listing per customer (``last_updated`` is stamped by the caller)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        _u("c_custkey").alias("symbol"),
        F.col("c_name").alias("company_name"),
        F.when(k % 5 == 0, "etf").otherwise("common").alias("security_type"),
        F.when(k % 3 == 0, "NASDAQ").when(k % 3 == 1, "NYSE").otherwise("AMEX").alias("exchange"),
        F.lit(None).cast("string").alias("exchange_full_name"),
        F.col("c_mktsegment").alias("sector"),
        F.when(k % 4 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Industry "), (k % 4).cast("string"))).alias("industry"),
        F.col("n_name").alias("country"),
        F.lit("USD").alias("currency"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal")).alias("market_cap"),
        F.lit(1.1).cast("double").alias("beta"),
        F.lit(100.0).cast("double").alias("price"),
        F.date_add(F.lit("1980-01-01").cast("date"), k.cast("int")).alias("ipo_date"),
        F.lit(None).cast("string").alias("cik"),
        F.lit(None).cast("string").alias("isin"),
        F.lit(None).cast("string").alias("cusip"),
        (k % 5 == 0).alias("is_etf"),
        F.lit(False).alias("is_fund"),
        (F.col("c_nationkey") % 7 == 0).alias("is_adr"),
    )


def statements_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one quarterly statement row per order."""
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        d.cast("date").alias("date"),
        _u("o_custkey").alias("symbol"),
        F.year(d).cast("int").alias("fiscal_year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("period"),
        F.lit("USD").alias("reported_currency"),
        d.alias("accepted_date"),
        F.col("o_totalprice").alias("revenue"),
        F.col("o_orderkey").alias("seq"),
    )


def statements_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 annual: the last order of each customer and year, as period FY."""
    q = statements_quarterly(spark, sf_dir)
    return latest_wins(q, ["symbol", "fiscal_year"], ["seq"]).withColumn("period", F.lit("FY"))


def statement_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw text rows with bad dates, padded symbols, junk numbers, and a
    second copy of every fifth order in the next fiscal-year bucket."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    # Each order once, plus a copy in the next bucket for every fifth order:
    # a narrow explode, no join.
    rows = o.withColumn("shift", F.explode(F.array(F.lit(0), F.lit(1)))) \
            .filter((F.col("shift") == 0) | (k % 5 == 0))
    return rows.select(
        F.when(k % 17 == 0, "bad").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date"),
        F.when(k % 13 == 0, F.concat(F.lit(" u"), F.col("o_custkey").cast("string"), F.lit("\t")))
         .otherwise(_u("o_custkey")).alias("symbol"),
        (F.year("o_orderdate") + F.col("shift")).cast("string").alias("fiscalYear"),
        F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("period"),
        F.when(k % 19 == 0, "n/a").otherwise((F.col("o_totalprice") + F.col("shift")).cast("string")).alias("revenue"),
        (k * 2 + F.col("shift")).alias("seq"),
    )


def profile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw listing profiles covering every classifier branch and filter,
    with every twentieth part repeated in a later shard."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    rows = p.withColumn("dup", F.explode(F.array(F.lit(0), F.lit(1)))) \
            .filter((F.col("dup") == 0) | (k % 20 == 0))

    def letter(div: int):
        return F.chr((F.lit(65) + F.floor(k / div) % 26).cast("int"))

    suffix = (F.when(k % 12 == 1, "-WT").when(k % 12 == 2, "-UN").when(k % 12 == 3, "-PD")
              .when(k % 12 == 4, "-B").when(k % 12 == 5, "W").when(k % 12 == 6, "R")
              .when(k % 12 == 7, "U").when(k % 12 == 8, "Z").when(k % 12 == 9, "-")
              .when(k % 12 == 10, "-RT").when(k % 12 == 11, "-WS").otherwise(""))
    return rows.select(
        F.concat(F.chr((F.lit(65) + k % 26).cast("int")), letter(26), letter(676), letter(17576), suffix).alias("symbol"),
        F.concat(F.col("p_name"), F.when(k % 24 == 8, " 8.75% Series H").otherwise("")).alias("company_name"),
        F.when(k % 5 == 0, "NASDAQ").when(k % 5 == 1, "nyse").when(k % 5 == 2, "AMEX")
         .when(k % 5 == 3, "HKSE").otherwise(" NYSE ").alias("exchange"),
        F.when(k % 7 == 0, "Shell Companies").when(k % 7 == 1, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("industry"),
        F.when(k % 10 == 3, "n/a").when(k % 10 == 4, " ")
         .otherwise((F.col("p_retailprice") * 1000).cast("string")).alias("market_cap"),
        F.when(k % 10 == 4, "42.5").otherwise(F.lit(None).cast("string")).alias("mkt_cap"),
        F.when(k % 6 == 0, "1990-01-02 00:00:00").when(k % 6 == 1, "unknown").otherwise("2001-09-04").alias("ipo_date"),
        F.when(k % 8 == 0, "TRUE").otherwise("false").alias("is_etf"),
        F.when(k % 16 == 3, "1").otherwise("").alias("is_fund"),
        F.when(k % 9 == 5, "false").when(k % 9 == 6, "no").when(k % 9 == 7, "maybe")
         .when(k % 9 == 8, F.lit(None).cast("string")).when(k % 9 == 1, "1").when(k % 9 == 2, " Yes ")
         .otherwise("true").alias("is_actively_trading"),
        F.when(F.col("dup") == 1, 9).otherwise(k % 4).cast("int").alias("part"),
        (k * 2 + F.col("dup")).alias("seq"),
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a long price history (one row per order, ~80 monthly partitions)."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        _u("o_custkey").alias("symbol"),
        F.col("o_orderdate").cast("date").alias("date"),
        price.alias("open"), price.alias("high"), price.alias("low"), price.alias("close"),
        (price * 0.97).alias("adj_close"),
        F.col("o_orderkey").alias("volume"),
        F.col("o_orderkey").alias("seq"),
    )
