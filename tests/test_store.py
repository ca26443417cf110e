"""Store behaviour: typed empties, round trips, latest-wins upserts, pushed-down reads."""

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equitylake.sources.store import Store
from equitylake.specs import DAILY_PRICES, TICKER_UNIVERSE, statement_table

PRICE_DDL = "symbol string, date date, open double, high double, low double, close double, adj_close double, volume bigint"


def price_rows(spark, rows):
    """rows: (symbol, day, close) -> full price rows, adj_close = close * 0.97."""
    return spark.createDataFrame(
        [(s, d, c, c, c, c, c * 0.97, 100) for s, d, c in rows], PRICE_DDL)


def universe_row(symbol, **over):
    row = dict(symbol=symbol, company_name=f"{symbol} Inc.", security_type="common", exchange="NASDAQ",
               exchange_full_name=None, sector="Technology", industry="Software", country="US",
               currency="USD", market_cap=1e9, beta=1.0, price=10.0, ipo_date=date(2000, 1, 1),
               cik="0000320193", isin=None, cusip=None, is_etf=False, is_fund=False, is_adr=False,
               last_updated=datetime(2026, 3, 22, tzinfo=timezone.utc))
    row.update(over)
    return row


def universe_frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in TICKER_UNIVERSE.columns) for r in rows],
                                 TICKER_UNIVERSE.schema)


def collect(df):
    return [tuple(r) for r in df.collect()]


def test_never_written_table_reads_typed_empty(store):
    df = store.read(DAILY_PRICES)
    assert df.count() == 0
    assert df.schema == DAILY_PRICES.schema
    sub = store.read(DAILY_PRICES, columns=["close"])
    assert sub.columns == ["symbol", "date", "close"]


def test_dtype_round_trip(spark, store):
    store.write(TICKER_UNIVERSE, universe_frame(spark, [universe_row("AAPL")]))
    back = store.read(TICKER_UNIVERSE)
    assert back.schema == TICKER_UNIVERSE.schema
    row = back.first()
    assert row.cik == "0000320193"  # leading zeros kept: text
    assert row.ipo_date == date(2000, 1, 1)
    assert row.exchange_full_name is None


def test_write_replaces_and_reads_in_key_order(spark, store):
    store.write(DAILY_PRICES, price_rows(spark, [("MSFT", date(2024, 1, 2), 2.0), ("AAPL", date(2024, 1, 2), 1.0),
                                                 ("AAPL", date(2024, 1, 1), 0.5)]))
    assert [(r.date, r.symbol) for r in store.read(DAILY_PRICES).collect()] == [
        (date(2024, 1, 1), "AAPL"), (date(2024, 1, 2), "AAPL"), (date(2024, 1, 2), "MSFT")]
    store.write(DAILY_PRICES, price_rows(spark, [("NVDA", date(2025, 5, 5), 3.0)]))
    assert [r.symbol for r in store.read(DAILY_PRICES).collect()] == ["NVDA"]


def test_write_does_not_dedupe(spark, store):
    day = date(2024, 1, 1)
    store.write(DAILY_PRICES, price_rows(spark, [("AAPL", day, 1.0), ("AAPL", day, 2.0)]))
    assert store.read(DAILY_PRICES).count() == 2


def test_upsert_latest_wins(spark, store):
    day = date(2024, 3, 1)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 1.0)]))
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 5.0)]))
    rows = store.read(DAILY_PRICES).collect()
    assert len(rows) == 1 and rows[0].close == 5.0


def test_upsert_keeps_last_duplicate_inside_fresh(spark, store):
    day = date(2024, 3, 1)
    fresh = price_rows(spark, [("AAPL", day, 1.0), ("AAPL", day, 2.0), ("AAPL", day, 3.0)]) \
        .withColumn("seq", F.col("close") * -1)
    store.upsert(DAILY_PRICES, fresh, order=["seq"])
    assert store.read(DAILY_PRICES).first().close == 1.0


def test_neighbour_symbol_on_same_date_survives(spark, store):
    day = date(2024, 3, 1)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 1.0), ("MSFT", day, 2.0)]))
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 9.0)]))
    assert {(r.symbol, r.close) for r in store.read(DAILY_PRICES).collect()} == {("AAPL", 9.0), ("MSFT", 2.0)}


def test_upsert_touches_only_its_months(spark, store):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0), ("AAPL", date(2024, 6, 5), 2.0)]))
    before = store.data_paths(DAILY_PRICES)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 6, 5), 3.0)]))
    after = store.data_paths(DAILY_PRICES)
    assert before[0] == after[0] and before[0].endswith("/pmonth=202401")  # January was not rewritten
    assert before[1] != after[1]
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [1.0, 3.0]


def test_empty_upsert_is_noop(spark, store):
    empty = spark.createDataFrame([], PRICE_DDL)
    assert store.upsert(DAILY_PRICES, empty) == 0
    assert not store.exists(DAILY_PRICES)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 1), 1.0)]))
    store.upsert(DAILY_PRICES, empty)
    assert store.read(DAILY_PRICES).count() == 1


def test_fresh_frame_without_column_nulls_it(spark, store):
    day = date(2024, 1, 2)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 1.0)]))
    fresh = price_rows(spark, [("AAPL", day, 2.0)]).drop("adj_close")
    store.upsert(DAILY_PRICES, fresh)
    row = store.read(DAILY_PRICES).first()
    assert row.close == 2.0 and row.adj_close is None


def test_quarter_of_prices_range_reads_and_leap_day(spark, store):
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(91)]
    rows = [(s, d, float(i)) for d in days for i, s in enumerate(["AAPL", "MSFT", "NVDA"])]
    store.upsert(DAILY_PRICES, price_rows(spark, rows))
    leap = store.read(DAILY_PRICES, start=date(2024, 2, 29), end=date(2024, 2, 29))
    assert leap.count() == 3
    feb = store.read(DAILY_PRICES, symbols=["msft "], start=date(2024, 2, 1), end=date(2024, 2, 29))
    assert feb.count() == 29 and {r.symbol for r in feb.collect()} == {"MSFT"}
    assert store.read(DAILY_PRICES, start=date(2024, 3, 30)).count() == 6
    assert store.read(DAILY_PRICES, end=date(2024, 1, 1)).count() == 3


def test_symbol_arguments(spark, store):
    day = date(2024, 1, 2)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 1.0), ("MSFT", day, 2.0)]))
    assert store.read(DAILY_PRICES, symbols=" aapl ").count() == 1  # bare string = one symbol
    assert store.read(DAILY_PRICES, symbols=[]).count() == 0
    assert store.read(DAILY_PRICES, symbols=["", "  "]).count() == 0
    assert store.read(DAILY_PRICES, symbols=None).count() == 2


def test_where_and_symbols_combine(spark, store):
    day = date(2024, 1, 2)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 1.0), ("MSFT", day, 2.0), ("NVDA", day, 3.0)]))
    df = store.read(DAILY_PRICES, symbols=["AAPL", "NVDA"], where=F.col("close") > 2)
    assert [r.symbol for r in df.collect()] == ["NVDA"]


def test_unknown_column_error_is_sorted_and_first(spark, store):
    with pytest.raises(ValueError, match=r"daily_prices has no column\(s\): \['bogus', 'nope'\]"):
        store.read(DAILY_PRICES, columns=["nope", "close", "bogus"], symbols=[])


def test_column_subset_adds_key_in_declared_order(spark, store):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 2), 1.0)]))
    assert store.read(DAILY_PRICES, columns=["volume", "close"]).columns == ["symbol", "date", "close", "volume"]


def test_date_range_on_untimed_table_raises(spark, store):
    with pytest.raises(ValueError, match="not a time index"):
        store.write(TICKER_UNIVERSE, universe_frame(spark, [universe_row("AAPL")]))
        store.read(TICKER_UNIVERSE, start=date(2024, 1, 1))
    # ...but only once the table exists and symbols are non-empty.
    assert store.read(TICKER_UNIVERSE, symbols=[], start=date(2024, 1, 1)).count() == 0


def test_keyed_upsert_versions_universe(spark, store):
    store.write(TICKER_UNIVERSE, universe_frame(spark, [universe_row("AAPL"), universe_row("MSFT")]))
    store.upsert(TICKER_UNIVERSE, universe_frame(spark, [universe_row("MSFT", price=99.0), universe_row("XOM")]))
    got = {r.symbol: r.price for r in store.read(TICKER_UNIVERSE).collect()}
    assert got == {"AAPL": 10.0, "MSFT": 99.0, "XOM": 10.0}
    assert store._versions(TICKER_UNIVERSE) == [1, 2]


def test_restated_statement_period_replaces_row(spark, store):
    spec = statement_table("income_statement", "annual")
    base = spark.createDataFrame([(date(2023, 9, 30), "AAPL", 2023, "FY", 100.0)],
                                 "date date, symbol string, fiscal_year int, period string, revenue double")
    store.upsert(spec, base)
    store.upsert(spec, base.withColumn("revenue", F.lit(110.0)))
    rows = store.read(spec).collect()
    assert len(rows) == 1 and rows[0].revenue == 110.0 and rows[0].net_income is None


def test_nan_is_stored_as_null(spark, store):
    store.write(TICKER_UNIVERSE, universe_frame(spark, [universe_row("AAPL", market_cap=float("nan"))]))
    assert store.read(TICKER_UNIVERSE).first().market_cap is None


def test_plan_prunes_partitions_and_pushes_symbols(spark, store):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 2), 1.0), ("AAPL", date(2024, 5, 2), 1.0)]))
    df = store.read(DAILY_PRICES, symbols=["AAPL"], start=date(2024, 5, 1), columns=["close"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pmonth" in plan and "202405" in plan
    assert "PushedFilters: [IsNotNull(symbol), In(symbol, [AAPL])" in plan or "EqualTo(symbol,AAPL)" in plan
    assert "ReadSchema: struct<symbol:string,date:date,close:double>" in plan
    assert df.count() == 1


def test_upsert_adds_a_new_month_partition(spark, store):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0)]))
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 2, 5), 2.0), ("MSFT", date(2024, 1, 5), 3.0)]))
    got = [(r.date, r.symbol, r.close) for r in store.read(DAILY_PRICES).collect()]
    assert got == [(date(2024, 1, 5), "AAPL", 1.0), (date(2024, 1, 5), "MSFT", 3.0), (date(2024, 2, 5), "AAPL", 2.0)]


def test_table_written_empty_then_upserted(spark, store):
    store.write(DAILY_PRICES, spark.createDataFrame([], PRICE_DDL))
    assert store.exists(DAILY_PRICES) and store.read(DAILY_PRICES).count() == 0
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0)]))
    assert store.read(DAILY_PRICES).count() == 1


def test_replace_keeps_two_versions(spark, store):
    store.retain_seconds = 0
    for close in (1.0, 2.0, 3.0):
        store.write(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), close)]))
    assert store._versions(DAILY_PRICES) == [2, 3]
    assert store.read(DAILY_PRICES).first().close == 3.0


def test_crashed_write_is_invisible_and_never_reused(spark, store, tmp_path):
    store.retain_seconds = 0
    store.write(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0)]))
    partial = tmp_path / "store" / "daily_prices" / "v=000002"
    partial.mkdir()
    (partial / "part-00000.parquet").write_bytes(b"torn")  # no _SUCCESS: a crashed write
    assert store.read(DAILY_PRICES).first().close == 1.0
    store.write(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 2.0)]))
    assert store._versions(DAILY_PRICES) == [1, 3]
    assert not partial.exists()  # leftover older than the newest commit is pruned
    assert store.read(DAILY_PRICES).first().close == 2.0


def test_long_symbol_list_uses_a_broadcast_semi_join(spark, store, monkeypatch):
    from equitylake.sources import store as store_module
    day = date(2024, 1, 2)
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", day, 1.0), ("MSFT", day, 2.0), ("NVDA", day, 3.0)]))
    monkeypatch.setattr(store_module, "MAX_IN_LIST", 2)
    df = store.read(DAILY_PRICES, symbols=["aapl", "NVDA", "XOM"])
    assert [r.symbol for r in df.collect()] == ["AAPL", "NVDA"]
    assert "LeftSemi" in df._jdf.queryExecution().executedPlan().toString()


def test_a_frame_read_before_an_upsert_keeps_its_rows(spark, store):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0), ("AAPL", date(2024, 2, 5), 2.0)]))
    held = store.read(DAILY_PRICES)
    for close in (7.0, 8.0, 9.0):
        store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 2, 5), close)]))
    assert [r.close for r in held.collect()] == [1.0, 2.0]
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [1.0, 9.0]


def test_superseded_partitions_are_deleted_after_their_time(spark, store, tmp_path):
    store.retain_seconds = 0
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0), ("AAPL", date(2024, 2, 5), 2.0)]))
    for close in (7.0, 8.0, 9.0):
        store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 2, 5), close)]))
    table = tmp_path / "store" / "daily_prices"
    assert sorted(str(p.relative_to(table)) for p in table.glob("v=*/pmonth=*")) == [
        "v=000001/pmonth=202401", "v=000003/pmonth=202402", "v=000004/pmonth=202402"]
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [1.0, 9.0]


def test_a_crashed_upsert_is_invisible(spark, store, monkeypatch):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0)]))

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_commit", crash)
        with pytest.raises(OSError):
            store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 5.0)]))
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [1.0]
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 6.0)]))
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [6.0]


def test_two_writers_conflict_loudly(spark, store, monkeypatch):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0)]))
    other = Store(spark, store.root)
    plain = store._write_dirs

    def slow(spec, frame):
        monkeypatch.setattr(store, "_write_dirs", plain)
        other.upsert(DAILY_PRICES, price_rows(spark, [("MSFT", date(2024, 1, 5), 2.0)]))
        return plain(spec, frame)

    monkeypatch.setattr(store, "_write_dirs", slow)
    with pytest.raises(RuntimeError, match="another job"):
        store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 9.0)]))
    assert {(r.symbol, r.close) for r in store.read(DAILY_PRICES).collect()} == {("AAPL", 1.0), ("MSFT", 2.0)}



def test_tables_are_queryable_from_spark_sql(spark, store):
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0), ("MSFT", date(2024, 2, 5), 2.0)]))
    assert store.register_views() == ["daily_prices"]
    df = spark.sql("SELECT symbol, close FROM daily_prices WHERE pmonth = 202402")
    assert [(r.symbol, r.close) for r in df.collect()] == [("MSFT", 2.0)]
    assert "PartitionFilters: [isnotnull(pmonth" in df._jdf.queryExecution().executedPlan().toString()


def test_adding_a_declared_column_needs_no_migration(spark, store):
    from equitylake.specs import TableSpec
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0)]))
    wider = TableSpec(DAILY_PRICES.name, T.StructType(DAILY_PRICES.schema.fields + [T.StructField("vwap", T.DoubleType())]),
                      DAILY_PRICES.key, DAILY_PRICES.grain)
    row = store.read(wider).first()
    assert row.close == 1.0 and row.vwap is None
    fresh = price_rows(spark, [("AAPL", date(2024, 1, 6), 2.0)]).withColumn("vwap", F.lit(2.5))
    store.upsert(wider, fresh)
    assert [(r.close, r.vwap) for r in store.read(wider).collect()] == [(1.0, None), (2.0, 2.5)]


def test_order_may_be_a_column_of_the_table(spark, store):
    early, late = datetime(2026, 1, 1, tzinfo=timezone.utc), datetime(2026, 2, 1, tzinfo=timezone.utc)
    fresh = universe_frame(spark, [universe_row("AAPL", price=2.0, last_updated=late),
                                   universe_row("AAPL", price=1.0, last_updated=early)])
    store.upsert(TICKER_UNIVERSE, fresh, order=["last_updated"])
    rows = store.read(TICKER_UNIVERSE).collect()
    assert store.read(TICKER_UNIVERSE).columns == TICKER_UNIVERSE.columns
    assert [(r.price, r.last_updated) for r in rows] == [(2.0, late.replace(tzinfo=None))]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_into_keyed_directories_leaves_stored_rows_unshuffled(spark, store, monkeypatch):
    days = [date(2024, 1, d) for d in range(1, 29)]
    store.upsert(DAILY_PRICES, price_rows(spark, [(s, d, 1.0) for s in ("AAPL", "MSFT") for d in days]))
    plans = []
    plain = store._write_dirs
    monkeypatch.setattr(store, "_write_dirs", lambda spec, frame: plans.append(physical(frame)) or plain(spec, frame))
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 9.0), ("XOM", date(2024, 1, 5), 2.0)]))
    assert "LeftAnti" in plans[0]
    stored_side = plans[0][plans[0].find("LeftAnti"):plans[0].find("FileScan parquet")]
    assert "Exchange" not in stored_side and "Window" not in stored_side
    got = {(r.symbol, r.date): r.close for r in store.read(DAILY_PRICES).collect()}
    assert len(got) == 57 and got["AAPL", date(2024, 1, 5)] == 9.0 and got["MSFT", date(2024, 1, 5)] == 1.0


def test_duplicates_that_write_keeps_go_only_inside_the_span(spark, store):
    early, late = date(2024, 1, 5), date(2024, 1, 20)
    twice = [("AAPL", d, c) for d in (early, late) for c in (1.0, 2.0)] + [("MSFT", early, 3.0), ("MSFT", early, 4.0)]
    store.write(DAILY_PRICES, price_rows(spark, twice))
    store.upsert(DAILY_PRICES, price_rows(spark, [("AAPL", early, 9.0)]))
    rows = [(r.symbol, r.date) for r in store.read(DAILY_PRICES).collect()]
    assert sorted(rows) == [("AAPL", early), ("AAPL", late), ("AAPL", late), ("MSFT", early)]
    # The directory may still hold duplicates, so a later upsert looks for them again.
    store.upsert(DAILY_PRICES, price_rows(spark, [("XOM", late, 9.0), ("XOM", date(2024, 2, 1), 1.0)]))
    rows = [(r.symbol, r.date) for r in store.read(DAILY_PRICES).collect()]
    assert sorted(rows) == [("AAPL", early), ("AAPL", late), ("MSFT", early), ("XOM", late), ("XOM", date(2024, 2, 1))]
    assert store._manifest(DAILY_PRICES, 3)[1] == {"v=000003/pmonth=202402"}


def test_write_counts_its_rows(spark, store):
    assert store.write(DAILY_PRICES, price_rows(spark, [("AAPL", date(2024, 1, 5), 1.0), ("AAPL", date(2024, 2, 5), 2.0)])) == 2
    assert store.write(DAILY_PRICES, store.empty(DAILY_PRICES)) == 0


def test_date_condition_in_where_prunes_directories(spark, store):
    rows = [(s, date(2024, m, d), float(m)) for m in range(1, 13) for d in (1, 15, 28) for s in ("AAPL", "MSFT")]
    store.upsert(DAILY_PRICES, price_rows(spark, rows))
    for where, n, prunes in ((F.col("date") >= date(2024, 11, 15), 10, True), ((F.col("date") == date(2024, 3, 1)) & (F.col("close") > 1), 2, True),
                             (F.col("date").between(date(2024, 2, 28), date(2024, 3, 1)), 4, True), (F.col("date").isNull(), 0, False),
                             ((F.col("date") > date(2024, 12, 1)) | (F.col("close") == 1.0), 4 + 6, False)):
        df = store.read(DAILY_PRICES, where=where, ordered=False)
        assert df.count() == n
        assert not prunes or "PartitionFilters: [isnotnull(pmonth" in physical(df) and "dynamicpruning" in physical(df)
    narrow = store.read(DAILY_PRICES, where=F.col("date") >= date(2024, 11, 15), ordered=False)
    narrow.collect()
    scan = narrow._jdf.queryExecution().executedPlan().collectLeaves()
    files_read = [scan.apply(i).metrics().get("numFiles").get().value() for i in range(scan.size()) if scan.apply(i).metrics().contains("numFiles")]
    assert sum(files_read) <= 8  # of twelve months' files, two months'


def test_ordered_reads_need_no_global_exchange(spark, store, monkeypatch):
    from equitylake.sources import store as store_module
    rows = [(s, date(2024, m, d), float(m)) for m in range(1, 7) for d in (28, 1, 15) for s in ("MSFT", "AAPL", "XOM")]
    store.write(DAILY_PRICES, price_rows(spark, rows).repartition(5))
    want = sorted((d, s) for s, d, _ in rows)
    for bound, exchanges in ((store_module.ORDERED_BYTES, 0), (1 << 13, 0), (10, 6)):
        monkeypatch.setattr(store_module, "ORDERED_BYTES", bound)
        df = store.read(DAILY_PRICES)
        assert physical(df).count("Exchange rangepartitioning") == exchanges
        assert [(r.date, r.symbol) for r in df.collect()] == want
    assert [r.date for r in store.read(DAILY_PRICES, start=date(2024, 3, 2), end=date(2024, 4, 1), symbols="xom").collect()] == [
        date(2024, 3, 15), date(2024, 3, 28), date(2024, 4, 1)]
    assert store.read(DAILY_PRICES, start=date(2030, 1, 1)).collect() == []


def test_an_ordered_read_is_bounded_by_its_rows_in_memory(spark, store, monkeypatch):
    """Rows that take next to nothing stored are still sorted by more than one task."""
    from equitylake.sources import store as store_module
    rows = spark.range(6000).selectExpr("concat('S', lpad(id % 2000, 4, '0')) AS symbol", "add_months(date'2024-01-31', -CAST(id % 3 AS int)) AS date",
                                        "1D AS open", "1D AS high", "1D AS low", "1D AS close", "1D AS adj_close", "1L AS volume")
    store.write(DAILY_PRICES, rows)
    want = sorted((r.date, r.symbol) for r in rows.collect())
    monkeypatch.setattr(store_module, "ORDERED_MEMORY", 100_000)  # of about 900,000
    df = store.read(DAILY_PRICES)
    assert [(r.date, r.symbol) for r in df.collect()] == want
    assert df.rdd.getNumPartitions() >= 9
    assert max(df.rdd.glom().map(len).collect()) < 1000


def test_each_run_of_an_ordered_read_is_a_task_of_its_own(spark, store, monkeypatch):
    from equitylake.sources import store as store_module
    rows = [(s, date(2024, m, d), float(m)) for m in range(1, 7) for d in (28, 1, 15) for s in ("MSFT", "AAPL", "XOM")]
    store.write(DAILY_PRICES, price_rows(spark, rows))
    want = sorted((d, s) for s, d, _ in rows)
    monkeypatch.setattr(store_module, "ORDERED_BYTES", 1 << 13)
    df = store.read(DAILY_PRICES, columns=["close"])
    assert df.rdd.getNumPartitions() > 1 and "Exchange" not in physical(df)
    assert [(r.date, r.symbol) for r in df.collect()] == want


def test_a_replaced_text_is_never_missing(spark, tmp_path):
    from equitylake.sources import files
    path = f"{tmp_path}/ledger.json"
    for text in ("one", "two"):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text
    assert [n for n in files.list_names(spark, str(tmp_path)) if not n.startswith(".")] == ["ledger.json"]


def test_a_day_grain_rewrites_only_the_fresh_days(spark, store):
    """The exact date range of a small feed: neighbouring days of its month keep their directories."""
    from equitylake.specs import TableSpec
    spec = TableSpec("daily_feed", DAILY_PRICES.schema, DAILY_PRICES.key, "day")
    days = [date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 2)]
    store.upsert(spec, price_rows(spark, [(s, d, 1.0) for d in days for s in ("MSFT", "AAPL")]))
    before = store.data_paths(spec)
    assert [p.rpartition("/")[2] for p in before] == ["pday=20240130", "pday=20240131", "pday=20240201", "pday=20240202"]
    store.upsert(spec, price_rows(spark, [("AAPL", days[1], 5.0), ("AAPL", days[2], 6.0)]))
    after = store.data_paths(spec)
    assert {p for p in before if p in after} == {before[0], before[3]}
    assert [(r.date, r.symbol, r.close) for r in store.read(spec, start=days[1], end=days[2]).collect()] == [
        (days[1], "AAPL", 5.0), (days[1], "MSFT", 1.0), (days[2], "AAPL", 6.0), (days[2], "MSFT", 1.0)]
    narrow = store.read(spec, where=F.col("date") > days[2], ordered=False)
    assert "dynamicpruning" in physical(narrow) and narrow.count() == 2


def test_symbol_bloom_filters_skip_row_groups_of_many_symbols(spark, store):
    """A row group with more symbols than a dictionary holds: smallest and largest cannot tell an absent symbol, its filter can."""
    day = F.lit(date(2024, 1, 5))
    symbol = F.upper(F.concat(F.lit("S"), F.substring(F.sha1(F.col("id").cast("string")), 1, 9)))
    rows = spark.range(300_000).coalesce(1).select(symbol.alias("symbol"), day.alias("date"), F.lit(1.0).alias("close"))
    store.write(DAILY_PRICES, rows)

    def rows_read(symbols):
        df = store.read(DAILY_PRICES, symbols=symbols, ordered=False)
        found = len(df.collect())
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
        return found, sum(m.get("numOutputRows").get().value() for m in metrics if m.contains("numOutputRows"))

    present = [r.symbol for r in rows.limit(2).collect()]
    assert rows_read(["S5AAAAAAAA", "S911111111"]) == (0, 0)
    found, read = rows_read(present)
    assert found == 2 <= read
