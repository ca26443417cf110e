"""Landed-file ingestion: statements, profiles, price histories, backfill, stream."""

import json
import os
from datetime import date, datetime, timezone

import pytest

from equitylake.plans import price_load
from equitylake.plans.statement_build import build_statement_table, normalise_parts
from equitylake.plans.universe_build import FIELD_ALIASES, build_universe, ingest_audit
from equitylake.sources import landed
from equitylake.sources.store import Store
from equitylake.specs import DAILY_PRICES, INCOME_STATEMENT
from equitylake.streaming.landing import ingest_available

RUN = datetime(2026, 3, 22, tzinfo=timezone.utc)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


# ------------------------------------------------------------- statements
INCOME_HEADER = "date,symbol,reportedCurrency,cik,filingDate,acceptedDate,fiscalYear,period,revenue,bottomLineNetIncome,eps"


def test_statement_part_parses_and_normalises(spark, scratch):
    write(f"{scratch}/statement=income_statement/year=2011/period_part=FY/a.csv", "\n".join([
        INCOME_HEADER,
        "2011-09-24,aapl ,USD,0000320193,2011-10-26,2011-10-26 16:30:12,2011,FY,108249000000,0.75,27.68",
        "2011-06-30,MSFT,USD,0000789019,2011-07-28,2011-07-28 16:05:00,2011,FY,69943000000,n/a,2.69",
        "2011-12-31,000001.SZ,CNY,,,,2011,FY,1.5d,,",
        "bad,IBM,USD,,,,2011,FY,1,,",
    ]))
    raw = landed.read_statement_parts(spark, scratch, "income_statement")
    table = build_statement_table(raw, INCOME_STATEMENT, "year", "period_part", ["_file", "_block", "_row"])
    rows = {r.symbol: r for r in table.collect()}
    assert set(rows) == {"AAPL", "MSFT", "000001.SZ"}  # bad date dropped
    aapl = rows["AAPL"]
    assert aapl.cik == "0000320193" and aapl.fiscal_year == 2011 and aapl.revenue == 108249000000.0
    assert aapl.filing_date == date(2011, 10, 26)
    assert aapl.accepted_date == datetime(2011, 10, 26, 16, 30, 12)
    assert aapl.bottom_line_net_income == 0.75 and aapl.gross_profit is None  # omitted column -> null
    assert rows["MSFT"].bottom_line_net_income is None
    assert rows["000001.SZ"].revenue is None and rows["000001.SZ"].cik is None


def test_ratio_acronym_headers(spark, scratch):
    from equitylake.specs import RATIOS
    write(f"{scratch}/statement=ratios/year=2011/period_part=FY/a.csv",
          "date,symbol,netIncomePerEBT,ebtPerEbit,currentRatio\n2011-09-24,AAPL,0.75,1.0,2.5\n")
    raw = landed.read_statement_parts(spark, scratch, "ratios")
    row = build_statement_table(raw, RATIOS, "year", "period_part", ["_file", "_block", "_row"]).first()
    assert (row.net_income_per_ebt, row.ebt_per_ebit, row.current_ratio) == (0.75, 1.0, 2.5)
    assert "cik" not in row.asDict()


def test_headers_bind_by_name_per_file(spark, scratch):
    write(f"{scratch}/statement=income_statement/year=2011/period_part=Q1/a.csv",
          "date,symbol,period,revenue\n2011-03-31,AAPL,Q1,1\n")
    write(f"{scratch}/statement=income_statement/year=2011/period_part=Q2/b.csv",
          "revenue,period,symbol,date\n2,Q2,AAPL,2011-06-30\n")
    raw = landed.read_statement_parts(spark, scratch, "income_statement")
    got = {(r.date, r.revenue) for r in build_statement_table(
        raw, INCOME_STATEMENT, "year", "period_part", ["_file", "_block", "_row"]).collect()}
    assert got == {(date(2011, 3, 31), 1.0), (date(2011, 6, 30), 2.0)}


def test_repeated_period_keeps_last_and_later_bucket_wins(spark, scratch):
    write(f"{scratch}/statement=income_statement/year=2011/period_part=FY/a.csv",
          "date,symbol,period,revenue\n2011-07-31,X,FY,1\n2011-07-31,X,FY,2\n")
    write(f"{scratch}/statement=income_statement/year=2012/period_part=FY/a.csv",
          "date,symbol,period,revenue\n2011-07-31,X,FY,3\n2012-07-31,X,FY,4\n")
    raw = landed.read_statement_parts(spark, scratch, "income_statement")
    per_part = normalise_parts(raw, INCOME_STATEMENT, "year", "period_part", ["_file", "_block", "_row"])
    assert sorted(r.revenue for r in per_part.collect()) == [2.0, 3.0, 4.0]
    table = build_statement_table(raw, INCOME_STATEMENT, "year", "period_part", ["_file", "_block", "_row"])
    assert sorted((r.date, r.revenue) for r in table.collect()) == [(date(2011, 7, 31), 3.0), (date(2012, 7, 31), 4.0)]


def test_error_payload_raises_and_empty_part_is_skipped(spark, scratch):
    write(f"{scratch}/statement=income_statement/year=2011/period_part=FY/a.csv", "")
    assert landed.read_statement_parts(spark, scratch, "income_statement") is None
    write(f"{scratch}/statement=income_statement/year=2012/period_part=FY/a.csv", '{"Error Message": "Limit Reach"}')
    with pytest.raises(landed.PayloadError):
        landed.read_statement_parts(spark, scratch, "income_statement")


# --------------------------------------------------------------- profiles
FIELDS = sorted({a for names in FIELD_ALIASES.values() for a in names})


def profile(symbol, **kw):
    row = {"symbol": symbol, "companyName": f"{symbol} Inc.", "exchange": "NASDAQ", "isEtf": "false",
           "isFund": "false", "isAdr": "false", "isActivelyTrading": "true"}
    row.update(kw)
    return row


def test_profile_shards_mix_formats_and_later_shard_wins(spark, scratch):
    write(f"{scratch}/part=0/a.json", json.dumps([
        profile("aapl", marketCap=3e12, ipoDate="1980-12-12"), profile("DEAD", isActivelyTrading=False),
        profile("0700.HK", exchange="HKSE"), profile("SPAC", industry="Shell Companies"),
        profile("ARQQW"), profile("SPY", isEtf=True, exchange="AMEX")]))
    write(f"{scratch}/part=1/b.csv", "symbol,company_name,exchange_short_name,is_actively_trading,market_cap\n"
                                     "AAPL,Apple Inc.,nasdaq,yes,3.1e12\nMSFT,Microsoft,NYSE,1,\n")
    write(f"{scratch}/part=2/c.json", json.dumps(profile("XOM", exchange="NYSE")) + "\n")
    raw = landed.read_profile_shards(spark, scratch, FIELDS)
    built = {r.symbol: r for r in build_universe(raw, RUN, ["part", "_file", "_block", "_row"]).collect()}
    assert set(built) == {"AAPL", "MSFT", "SPY", "XOM"}
    assert built["AAPL"].market_cap == 3.1e12 and built["AAPL"].exchange == "nasdaq"
    assert built["AAPL"].company_name == "Apple Inc."
    assert built["SPY"].security_type == "etf" and built["SPY"].is_etf is True
    assert built["MSFT"].market_cap is None and built["AAPL"].last_updated == RUN.replace(tzinfo=None)
    audit = {r.part: (r.rows_seen, r.rows_kept, r.kept_so_far) for r in ingest_audit(raw, "part").collect()}
    assert audit == {0: (6, 2, 2), 1: (2, 2, 4), 2: (1, 1, 5)}


def test_profile_object_payload_raises(spark, scratch):
    write(f"{scratch}/part=0/a.json", '{"Error Message": "Invalid API KEY."}')
    with pytest.raises(Exception, match="unexpected payload"):  # told by the record, where it is read
        landed.read_profile_shards(spark, scratch, FIELDS).collect()


# ----------------------------------------------------------------- prices
def history(rows):
    return json.dumps({"symbol": "IGNORED", "historical": [
        {"date": d, "open": c, "high": c, "low": c, "close": c, "adjClose": c * 0.97, "volume": 1000.0}
        for d, c in rows]})


def test_price_histories_symbol_from_path_and_empty_object(spark, scratch):
    write(f"{scratch}/symbol=AAPL/a.json", history([("2024-01-02", 1.0), ("2024-01-03", 2.0), ("2024-01-02", 5.0)]))
    write(f"{scratch}/symbol=GONE/a.json", "{}")
    store = Store(spark, f"{scratch}/store")
    assert price_load.refresh_prices(store, scratch) == 3  # rows seen before de-duplication
    rows = [(r.symbol, r.date, r.close, r.volume) for r in store.read(DAILY_PRICES).collect()]
    assert rows == [("AAPL", date(2024, 1, 2), 5.0, 1000), ("AAPL", date(2024, 1, 3), 2.0, 1000)]


def test_price_history_bad_date_fails(spark, scratch):
    write(f"{scratch}/symbol=AAPL/a.json", history([("01/02/2024", 1.0)]))
    with pytest.raises(Exception):
        price_load.landed_prices(spark, scratch).collect()


def test_backfill_stages_resumably_and_records_empty_symbols(spark, scratch):
    landing = f"{scratch}/landing"
    write(f"{landing}/symbol=AAPL/a.json", history([("2024-12-31", 1.0), ("2025-01-02", 2.0)]))
    write(f"{landing}/symbol=MSFT/a.json", history([("2026-01-02", 3.0)]))
    write(f"{landing}/symbol=GONE/a.json", "{}")
    universe = spark.createDataFrame([("AAPL",), ("MSFT",), ("GONE",)], "symbol string")
    staging = f"{scratch}/staging"
    assert price_load.stage(spark, universe.filter("symbol = 'AAPL'"), landing, staging, shard_size=1) == (1, 0)
    assert price_load.stage(spark, universe, landing, staging, shard_size=1) == (2, 0)
    assert price_load.stage(spark, universe, landing, staging, shard_size=1) == (0, 0)  # nothing left
    entries = price_load.read_ledger(spark, staging).collect()
    assert sorted(s for r in entries for s in r.symbols) == ["AAPL", "GONE", "MSFT"]  # empty symbol recorded
    assert sum(r.rows for r in entries) == 3 and len({r.part for r in entries}) == len(entries)
    store = Store(spark, f"{scratch}/store")
    assert price_load.load(store, staging) == 3
    assert price_load.load(store, staging) == 3  # idempotent replay
    assert store.read(DAILY_PRICES).count() == 3
    with pytest.raises(RuntimeError, match="No staged shards"):
        price_load.load(store, f"{scratch}/nothing")


def test_stream_ingests_only_new_files(spark, scratch):
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    store = Store(spark, f"{scratch}/store")
    write(f"{landing}/symbol=AAPL/a.json", history([("2024-01-02", 1.0)]))
    ingest_available(spark, store, landing, ckpt)
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [1.0]
    ingest_available(spark, store, landing, ckpt)  # no new file: no batch, same table
    assert store.read(DAILY_PRICES).count() == 1
    write(f"{landing}/symbol=AAPL/b.json", history([("2024-01-02", 7.0), ("2024-02-01", 8.0)]))
    ingest_available(spark, store, landing, ckpt)
    assert [r.close for r in store.read(DAILY_PRICES).collect()] == [7.0, 8.0]


def test_price_history_array_payload_fails(spark, scratch):
    write(f"{scratch}/symbol=AAPL/a.json", '[{"date": "2024-01-02"}]')
    with pytest.raises(Exception, match="unexpected price payload"):
        price_load.landed_prices(spark, scratch).collect()


def test_seed_universe_job_writes_table_and_audits(spark, scratch):
    from equitylake.plans.universe_build import seed_universe
    from equitylake.specs import TICKER_UNIVERSE
    write(f"{scratch}/landing/part=0/a.json", json.dumps([profile("AAPL"), profile("DEAD", isActivelyTrading="no")]))
    store = Store(spark, f"{scratch}/store")
    audit = seed_universe(store, f"{scratch}/landing", RUN)
    assert [r.symbol for r in store.read(TICKER_UNIVERSE).collect()] == ["AAPL"]
    assert [(r.part, r.rows_seen, r.rows_kept) for r in audit.collect()] == [(0, 2, 1)]
    assert seed_universe(store, f"{scratch}/nothing") is None
    assert store.read(TICKER_UNIVERSE).count() == 0  # an empty feed writes an empty universe


def test_seed_statements_job(spark, scratch):
    from equitylake.plans.statement_build import seed_statements
    from equitylake.plans.universe_build import seed_universe
    from equitylake.specs import statement_table
    landing = f"{scratch}/landing"
    store = Store(spark, f"{scratch}/store")
    with pytest.raises(RuntimeError, match="no equities"):
        seed_statements(store, landing, f"{scratch}/cache", as_of=date(2012, 6, 30))
    write(f"{scratch}/profiles/part=0/a.json", json.dumps([profile("AAPL"), profile("SPY", isEtf="true")]))
    seed_universe(store, f"{scratch}/profiles", RUN)
    write(f"{landing}/statement=income_statement/year=2011/period_part=FY/a.csv",
          "date,symbol,period,revenue\n2011-09-24,AAPL,FY,1\n2011-09-24,SPY,FY,2\n")
    write(f"{landing}/statement=income_statement/year=1990/period_part=FY/a.csv",
          "date,symbol,period,revenue\n1990-09-24,AAPL,FY,3\n")
    write(f"{landing}/statement=income_statement/year=2011/period_part=Q4/a.csv",
          "date,symbol,period,revenue\n2011-09-24,AAPL,Q4,4\n")
    written = seed_statements(store, landing, f"{scratch}/cache", years=15, as_of=date(2012, 6, 30))
    assert written["income_statement_annual"] == 1 and written["income_statement_quarterly"] == 1
    assert written["ratios_annual"] == 0
    annual = store.read(statement_table("income_statement", "annual")).collect()
    assert [(r.symbol, r.revenue) for r in annual] == [("AAPL", 1.0)]  # ETF narrowed away, 1990 outside window


def test_part_cache_replays_and_resumes(spark, scratch):
    from equitylake.plans.statement_build import cache_statement_parts, read_cached_parts
    landing, cache = f"{scratch}/landing", f"{scratch}/cache"
    for year in (2011, 2012):
        write(f"{landing}/statement=income_statement/year={year}/period_part=FY/a.csv",
              f"date,symbol,period,revenue\n{year}-09-24,AAPL,FY,{year}\n")
    assert cache_statement_parts(spark, landing, cache, INCOME_STATEMENT) == 2
    assert cache_statement_parts(spark, landing, cache, INCOME_STATEMENT) == 0  # replay: nothing redone
    write(f"{landing}/statement=income_statement/year=2013/period_part=FY/a.csv",
          "date,symbol,period,revenue\n2013-09-24,AAPL,FY,2013\n")
    assert cache_statement_parts(spark, landing, cache, INCOME_STATEMENT) == 1  # only the new part
    rows = read_cached_parts(spark, cache, INCOME_STATEMENT).collect()
    assert sorted((r.year, r.revenue) for r in rows) == [(2011, 2011.0), (2012, 2012.0), (2013, 2013.0)]


def test_part_cache_follows_late_files_empty_parts_and_the_wanted_set(spark, scratch):
    from equitylake.plans.statement_build import cache_statement_parts, read_cached_parts
    landing, cache = f"{scratch}/landing", f"{scratch}/cache"
    part = f"{landing}/statement=income_statement/year=2011/period_part=FY"
    write(f"{part}/a.csv", "date,symbol,period,revenue\n2011-09-24,AAPL,FY,1\n2011-09-24,XOM,FY,2\n")

    def run(*symbols):
        wanted = spark.createDataFrame([(s,) for s in symbols], "symbol string")
        n = cache_statement_parts(spark, landing, cache, INCOME_STATEMENT, wanted)
        return n, sorted((r.symbol, r.revenue) for r in read_cached_parts(spark, cache, INCOME_STATEMENT).collect())

    assert run("NONE") == (1, [])
    assert run("NONE") == (0, [])  # a part that keeps no row is cached, too
    assert run("AAPL") == (1, [("AAPL", 1.0)])
    assert run("AAPL", "XOM") == (1, [("AAPL", 1.0), ("XOM", 2.0)])
    write(f"{part}/b.csv", "date,symbol,period,revenue\n2011-09-24,XOM,FY,3\n")
    assert run("XOM", "AAPL") == (1, [("AAPL", 1.0), ("XOM", 3.0)])
    assert run("NONE") == (1, [])


def test_csv_part_with_byte_order_mark(spark, scratch):
    write(f"{scratch}/statement=income_statement/year=2011/period_part=FY/a.csv",
          "\ufeffdate,symbol,period,revenue\n2011-09-24,AAPL,FY,5\n")
    raw = landed.read_statement_parts(spark, scratch, "income_statement")
    row = build_statement_table(raw, INCOME_STATEMENT, "year", "period_part", ["_file", "_block", "_row"]).first()
    assert (row.date, row.symbol, row.revenue) == (date(2011, 9, 24), "AAPL", 5.0)


def test_stage_sets_aside_malformed_symbols_and_retries_them(spark, scratch):
    landing, staging = f"{scratch}/landing", f"{scratch}/staging"
    write(f"{landing}/symbol=AAPL/a.json", history([("2024-01-02", 1.0)]))
    write(f"{landing}/symbol=BAD/a.json", history([("02/01/2024", 1.0)]))
    write(f"{landing}/symbol=ODD/a.json", '["not", "an", "object"]')
    universe = spark.createDataFrame([("AAPL",), ("BAD",), ("ODD",)], "symbol string")
    assert price_load.stage(spark, universe, landing, staging) == (1, 2)
    assert sorted(r.symbol for r in price_load.read_rejects(spark, staging).collect()) == ["BAD", "ODD"]
    write(f"{landing}/symbol=BAD/a.json", history([("2024-01-03", 2.0)]))  # fixed upstream
    assert price_load.stage(spark, universe, landing, staging) == (1, 1)
    store = Store(spark, f"{scratch}/store")
    assert price_load.load(store, staging) == 2
    assert [r.symbol for r in store.read(DAILY_PRICES).collect()] == ["AAPL", "BAD"]


def test_load_ignores_rows_of_an_unrecorded_shard(spark, scratch):
    landing, staging = f"{scratch}/landing", f"{scratch}/staging"
    write(f"{landing}/symbol=AAPL/a.json", history([("2024-01-02", 1.0)]))
    universe = spark.createDataFrame([("AAPL",)], "symbol string")
    assert price_load.stage(spark, universe, landing, staging) == (1, 0)
    # A crashed run wrote shard 7 but never recorded it in the ledger.
    spark.createDataFrame([("MSFT", date(2024, 1, 2), 9.0)], "symbol string, date date, close double") \
        .write.parquet(f"{staging}/data/part=7")
    store = Store(spark, f"{scratch}/store")
    assert price_load.load(store, staging) == 1
    assert [r.symbol for r in store.read(DAILY_PRICES).collect()] == ["AAPL"]


def test_listing_filter_rules(spark):
    from equitylake.plans.universe_build import map_profiles
    rows = [
        profile("AAA"),                                        # kept
        profile("BBB", isActivelyTrading="false"),             # inactive
        profile("  ", companyName="Blank"),                    # blank symbol
        profile("CCC", exchange="nyse"),                       # case-blind exchange: kept
        profile("DDD", exchange="LSE"),                        # non-US
        profile("EEE", industry="Shell Companies"),            # blank-check vehicle
        profile("FFF", industry=None),                         # null industry stays
        profile("GGGGW"),                                      # warrant
        profile("HHH", isFund="true"),                         # fund
        profile("III-A"),                                      # share class: common, kept
        profile("JJJ", isActivelyTrading=None),                # unknown activity
    ]
    cols = sorted({k for r in rows for k in r})
    df = spark.createDataFrame([tuple(None if r.get(c) is None else str(r.get(c)) for c in cols) for r in rows],
                               ", ".join(f"`{c}` string" for c in cols))
    kept = {r.symbol: r.security_type for r in map_profiles(df, RUN).filter("kept").collect()}
    assert kept == {"AAA": "common", "CCC": "common", "FFF": "common", "III-A": "common"}


def test_stream_in_several_micro_batches(spark, scratch):
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    for i, sym in enumerate(["AAA", "BBB", "CCC"]):
        write(f"{landing}/symbol={sym}/a.json", history([("2024-01-02", float(i)), ("2024-03-04", float(i))]))
    store = Store(spark, f"{scratch}/store")
    ingest_available(spark, store, landing, ckpt, max_files_per_trigger=1)
    assert store.read(DAILY_PRICES).count() == 6
    assert sorted(n for n in os.listdir(f"{ckpt}/commits") if not n.startswith(".")) == ["0", "1", "2"]


def test_symbol_without_a_landed_file_stays_pending(spark, scratch):
    landing, staging = f"{scratch}/landing", f"{scratch}/staging"
    write(f"{landing}/symbol=AAPL/a.json", history([("2024-01-02", 1.0)]))
    universe = spark.createDataFrame([("AAPL",), ("LATE",)], "symbol string")
    assert price_load.stage(spark, universe, landing, staging) == (1, 0)
    todo = price_load.staging_todo(universe, price_load.read_ledger(spark, staging))
    assert [r.symbol for r in todo.collect()] == ["LATE"]
    write(f"{landing}/symbol=LATE/a.json", "{}")  # lands later, as delisted
    assert price_load.stage(spark, universe, landing, staging) == (1, 0)
    assert price_load.stage(spark, universe, landing, staging) == (0, 0)


def test_refresh_from_an_empty_landing_is_a_noop(spark, scratch):
    store = Store(spark, f"{scratch}/store")
    assert price_load.refresh_prices(store, f"{scratch}/nothing-landed") == 0
    assert not store.exists(DAILY_PRICES)


def test_full_profile_maps_every_universe_column(spark, scratch):
    from equitylake.plans.universe_build import SHARD_ORDER, alias_fields
    from equitylake.specs import TICKER_UNIVERSE
    full = {"symbol": "aapl", "companyName": "Apple Inc.", "exchange": "NASDAQ",
            "exchangeFullName": "NASDAQ Global Select", "sector": "Technology",
            "industry": "Consumer Electronics", "country": "US", "currency": "USD", "marketCap": 3e12,
            "beta": 1.1, "price": 200.0, "ipoDate": "1980-12-12", "cik": "0000320193", "isin": "US0378331005",
            "cusip": "037833100", "isEtf": False, "isFund": False, "isAdr": False, "isActivelyTrading": True}
    write(f"{scratch}/part=0/a.json", json.dumps([full]))
    raw = landed.read_profile_shards(spark, scratch, alias_fields())
    row = build_universe(raw, RUN, list(SHARD_ORDER)).first().asDict()
    assert list(row) == TICKER_UNIVERSE.columns
    assert row == {"symbol": "AAPL", "company_name": "Apple Inc.", "security_type": "common", "exchange": "NASDAQ",
                   "exchange_full_name": "NASDAQ Global Select", "sector": "Technology",
                   "industry": "Consumer Electronics", "country": "US", "currency": "USD", "market_cap": 3e12,
                   "beta": 1.1, "price": 200.0, "ipo_date": date(1980, 12, 12), "cik": "0000320193",
                   "isin": "US0378331005", "cusip": "037833100", "is_etf": False, "is_fund": False,
                   "is_adr": False, "last_updated": RUN.replace(tzinfo=None)}


def test_command_line_runs_the_jobs(spark, scratch, capsys):
    from equitylake.__main__ import main
    root = f"{scratch}/store"
    write(f"{scratch}/profiles/part=0/a.json", json.dumps([profile("AAPL"), profile("MSFT")]))
    write(f"{scratch}/prices/symbol=AAPL/a.json", history([("2024-01-02", 1.0), ("2025-03-04", 2.0)]))
    assert main(["seed-universe", "--root", root, "--landing", f"{scratch}/profiles"])["shards"][0]["rows_kept"] == 2
    assert main(["stage", "--root", root, "--landing", f"{scratch}/prices", "--staging", f"{scratch}/stg"]) == \
        {"staged": 1, "failed": 0}
    assert main(["load", "--root", root, "--staging", f"{scratch}/stg"]) == {"rows": 2}
    assert main(["load", "--root", root, "--staging", f"{scratch}/stg", "--year", "2025"]) == {"rows": 1}
    assert '"command": "load"' in capsys.readouterr().out
    assert Store(spark, root).read(DAILY_PRICES).count() == 2


def test_continuous_ingest_picks_up_new_landings(spark, scratch):
    from equitylake.streaming.landing import start_landing_ingest
    landing, ckpt = f"{scratch}/landing", f"{scratch}/ckpt"
    store = Store(spark, f"{scratch}/store")
    write(f"{landing}/symbol=AAPL/a.json", history([("2024-01-02", 1.0)]))
    query = start_landing_ingest(spark, store, landing, ckpt, processing_time="1 second")
    try:
        query.processAllAvailable()
        assert store.read(DAILY_PRICES).count() == 1
        write(f"{landing}/symbol=MSFT/a.json", history([("2024-01-02", 2.0)]))
        query.processAllAvailable()
        assert {r.symbol for r in store.read(DAILY_PRICES).collect()} == {"AAPL", "MSFT"}
    finally:
        query.stop()


def test_landed_symbol_directories_are_normalised(spark, scratch):
    landing = f"{scratch}/landing"
    write(f"{landing}/symbol=aapl/a.json", history([("2024-01-02", 1.0)]))
    store = Store(spark, f"{scratch}/store")
    price_load.refresh_prices(store, landing)
    assert [r.symbol for r in store.read(DAILY_PRICES).collect()] == ["AAPL"]
    universe = spark.createDataFrame([("AAPL",)], "symbol string")
    assert price_load.stage(spark, universe, landing, f"{scratch}/staging") == (1, 0)


# ---------------------------------------------------------------- one probe job
def test_first_lines_groups_files_by_header_in_one_job(spark, tmp_path):
    from equitylake.sources import landed
    texts = {"a b/part=1/x 1.csv": "symbol,price\nA,1\n", "a b/part=2/y.csv": "﻿symbol,price\nB,2\n",
             "a b/part=3/%z.csv": "price,symbol\n3,C\n", "a b/part=4/empty.csv": "", "a b/part=5/blank.csv": " \n\n",
             "a b/part=6/big.csv": "symbol,price\n" + "D,4\n" * 50_000, "a b/part=7/e.json": '  \n [{"symbol": "E"}]'}
    for name, text in texts.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    paths = landed.list_files(spark, str(tmp_path), (".csv", ".json"))
    found = {line: sorted(p.rpartition("/")[2] for p in ps) for line, ps in landed.first_lines(spark, paths).items()}
    assert found == {"symbol,price": ["big.csv", "x 1.csv", "y.csv"], "price,symbol": ["%z.csv"], "[": ["e.json"]}
    csvs = [p for p in paths if p.endswith(".csv")]
    rows = landed.read_csv_by_header(spark, str(tmp_path / "a b"), csvs).groupBy("symbol", "price").count().collect()
    assert {(r.symbol, r.price, r["count"]) for r in rows} == {("A", "1", 1), ("B", "2", 1), ("C", "3", 1), ("D", "4", 50_000)}
    with pytest.raises(landed.PayloadError, match="e.json"):
        landed.read_csv_by_header(spark, str(tmp_path), paths)


def test_stream_evaluates_a_batch_once_and_archives_its_files(spark, tmp_path):
    from equitylake.sources.store import Store
    from equitylake.specs import DAILY_PRICES
    from equitylake.streaming import landing as streaming

    def land(name, day):
        folder = tmp_path / "landing" / "symbol=AAPL"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text('{"historical": [{"date": "%s", "close": 1.0}]}\n{"historical": [{"close": 1}]}\n' % day)

    store = Store(spark, str(tmp_path / "store"))
    run = lambda: streaming.ingest_available(
        spark, store, str(tmp_path / "landing"), str(tmp_path / "ckpt"), archive=str(tmp_path / "done"))
    for i, day in enumerate(("2024-01-02", "2024-01-03", "2024-01-04")):
        land(f"{i}.json", day)
        run()
    assert [str(r.date) for r in store.read(DAILY_PRICES).collect()] == ["2024-01-02", "2024-01-03", "2024-01-04"]
    assert streaming.read_rejects(store).count() == 3
    left = sorted(p.name for p in (tmp_path / "landing").rglob("*.json"))
    moved = sorted(p.name for p in (tmp_path / "done").rglob("*.json"))
    assert sorted(left + moved) == ["0.json", "1.json", "2.json"] and len(moved) >= 2


def test_a_part_is_readable_while_it_is_made_anew(spark, tmp_path, monkeypatch):
    """A changed part's rows are replaced by the write itself; only parts that keep no row any more are deleted."""
    from equitylake.plans import statement_build as sb
    from equitylake.specs import INCOME_STATEMENT

    def land(year, text):
        folder = tmp_path / "landing" / "statement=income_statement" / f"year={year}" / "period_part=FY"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "p.csv").write_text(text)

    land(2020, "date,symbol,revenue\n2020-12-31,A,1\n")
    land(2021, "date,symbol,revenue\n2021-12-31,A,2\n")
    cache = str(tmp_path / "cache")
    assert sb.cache_statement_parts(spark, str(tmp_path / "landing"), cache, INCOME_STATEMENT) == 2
    land(2020, "date,symbol,revenue\n2020-12-31,A,10\n2020-12-31,B,11\n")
    land(2021, "date,symbol,revenue\n")
    deleted = []
    plain = sb.files.delete
    monkeypatch.setattr(sb.files, "delete", lambda s, p: deleted.append(p) or plain(s, p))
    assert sb.cache_statement_parts(spark, str(tmp_path / "landing"), cache, INCOME_STATEMENT) == 2
    assert [p.rpartition("/statement=income_statement/")[2] for p in deleted] == ["year=2021/period_part=FY"]
    rows = sb.read_cached_parts(spark, cache, INCOME_STATEMENT).collect()
    assert {(r.symbol, r.revenue, r.year) for r in rows} == {("A", 10.0, 2020), ("B", 11.0, 2020)}


def test_jobs_side_by_side_run_in_pools_of_their_own(spark):
    from equitylake.session import side_by_side
    pool = lambda: spark.sparkContext.getLocalProperty("spark.scheduler.pool")
    spark.sparkContext.setLocalProperty("callSite.short", "mine")
    try:
        seen = side_by_side(spark, {n: lambda: (pool(), spark.sparkContext.getLocalProperty("callSite.short"), spark.range(10).count())
                                    for n in ("one", "two", "three")}, parallel=2)
        assert seen == {n: (n, "mine", 10) for n in ("one", "two", "three")}
        assert pool() is None
    finally:
        spark.sparkContext.setLocalProperty("callSite.short", None)
    assert spark.conf.get("spark.scheduler.mode") == "FAIR"
