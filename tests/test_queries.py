"""Read queries: bound validation, cadence selection, universe filters, price panel."""

import re
from datetime import date

import pytest

from equitylake.plans import queries as q
from equitylake.specs import DAILY_PRICES, TICKER_UNIVERSE
from test_store import price_rows, universe_frame, universe_row


@pytest.fixture()
def universe_store(spark, store):
    rows = [
        universe_row("AAPL", market_cap=3e12, ipo_date=date(1980, 12, 12)),
        universe_row("MSFT", market_cap=2.5e12, ipo_date=date(1986, 3, 13)),
        universe_row("XOM", exchange="NYSE", sector="Energy", industry="Oil", market_cap=None,
                     ipo_date=date(1920, 1, 1)),
        universe_row("SPY", security_type="etf", exchange="AMEX", is_etf=True, sector=None, market_cap=5e11),
        universe_row("BABA", exchange="NYSE", is_adr=True, sector="Consumer", country="CN", market_cap=2e11),
    ]
    store.write(TICKER_UNIVERSE, universe_frame(spark, rows))
    return store


def symbols(df):
    return [r.symbol for r in df.collect()]


def test_inverted_bounds_are_rejected_before_reading(store):
    with pytest.raises(ValueError, match="start must be on or before end"):
        q.daily_prices(store, ["AAPL"], date(2024, 2, 1), date(2024, 1, 1))
    with pytest.raises(ValueError, match="ipo_start must be on or before ipo_end"):
        q.universe(store, ipo_start=date(2000, 1, 2), ipo_end=date(2000, 1, 1))
    with pytest.raises(ValueError, match="market_cap_min must be on or before market_cap_max"):
        q.universe(store, market_cap_min=2.0, market_cap_max=1.0)
    with pytest.raises(ValueError, match="start must be on or before end"):
        q.income_statements(store, ["AAPL"], "annual", date(2024, 2, 1), date(2024, 1, 1))


def test_unknown_cadence_and_column(store):
    with pytest.raises(ValueError, match="cadence"):
        q.ratios(store, ["AAPL"], "monthly")
    with pytest.raises(ValueError, match=r"income_statement_annual has no column\(s\): \['nope'\]"):
        q.income_statements(store, ["AAPL"], "annual", columns=["nope"])


def test_universe_filters(universe_store):
    s = universe_store
    assert symbols(q.universe(s)) == ["AAPL", "BABA", "MSFT", "SPY", "XOM"]
    assert symbols(q.universe(s, sector=[])) == ["AAPL", "BABA", "MSFT", "SPY", "XOM"]  # empty list = no filter
    assert symbols(q.universe(s, security_type=["etf"])) == ["SPY"]
    assert symbols(q.universe(s, exchange=["NYSE"], sector=["Energy", "Consumer"])) == ["BABA", "XOM"]
    assert symbols(q.universe(s, is_adr=True)) == ["BABA"]
    assert symbols(q.universe(s, is_etf=False, is_adr=False)) == ["AAPL", "MSFT", "XOM"]
    assert symbols(q.universe(s, ipo_start=date(1980, 12, 12), ipo_end=date(1986, 3, 13))) == ["AAPL", "MSFT"]
    assert symbols(q.universe(s, market_cap_min=5e11)) == ["AAPL", "MSFT", "SPY"]  # null never matches
    assert symbols(q.universe(s, market_cap_max=2e11)) == ["BABA"]
    assert symbols(q.universe(s, symbols=["aapl", " xom"], exchange=["NASDAQ"])) == ["AAPL"]
    assert symbols(q.universe(s, symbols=[])) == []


def test_equity_symbols(universe_store):
    assert symbols(q.equity_symbols(universe_store)) == ["AAPL", "MSFT", "XOM"]


def test_price_panel_semi_joins_screen(spark, universe_store):
    s = universe_store
    s.upsert(DAILY_PRICES, price_rows(spark, [("SPY", date(2024, 1, 2), 1.0), ("AAPL", date(2024, 1, 2), 2.0),
                                               ("SPY", date(2023, 12, 29), 3.0)]))
    panel = q.price_panel(s, start=date(2024, 1, 1), security_type=["etf"])
    assert [(r.symbol, r.close) for r in panel.collect()] == [("SPY", 1.0)]
    plan = panel._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_symbols_are_required(store):
    for call in (lambda: q.daily_prices(store, None), lambda: q.daily_prices(store, []),
                 lambda: q.income_statements(store, None, "annual"), lambda: q.ratios(store, [], "quarterly")):
        with pytest.raises(ValueError, match="symbols are required"):
            call()
    assert q.daily_prices(store, [" "]).count() == 0  # present but blank: matches nothing
    assert q.daily_prices(store, (s for s in ["AAPL"])).count() == 0  # a generator is fine


def test_daily_prices_full_rows_in_key_order(spark, store):
    from datetime import timedelta
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(5)]
    rows = [(s, d, float(i)) for d in reversed(days) for i, s in enumerate(["NVDA", "AAPL", "MSFT"])]
    store.upsert(DAILY_PRICES, price_rows(spark, rows))
    got = q.daily_prices(store, ["msft", "NVDA"], date(2024, 1, 2), date(2024, 1, 4)).collect()
    assert [(r.date, r.symbol) for r in got] == [(d, s) for d in days[1:4] for s in ("MSFT", "NVDA")]
    assert got[0].asDict() == {"symbol": "MSFT", "date": date(2024, 1, 2), "open": 2.0, "high": 2.0, "low": 2.0,
                               "close": 2.0, "adj_close": 2.0 * 0.97, "volume": 100}
    assert q.daily_prices(store, ["ZZZZ"]).count() == 0  # unknown symbol: empty, not an error


def test_each_statement_query_reads_its_own_table(spark, store):
    from equitylake.specs import statement_table
    amount = {"income_statement": "revenue", "balance_sheet": "total_assets",
              "cash_flow": "net_income", "ratios": "current_ratio"}
    for i, (family, field) in enumerate(amount.items()):
        for cadence, period in (("annual", "FY"), ("quarterly", "Q4")):
            frame = spark.createDataFrame([(date(2023, 12, 31), "AAPL", 2023, period, float(i))],
                                          f"date date, symbol string, fiscal_year int, period string, {field} double")
            store.upsert(statement_table(family, cadence), frame)
    reads = {"income_statement": q.income_statements, "balance_sheet": q.balance_sheets,
             "cash_flow": q.cash_flows, "ratios": q.ratios}
    for i, (family, fn) in enumerate(reads.items()):
        for cadence, period in (("annual", "FY"), ("quarterly", "Q4")):
            row = fn(store, ["AAPL"], cadence, columns=[amount[family], "period"]).first()
            assert (row[amount[family]], row.period) == (float(i), period)


def test_broadcast_only_within_the_checked_bound(spark):
    from equitylake.operators.joins import semi_join
    big = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3)], "symbol string, v int")
    small = spark.createDataFrame([("A",), ("C",)], "symbol string")

    def hinted(df):  # beyond the bound a filter of the keys is broadcast, not the keys
        return bool(re.search("LeftSemi.*strategy=broadcast", df._jdf.queryExecution().optimizedPlan().toString()))

    assert hinted(semi_join(big, small))
    assert not hinted(semi_join(big, small, max_broadcast_rows=1))
    assert not hinted(semi_join(big, small, known_rows=5, max_broadcast_rows=4))
    assert sorted(r.symbol for r in semi_join(big, small, max_broadcast_rows=1).collect()) == ["A", "C"]
