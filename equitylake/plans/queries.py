"""User-level read queries (Q1-Q8) over a Store.

Every query validates its bounds before touching data, then returns a lazy
DataFrame whose filters all reach the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame

from equitylake.operators.joins import semi_join
from equitylake.operators.predicates import (
    all_of, category_in, check_bounds, equity_screen, flags_equal, value_between,
)
from equitylake.sources.store import Store
from equitylake.specs import DAILY_PRICES, TICKER_UNIVERSE, statement_table

# The messages that reject inverted bounds.
DATE_BOUNDS_MESSAGE = "start must be on or before end"
IPO_BOUNDS_MESSAGE = "ipo_start must be on or before ipo_end"
CAP_BOUNDS_MESSAGE = "market_cap_min must be on or before market_cap_max"


def require_symbols(symbols: str | Iterable[str] | None) -> str | list[str]:
    """Q1-Q5 need at least one symbol argument (a blank one then matches nothing).

    Returns the argument materialised, so a generator is not consumed twice.
    """
    if symbols is None:
        raise ValueError("symbols are required")
    if isinstance(symbols, str):
        return symbols
    listed = list(symbols)
    if not listed:
        raise ValueError("symbols are required")
    return listed


def daily_prices(store: Store, symbols: str | Iterable[str], start: date | None = None,
                 end: date | None = None, ordered: bool = True) -> DataFrame:
    """Q1: stored prices for the given symbols, inclusive date bounds, key order."""
    symbols = require_symbols(symbols)
    check_bounds(start, end, DATE_BOUNDS_MESSAGE)
    return store.read(DAILY_PRICES, symbols=symbols, start=start, end=end, ordered=ordered)


def statements(store: Store, statement: str, symbols: str | Iterable[str], cadence: str,
               start: date | None = None, end: date | None = None,
               columns: Sequence[str] | None = None, ordered: bool = True) -> DataFrame:
    """Q2-Q5: one statement family; the cadence picks the table."""
    symbols = require_symbols(symbols)
    spec = statement_table(statement, cadence)
    check_bounds(start, end, DATE_BOUNDS_MESSAGE)
    return store.read(spec, symbols=symbols, start=start, end=end, columns=columns, ordered=ordered)


def income_statements(store: Store, symbols, cadence: str, start=None, end=None, columns=None, ordered=True):
    return statements(store, "income_statement", symbols, cadence, start, end, columns, ordered)


def balance_sheets(store: Store, symbols, cadence: str, start=None, end=None, columns=None, ordered=True):
    return statements(store, "balance_sheet", symbols, cadence, start, end, columns, ordered)


def cash_flows(store: Store, symbols, cadence: str, start=None, end=None, columns=None, ordered=True):
    return statements(store, "cash_flow", symbols, cadence, start, end, columns, ordered)


def ratios(store: Store, symbols, cadence: str, start=None, end=None, columns=None, ordered=True):
    return statements(store, "ratios", symbols, cadence, start, end, columns, ordered)


def universe(
    store: Store,
    symbols: Iterable[str] | None = None,
    security_type: Sequence[str] | None = None,
    exchange: Sequence[str] | None = None,
    sector: Sequence[str] | None = None,
    industry: Sequence[str] | None = None,
    country: Sequence[str] | None = None,
    is_etf: bool | None = None,
    is_fund: bool | None = None,
    is_adr: bool | None = None,
    ipo_start: date | None = None,
    ipo_end: date | None = None,
    market_cap_min: float | None = None,
    market_cap_max: float | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Q6: the listing universe narrowed by any mix of filters (AND)."""
    check_bounds(ipo_start, ipo_end, IPO_BOUNDS_MESSAGE)
    check_bounds(market_cap_min, market_cap_max, CAP_BOUNDS_MESSAGE)
    where = all_of(
        category_in({"security_type": security_type, "exchange": exchange, "sector": sector,
                     "industry": industry, "country": country}),
        flags_equal({"is_etf": is_etf, "is_fund": is_fund, "is_adr": is_adr}),
        value_between("ipo_date", ipo_start, ipo_end),
        value_between("market_cap", market_cap_min, market_cap_max),
    )
    return store.read(TICKER_UNIVERSE, symbols=symbols, where=where, ordered=ordered)


def price_panel(store: Store, start: date | None = None, end: date | None = None,
                ordered: bool = True, **screen) -> DataFrame:
    """Q7: prices over a window for every symbol a universe screen selects.

    One semi join replaces the client's chunked symbol lists; the screened
    side is broadcast only after a bounded count proves it small.
    """
    check_bounds(start, end, DATE_BOUNDS_MESSAGE)
    chosen = universe(store, ordered=False, **screen).select("symbol")
    prices = store.read(DAILY_PRICES, start=start, end=end, ordered=False)
    panel = semi_join(prices, chosen, "symbol")
    return panel.orderBy(*DAILY_PRICES.key) if ordered else panel


def equity_symbols(store: Store, ordered: bool = True) -> DataFrame:
    """Q8: US common stock that is not an ADR, as a one-column frame."""
    return store.read(TICKER_UNIVERSE, columns=["security_type", "is_adr"], where=equity_screen(),
                      ordered=ordered).select("symbol")
