"""Predicates as Column builders, written so Catalyst pushes them to the scan.

Columns stay bare (never ``upper(symbol)``): a wrapped column blocks parquet
pushdown. Unset filters return ``None`` and are skipped; the rest AND together.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from equitylake.functions.text import normalize_symbols

# The listing filter of the universe build.
US_LISTED_EXCHANGES = ("AMEX", "NASDAQ", "NYSE")
EXCLUDED_INDUSTRIES = ("Shell Companies",)


def all_of(*preds: Column | None) -> Column | None:
    """AND of the given predicates, skipping ``None``; ``None`` when nothing is set."""
    present = [p for p in preds if p is not None]
    if not present:
        return None
    return functools.reduce(lambda a, b: a & b, present)


def symbol_in(symbols: str | Iterable[str] | None, column: str = "symbol") -> Column | None:
    """FLT1: membership; bare string = one symbol; no symbols left = matches nothing."""
    tickers = normalize_symbols(symbols)
    if tickers is None:
        return None
    if not tickers:
        return F.lit(False)
    return F.col(column).isin(tickers)


def date_between(column: str, start: date | None, end: date | None) -> Column | None:
    """FLT2: inclusive range, either end optional."""
    return all_of(
        F.col(column) >= F.lit(start) if start is not None else None,
        F.col(column) <= F.lit(end) if end is not None else None,
    )


def category_in(categories: Mapping[str, Iterable[str] | None]) -> Column | None:
    """FLT4: exact IN per column; ``None`` *or empty* list means no filter."""
    preds = []
    for column, values in categories.items():
        values = list(values) if values is not None else []
        if values:
            preds.append(F.col(column).isin(values))
    return all_of(*preds)


def flags_equal(flags: Mapping[str, bool | None]) -> Column | None:
    """FLT5: boolean equality, ``None`` skipped."""
    return all_of(*[F.col(c) == F.lit(v) for c, v in flags.items() if v is not None])


def value_between(column: str, low, high) -> Column | None:
    """FLT6/FLT7: inclusive, open-ended; a null value never matches."""
    return all_of(
        F.col(column) >= F.lit(low) if low is not None else None,
        F.col(column) <= F.lit(high) if high is not None else None,
    )


def check_bounds(low, high, message: str) -> None:
    """FLT8: reject inverted bounds before any data is read."""
    if low is not None and high is not None and low > high:
        raise ValueError(message)


def bounds_message(low: Column, high: Column, message: str) -> Column:
    """FLT8 over a table of requests: the rejection text of each, null where the bounds are in order or open."""
    return F.when(low > high, F.lit(message))


def tradable_listing(active: Column, symbol: Column, exchange: Column, industry: Column,
                     security_type: Column) -> Column:
    """FLT9: actively trading, non-empty symbol, US exchange (case-blind),
    not a shell company (null industry stays), common or ETF."""
    return (
        F.coalesce(active, F.lit(False))
        & symbol.isNotNull()
        & F.coalesce(F.upper(exchange).isin(*US_LISTED_EXCHANGES), F.lit(False))
        & ~F.coalesce(industry.isin(*EXCLUDED_INDUSTRIES), F.lit(False))
        & security_type.isin("common", "etf")
    )


def equity_screen() -> Column:
    """FLT13: US common stock that is not an ADR."""
    return (F.col("security_type") == "common") & (F.col("is_adr") == F.lit(False))


def calendar_year(column: str, year: int) -> Column:
    """FLT12, as a range of the bare column, which reaches the scan's statistics."""
    return F.col(column).between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31)))
