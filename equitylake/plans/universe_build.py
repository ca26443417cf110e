"""J1: build the listing universe from raw profile rows.

Raw rows are all text, in whatever mix of camelCase / snake_case names a shard
used. One ``select`` maps them (first non-blank alias per field, lenient
coercions, classification), one ``filter`` keeps tradable US listings, and one
latest-wins pass keeps the last row per symbol in feed order: shard number
first, then position inside the shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitylake.functions.classify import with_security_type
from equitylake.functions.text import as_bool, as_date, as_float, as_str, first_present
from equitylake.operators.audit import shard_audit
from equitylake.operators.latest import latest_wins
from equitylake.operators.predicates import tradable_listing
from equitylake.sources import landed
from equitylake.sources.store import Store
from equitylake.specs import TICKER_UNIVERSE

# The names each universe field may arrive under, in preference order.
FIELD_ALIASES = {
    "symbol": ("symbol",),
    "company_name": ("companyName", "company_name"),
    "exchange": ("exchangeShortName", "exchange_short_name", "exchange"),
    "exchange_full_name": ("exchangeFullName", "exchange_full_name"),
    "sector": ("sector",),
    "industry": ("industry",),
    "country": ("country",),
    "currency": ("currency",),
    "market_cap": ("marketCap", "market_cap", "mktCap"),
    "beta": ("beta",),
    "price": ("price",),
    "ipo_date": ("ipoDate", "ipo_date"),
    "cik": ("cik",),
    "isin": ("isin",),
    "cusip": ("cusip",),
    "is_etf": ("isEtf", "is_etf"),
    "is_fund": ("isFund", "is_fund"),
    "is_adr": ("isAdr", "is_adr"),
    "is_actively_trading": ("isActivelyTrading", "is_actively_trading"),
}

_TEXT = ("symbol", "company_name", "exchange", "exchange_full_name", "sector", "industry",
         "country", "currency", "cik", "isin", "cusip")
_FLOAT = ("market_cap", "beta", "price")
_FLAG = ("is_etf", "is_fund", "is_adr")


def map_profiles(raw: DataFrame, last_updated: datetime, carry: Sequence[str] = ()) -> DataFrame:
    """Every raw row mapped to universe columns plus a ``kept`` flag (FLT9).

    Three small projections instead of one nested expression: pick each
    field's first non-blank alias, coerce it once, then classify and filter
    on the coerced columns. ``carry`` names raw columns passed through.
    """
    cols = raw.columns
    keep = [F.col(f"`{c}`") for c in carry]
    picked = raw.select(*[first_present(cols, *aliases).alias(name) for name, aliases in FIELD_ALIASES.items()],
                        *keep)
    coerced = picked.select(
        *[as_str(n).alias(n) for n in _TEXT],
        *[as_float(n).alias(n) for n in _FLOAT],
        *[F.coalesce(as_bool(n), F.lit(False)).alias(n) for n in _FLAG],
        as_date("ipo_date").alias("ipo_date"),
        as_bool("is_actively_trading").alias("active"),
        *keep)
    typed = with_security_type(coerced, "symbol", "company_name", "is_etf", "is_fund")
    kept = tradable_listing(F.col("active"), F.col("symbol"), F.col("exchange"), F.col("industry"),
                            F.col("security_type"))
    return typed.select(
        F.upper("symbol").alias("symbol"), "company_name", "security_type",
        *TICKER_UNIVERSE.columns[3:-1],
        F.lit(last_updated).cast("timestamp").alias("last_updated"),
        kept.alias("kept"),
        *keep)


def build_universe(raw: DataFrame, last_updated: datetime, order: Sequence[str]) -> DataFrame:
    """Kept listings, one per symbol: the last in ``order`` (e.g. shard, position).

    The listing filter is applied *after* the latest-wins window, with
    ``kept`` leading the order: the top row of a symbol is then its latest
    kept row whenever one exists, which is exactly "filter, then keep the
    last". A filter placed before the window would be pushed down through the
    projections and re-inline every coercion into one giant predicate.
    """
    mapped = map_profiles(raw, last_updated, carry=order)
    latest = latest_wins(mapped, ["symbol"], [F.col("kept"), *order])
    return latest.filter(F.col("kept")).select(*TICKER_UNIVERSE.columns)


def ingest_audit(raw: DataFrame, part: str) -> DataFrame:
    """AGG4: per shard, rows seen and rows kept (before de-duplication)."""
    mapped = map_profiles(raw, datetime(1970, 1, 1), carry=[part])
    return shard_audit(mapped, part, F.col("kept"))


SHARD_ORDER = ("part", "_file", "_block", "_row")


def alias_fields() -> list[str]:
    return sorted({a for names in FIELD_ALIASES.values() for a in names})


def seed_universe(store: Store, landing: str, last_updated: datetime | None = None) -> DataFrame | None:
    """J1 as a job: landed shards -> universe table (replaced); returns the shard audit.

    One run timestamp is stamped on every row. No shard at all writes an
    empty universe, as an empty feed does.
    """
    stamp = last_updated or datetime.now(timezone.utc)
    raw = landed.read_profile_shards(store.spark, landing, alias_fields())
    if raw is None:
        store.write(TICKER_UNIVERSE, store.empty(TICKER_UNIVERSE))
        return None
    store.write(TICKER_UNIVERSE, build_universe(raw, stamp, list(SHARD_ORDER)), keyed=True)
    return ingest_audit(raw, "part")
