"""DuckDB oracle SQL for every catalog query that SQL can state.

The driver's tables are pre-registered as views. The fixture views (F1-F5,
F7) are repeated here as CTEs, in DuckDB's dialect, mirroring
``equitylake.plans.fixtures`` expression for expression. Latest-wins is
``row_number() ... = 1`` (DuckDB's ``arg_max`` skips NULLs, which would change
whole-row semantics). Run parameters (as-of dates, run timestamp) are literals.
"""

from __future__ import annotations

F1 = """f1 AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS "date",
         value AS open, value + 1 AS high, value - 1 AS low, value AS close,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE value * 0.97e0 END AS adj_close,
         CAST(event_id * 10 AS BIGINT) AS volume, event_id AS seq, event_type AS feed
  FROM events)"""

PRICE_COLS = 'symbol, "date", open, high, low, close, adj_close, volume'

LATEST_PRICES = f"""lp AS (
  SELECT {PRICE_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY "date", symbol ORDER BY seq DESC) AS rn FROM f1) t
  WHERE rn = 1)"""

F2 = """f2 AS (
  SELECT 'U' || CAST(c_custkey AS VARCHAR) AS symbol, c_name AS company_name,
         CASE WHEN c_custkey % 5 = 0 THEN 'etf' ELSE 'common' END AS security_type,
         CASE c_custkey % 3 WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NYSE' ELSE 'AMEX' END AS exchange,
         CAST(NULL AS VARCHAR) AS exchange_full_name, c_mktsegment AS sector,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Industry ' || CAST(c_custkey % 4 AS VARCHAR) END AS industry,
         n_name AS country, 'USD' AS currency,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS market_cap,
         CAST(1.1e0 AS DOUBLE) AS beta, CAST(100.0e0 AS DOUBLE) AS price,
         DATE '1980-01-01' + CAST(c_custkey AS INTEGER) AS ipo_date,
         CAST(NULL AS VARCHAR) AS cik, CAST(NULL AS VARCHAR) AS isin, CAST(NULL AS VARCHAR) AS cusip,
         c_custkey % 5 = 0 AS is_etf, FALSE AS is_fund, c_nationkey % 7 = 0 AS is_adr,
         TIMESTAMP '2026-08-10 00:00:00' AS last_updated
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

Q1_IN = "('U7', 'U8', 'U42', 'U100', 'U149', 'U1000', 'NOPE')"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


P = with_(F1, LATEST_PRICES)
U = with_(F2)

SQL: dict[str, str] = {
    "daily_prices_range": P + f"""SELECT * FROM lp WHERE symbol IN {Q1_IN}
        AND "date" BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "daily_prices_open_ended": P + f"""SELECT * FROM lp WHERE symbol IN {Q1_IN} AND "date" >= DATE '2024-01-05'""",
    "prices_where_and_symbols": P + f"SELECT * FROM lp WHERE symbol IN {Q1_IN} AND close > 50",
    "prices_column_subset": P + 'SELECT symbol, "date", close FROM lp',
    "prices_full_read": P + "SELECT * FROM lp",
    "latest_wins_prices": P + "SELECT * FROM lp",
    "price_date_span": P + 'SELECT min("date") AS first_date, max("date") AS last_date, count(*) AS rows FROM lp',
    "upsert_prices": with_(F1) + f"""SELECT {PRICE_COLS} FROM (
        SELECT *, row_number() OVER (PARTITION BY "date", symbol
                                     ORDER BY CASE WHEN feed = 'click' THEN 1 ELSE 0 END DESC, seq DESC) AS rn
        FROM f1) t WHERE rn = 1""",
    "upsert_partial_columns": with_(F1) + """SELECT symbol, "date", open, high, low, close,
        CASE WHEN feed = 'click' THEN NULL ELSE adj_close END AS adj_close, volume FROM (
        SELECT *, row_number() OVER (PARTITION BY "date", symbol
                                     ORDER BY CASE WHEN feed = 'click' THEN 1 ELSE 0 END DESC, seq DESC) AS rn
        FROM f1) t WHERE rn = 1""",
    "overwrite_roundtrip": U + "SELECT * FROM f2",
    "upsert_universe": U + """SELECT symbol,
        CASE WHEN sector IN ('BUILDING', 'MACHINERY') THEN upper(company_name) ELSE company_name END AS company_name,
        security_type, exchange, exchange_full_name, sector, industry, country, currency,
        CASE WHEN sector IN ('BUILDING', 'MACHINERY') THEN market_cap + 1 ELSE market_cap END AS market_cap,
        beta, price, ipo_date, cik, isin, cusip, is_etf, is_fund, is_adr, last_updated FROM f2""",
    "universe_screen": U + """SELECT * FROM f2 WHERE security_type IN ('common')
        AND exchange IN ('NYSE', 'NASDAQ') AND sector IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
    "universe_flags": U + "SELECT * FROM f2 WHERE is_etf = FALSE AND is_adr = TRUE AND is_fund = FALSE",
    "universe_ranges": U + """SELECT * FROM f2 WHERE ipo_date BETWEEN DATE '1980-06-01' AND DATE '1983-12-31'
        AND market_cap >= 0 AND market_cap <= 5000""",
    "universe_symbols": U + """SELECT * FROM f2 WHERE symbol IN ('U3', 'U10', 'U11', 'U999', 'NOPE')
        AND security_type IN ('common', 'etf')""",
    "equity_symbols": U + "SELECT symbol FROM f2 WHERE security_type = 'common' AND is_adr = FALSE",
    "price_panel": with_(F1, LATEST_PRICES, F2) + """SELECT * FROM lp
        WHERE "date" BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'
          AND symbol IN (SELECT symbol FROM f2 WHERE security_type IN ('etf'))""",
}


# ---------------------------------------------------------------------------
# Statements (F3 typed, F4 raw text) and listing profiles (F5).
# ---------------------------------------------------------------------------
from equitylake.specs import INCOME_STATEMENT, STATEMENTS  # noqa: E402
from pyspark.sql import types as _T  # noqa: E402

_SQL_TYPE = {_T.DateType: "DATE", _T.StringType: "VARCHAR", _T.IntegerType: "INTEGER",
             _T.DoubleType: "DOUBLE", _T.TimestampNTZType: "TIMESTAMP"}


def project(statement, given: dict[str, str], columns: list[str] | None = None) -> str:
    """SELECT list over a statement schema: given expressions, typed NULL elsewhere."""
    out = []
    for f in statement.schema.fields:
        if columns is not None and f.name not in columns:
            continue
        expr = given.get(f.name, f"CAST(NULL AS {_SQL_TYPE[type(f.dataType)]})")
        out.append(f'{expr} AS "{f.name}"')
    return ", ".join(out)


F3 = """f3 AS (
  SELECT CAST(o_orderdate AS DATE) AS "date", 'U' || CAST(o_custkey AS VARCHAR) AS symbol,
         CAST(year(o_orderdate) AS INTEGER) AS fiscal_year,
         'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS period, 'USD' AS reported_currency,
         o_orderdate AS accepted_date, o_totalprice AS revenue, o_orderkey AS seq
  FROM orders)"""

# Stored quarterly table: latest seq per (date, symbol).
F3Q = """f3q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "date", symbol ORDER BY seq DESC) AS rn
                              FROM f3) t WHERE rn = 1)"""
# Annual: last order per (symbol, year) as period FY (then unique per key).
F3A = """f3a AS (SELECT * REPLACE ('FY' AS period) FROM (
           SELECT *, row_number() OVER (PARTITION BY symbol, fiscal_year ORDER BY seq DESC) AS rn FROM f3) t
         WHERE rn = 1)"""

_AMOUNT_SQL = {"income_statement": ("revenue", "revenue"), "balance_sheet": ("total_assets", "revenue"),
               "cash_flow": ("net_income", "revenue"), "ratios": ("current_ratio", "revenue / 1000")}


def stored_statement(family: str, source: str, columns: list[str] | None = None) -> str:
    field, expr = _AMOUNT_SQL[family]
    given = {"date": '"date"', "symbol": "symbol", "fiscal_year": "fiscal_year", "period": "period",
             "reported_currency": "reported_currency", field: expr}
    if STATEMENTS[family].filed:
        given["accepted_date"] = "accepted_date"
    return f"SELECT {project(STATEMENTS[family], given, columns)} FROM {source}"


S_IN = "('U1', 'U2', 'U10', 'U100', 'U500', 'U1499', 'NOPE')"
WS = "(' ' || chr(9) || chr(10) || chr(13))"

F4 = """f4 AS (
  SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'bad' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS "date",
         CASE WHEN o_orderkey % 13 = 0 THEN ' u' || CAST(o_custkey AS VARCHAR) || chr(9)
              ELSE 'U' || CAST(o_custkey AS VARCHAR) END AS symbol,
         CAST(year(o_orderdate) + shift AS VARCHAR) AS "fiscalYear",
         'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS period,
         CASE WHEN o_orderkey % 19 = 0 THEN 'n/a' ELSE CAST(o_totalprice + shift AS VARCHAR) END AS revenue,
         o_orderkey * 2 + shift AS seq
  FROM (SELECT *, 0 AS shift FROM orders UNION ALL SELECT *, 1 AS shift FROM orders WHERE o_orderkey % 5 = 0) o)"""

T4 = f"""t4 AS (
  SELECT TRY_CAST("date" AS DATE) AS "date", upper(trim(symbol, {WS})) AS symbol,
         TRY_CAST("fiscalYear" AS INTEGER) AS fiscal_year, period, TRY_CAST(revenue AS DOUBLE) AS revenue,
         TRY_CAST("fiscalYear" AS INTEGER) AS part_year, period AS part_period, seq
  FROM f4)"""

_T4_GIVEN = {"date": '"date"', "symbol": "symbol", "fiscal_year": "fiscal_year", "period": "period",
             "revenue": "revenue"}
_PERIOD_IDX = "CASE part_period WHEN 'FY' THEN 0 WHEN 'Q1' THEN 1 WHEN 'Q2' THEN 2 WHEN 'Q3' THEN 3 WHEN 'Q4' THEN 4 END"

NORMALISED = with_(F4, T4) + f"""SELECT {project(INCOME_STATEMENT, _T4_GIVEN)} FROM (
  SELECT *, row_number() OVER (PARTITION BY part_year, part_period, "date", symbol ORDER BY seq DESC) AS rn
  FROM t4 WHERE "date" IS NOT NULL AND symbol IS NOT NULL) t WHERE rn = 1"""

RESTATED_BODY = f"""SELECT {project(INCOME_STATEMENT, _T4_GIVEN)} FROM (
  SELECT *, row_number() OVER (PARTITION BY "date", symbol
                               ORDER BY part_year DESC, {_PERIOD_IDX} DESC, seq DESC) AS rn
  FROM t4 WHERE "date" IS NOT NULL AND symbol IS NOT NULL {{extra}}) t WHERE rn = 1"""

F5 = """f5 AS (
  SELECT chr(CAST(65 + p_partkey % 26 AS INTEGER)) || chr(CAST(65 + floor(p_partkey / 26) % 26 AS INTEGER))
         || chr(CAST(65 + floor(p_partkey / 676) % 26 AS INTEGER))
         || chr(CAST(65 + floor(p_partkey / 17576) % 26 AS INTEGER))
         || CASE p_partkey % 12 WHEN 1 THEN '-WT' WHEN 2 THEN '-UN' WHEN 3 THEN '-PD' WHEN 4 THEN '-B' WHEN 5 THEN 'W'
            WHEN 6 THEN 'R' WHEN 7 THEN 'U' WHEN 8 THEN 'Z' WHEN 9 THEN '-' WHEN 10 THEN '-RT' WHEN 11 THEN '-WS'
            ELSE '' END AS symbol,
         p_name || CASE WHEN p_partkey % 24 = 8 THEN ' 8.75% Series H' ELSE '' END AS company_name,
         CASE p_partkey % 5 WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'nyse' WHEN 2 THEN 'AMEX' WHEN 3 THEN 'HKSE'
              ELSE ' NYSE ' END AS exchange,
         CASE p_partkey % 7 WHEN 0 THEN 'Shell Companies' WHEN 1 THEN NULL ELSE p_type END AS industry,
         CASE p_partkey % 10 WHEN 3 THEN 'n/a' WHEN 4 THEN ' ' ELSE CAST(p_retailprice * 1000 AS VARCHAR) END
           AS market_cap,
         CASE WHEN p_partkey % 10 = 4 THEN '42.5' ELSE NULL END AS mkt_cap,
         CASE p_partkey % 6 WHEN 0 THEN '1990-01-02 00:00:00' WHEN 1 THEN 'unknown' ELSE '2001-09-04' END AS ipo_date,
         CASE p_partkey % 8 WHEN 0 THEN 'TRUE' ELSE 'false' END AS is_etf,
         CASE p_partkey % 16 WHEN 3 THEN '1' ELSE '' END AS is_fund,
         CASE p_partkey % 9 WHEN 5 THEN 'false' WHEN 6 THEN 'no' WHEN 7 THEN 'maybe' WHEN 8 THEN NULL
              WHEN 1 THEN '1' WHEN 2 THEN ' Yes ' ELSE 'true' END AS is_actively_trading,
         CAST(CASE WHEN dup = 1 THEN 9 ELSE p_partkey % 4 END AS INTEGER) AS part,
         p_partkey * 2 + dup AS seq
  FROM (SELECT *, 0 AS dup FROM part UNION ALL SELECT *, 1 AS dup FROM part WHERE p_partkey % 20 = 0) p)"""

M5 = f"""m5 AS (
  SELECT *, upper(s_symbol) AS u_symbol,
         CASE WHEN strpos(upper(s_symbol), '-') > 0
              THEN substr(upper(s_symbol), 1, strpos(upper(s_symbol), '-') - 1) ELSE upper(s_symbol) END AS root,
         CASE WHEN strpos(upper(s_symbol), '-') > 0
              THEN substr(upper(s_symbol), strpos(upper(s_symbol), '-') + 1) ELSE '' END AS suffix
  FROM (SELECT *,
           NULLIF(trim(symbol, {WS}), '') AS s_symbol,
           NULLIF(trim(company_name, {WS}), '') AS s_name,
           NULLIF(trim(exchange, {WS}), '') AS s_exchange,
           NULLIF(trim(industry, {WS}), '') AS s_industry,
           TRY_CAST(trim(CASE WHEN trim(market_cap, {WS}) <> '' THEN market_cap END, {WS}) AS DOUBLE) AS s_cap,
           TRY_CAST(substr(trim(ipo_date, {WS}), 1, 10) AS DATE) AS s_ipo,
           COALESCE(lower(trim(is_etf, {WS})) IN ('true', '1', 'yes'), FALSE) AS s_etf,
           COALESCE(lower(trim(is_fund, {WS})) IN ('true', '1', 'yes'), FALSE) AS s_fund,
           COALESCE(lower(trim(is_actively_trading, {WS})) IN ('true', '1', 'yes'), FALSE) AS s_active
        FROM f5) t)"""

KIND = r"""CASE WHEN s_etf THEN 'etf' WHEN s_fund THEN 'fund'
     WHEN suffix <> '' THEN CASE WHEN starts_with(suffix, 'P') THEN 'preferred' WHEN suffix IN ('UN', 'U') THEN 'unit'
                                 WHEN suffix IN ('WT', 'WS') THEN 'warrant' WHEN suffix IN ('RT', 'R') THEN 'right'
                                 ELSE 'common' END
     WHEN length(root) = 5 THEN CASE right(root, 1)
          WHEN 'Z' THEN CASE WHEN regexp_matches(coalesce(s_name, ''),
                                   '(?i)%|\bseries\b|\bcumulative\b|\bpreferred\b|\bdepositary\b')
                             THEN 'preferred' ELSE 'warrant' END
          WHEN 'W' THEN 'warrant' WHEN 'R' THEN 'right' WHEN 'U' THEN 'unit' ELSE 'common' END
     ELSE 'common' END"""

K5 = f"""k5 AS (
  SELECT *, s_active AND s_symbol IS NOT NULL AND upper(s_exchange) IN ('AMEX', 'NASDAQ', 'NYSE')
            AND (s_industry IS NULL OR s_industry <> 'Shell Companies')
            AND security_type IN ('common', 'etf') AS kept
  FROM (SELECT *, {KIND} AS security_type FROM m5) t)"""

UNIVERSE_BUILT = with_(F5, M5, K5) + """SELECT u_symbol AS symbol, s_name AS company_name, security_type,
    s_exchange AS exchange, CAST(NULL AS VARCHAR) AS exchange_full_name, CAST(NULL AS VARCHAR) AS sector,
    s_industry AS industry, CAST(NULL AS VARCHAR) AS country, CAST(NULL AS VARCHAR) AS currency,
    s_cap AS market_cap, CAST(NULL AS DOUBLE) AS beta, CAST(NULL AS DOUBLE) AS price, s_ipo AS ipo_date,
    CAST(NULL AS VARCHAR) AS cik, CAST(NULL AS VARCHAR) AS isin, CAST(NULL AS VARCHAR) AS cusip,
    s_etf AS is_etf, s_fund AS is_fund, FALSE AS is_adr, TIMESTAMP '2026-08-10 00:00:00' AS last_updated
  FROM (SELECT *, row_number() OVER (PARTITION BY u_symbol ORDER BY part DESC, seq DESC) AS rn
        FROM k5 WHERE kept) t WHERE rn = 1"""

SQL.update({
    "history_window": P + """SELECT * FROM lp
        WHERE "date" BETWEEN DATE '2039-01-14' - (365 * 15 + 15 // 4) AND DATE '2039-01-14'""",
    "price_history_json": P + "SELECT * FROM lp",
    "landing_ingest": P + "SELECT * FROM lp",
    "backfill_load": P + "SELECT * FROM lp",
    "backfill_with_rejects": P + "SELECT * FROM lp WHERE symbol NOT LIKE '%7'",
    "stream_with_rejects": P + "SELECT * FROM lp WHERE symbol NOT LIKE '%7'",
    "staging_todo": U + """SELECT symbol FROM f2 WHERE NOT (security_type = 'etf'
        AND symbol IN (SELECT DISTINCT 'U' || CAST(user_id AS VARCHAR) FROM events))""",
    "statements_quarterly": with_(F3, F3Q) + stored_statement(
        "income_statement", "f3q", ["date", "symbol", "period", "accepted_date", "revenue"])
        + f""" WHERE symbol IN {S_IN} AND "date" BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
    "statements_annual": with_(F3, F3A) + stored_statement("income_statement", "f3a")
        + f" WHERE symbol IN {S_IN}",
    "balance_sheets": with_(F3, F3Q) + stored_statement(
        "balance_sheet", "f3q", ["date", "symbol", "fiscal_year", "total_assets"])
        + f""" WHERE symbol IN {S_IN} AND "date" >= DATE '1997-01-01'""",
    "cash_flows": with_(F3, F3A) + stored_statement("cash_flow", "f3a")
        + f""" WHERE symbol IN {S_IN} AND "date" <= DATE '1999-06-30'""",
    "ratios": with_(F3, F3Q) + stored_statement("ratios", "f3q", ["date", "symbol", "current_ratio"])
        + f" WHERE symbol IN {S_IN}",
    "fiscal_year_window": with_(F3, F3Q) + stored_statement(
        "income_statement", "f3q", ["date", "symbol", "fiscal_year", "period", "revenue"])
        + " WHERE fiscal_year BETWEEN 1996 AND 1998 AND period IN ('Q1', 'Q2', 'Q3', 'Q4')",
    "statement_rows_by_year": with_(F3, F3Q) + """SELECT CAST(year("date") AS INTEGER) AS year,
        count(*) AS rows FROM f3q GROUP BY 1""",
    "statements_in_year": with_(F3, F3Q) + stored_statement(
        "income_statement", "f3q", ["date", "symbol", "period", "revenue"]) + ' WHERE year("date") = 1997',
    "prices_by_year": P + """SELECT CAST(year("date") AS INTEGER) AS year, count(*) AS rows FROM lp
        WHERE year("date") = 2024 GROUP BY 1""",
    "statement_normalise": NORMALISED,
    "statement_part_cache": NORMALISED,
    "statement_restated": with_(F4, T4) + RESTATED_BODY.format(extra=""),
    "statement_parts_union": with_(F4, T4) + RESTATED_BODY.format(extra=""),
    "seed_statement_tables": with_(F4, T4, F2) + RESTATED_BODY.format(
        extra="AND symbol IN (SELECT symbol FROM f2 WHERE security_type = 'common' AND is_adr = FALSE)"),
    "statements_for_equities": with_(F4, T4, F2) + RESTATED_BODY.format(
        extra="AND symbol IN (SELECT symbol FROM f2 WHERE security_type = 'common' AND is_adr = FALSE)"),
    "classify_listings": with_(F5, M5) + f"SELECT seq, symbol, {KIND} AS security_type FROM m5",
    "universe_build": UNIVERSE_BUILT,
    "universe_shards": UNIVERSE_BUILT,
    "ingest_audit": with_(F5, M5, K5) + """SELECT part, count(*) AS rows_seen,
        count(*) FILTER (WHERE kept) AS rows_kept,
        CAST(sum(count(*) FILTER (WHERE kept)) OVER (ORDER BY part) AS BIGINT) AS kept_so_far
        FROM k5 GROUP BY part""",
})


F7 = """f7 AS (
  SELECT 'U' || CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS "date",
         o_totalprice AS open, o_totalprice AS high, o_totalprice AS low, o_totalprice AS close,
         o_totalprice * 0.97e0 AS adj_close, o_orderkey AS volume, o_orderkey AS seq
  FROM orders)"""

SQL["upsert_recent_months"] = with_(F7) + f"""SELECT symbol, "date", open, high, low,
    CASE WHEN "date" >= DATE '2001-06-01' THEN close + 1 ELSE close END AS close, adj_close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY "date", symbol ORDER BY seq DESC) AS rn FROM f7) t WHERE rn = 1"""

_F7_LATEST = f"""lf7 AS (SELECT {PRICE_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY "date", symbol ORDER BY seq DESC) AS rn FROM f7) t WHERE rn = 1)"""
SQL["prices_in_order"] = with_(F7, _F7_LATEST) + """SELECT symbol, "date", close,
    row_number() OVER (ORDER BY "date", symbol) AS row_number FROM lf7 WHERE "date" <= DATE '2001-05-31'"""
SQL["prices_since_in_where"] = with_(F7, _F7_LATEST) + """SELECT symbol, "date", close, volume FROM lf7
    WHERE "date" > DATE '1997-03-10' AND "date" <= DATE '1997-08-20' AND close > 100"""
SQL["rejected_requests"] = with_(F7) + """, days AS (SELECT symbol, min("date") AS a, max("date") AS b FROM f7 GROUP BY symbol),
    asked AS (SELECT symbol, a AS "start", b AS "end" FROM days UNION ALL SELECT symbol, b, a FROM days)
    SELECT symbol, "start", "end", CASE WHEN "start" > "end" THEN 'start must be on or before end' END AS message FROM asked"""
