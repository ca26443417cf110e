"""Column builders: classification, lenient coercions, header names, calendars."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from equitylake.functions.calendar import fiscal_years, history_start
from equitylake.functions.classify import classify_security
from equitylake.functions.names import snake_case
from equitylake.functions.text import as_bool, as_date, as_float, as_str, first_present, normalize_symbols
from equitylake.specs import BALANCE_SHEET, CASH_FLOW, INCOME_STATEMENT, RATIOS

CASES = [
    ("AAPL", "common"), ("BRK-B", "common"), ("BF-A", "common"), ("AKO-B", "common"), ("AGM-A", "common"),
    ("AACB", "common"), ("AACBR", "right"), ("AACBU", "unit"), ("AAC-UN", "unit"),
    ("ARQQW", "warrant"), ("ALVOW", "warrant"), ("ACHR-WT", "warrant"),
    ("ABR-PD", "preferred"), ("ACP-PA", "preferred"),
    ("SNOW", "common"), ("HOUR", "common"), ("ACIU", "common"),
]


def classify_rows(spark, rows):
    df = spark.createDataFrame(rows, "symbol string, name string, etf boolean, fund boolean")
    out = df.select("symbol", classify_security(F.col("symbol"), F.col("name"), F.col("etf"), F.col("fund")).alias("k"))
    return {r.symbol: r.k for r in out.collect()}


def test_classifier_ticker_conventions(spark):
    got = classify_rows(spark, [(s, None, False, False) for s, _ in CASES])
    assert got == dict(CASES)


def test_classifier_name_and_flags(spark):
    got = classify_rows(spark, [
        ("AGNCZ", "AGNC Investment Corp. 8.75% Series H", False, False),
        ("CORZZ", "Core Scientific, Inc.", False, False),
        ("FOOW", None, True, False), ("BARU", None, False, True), ("SPY", None, True, False),
        ("ABLVW", "Able View Inc.", False, False), ("XYZ-", None, False, False), (" abcdw ", None, False, False),
    ])
    assert got == {"AGNCZ": "preferred", "CORZZ": "warrant", "FOOW": "etf", "BARU": "fund", "SPY": "etf",
                   "ABLVW": "warrant", "XYZ-": "common", " abcdw ": "warrant"}


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("o")).first().o


@pytest.mark.parametrize("text,expected", [
    ("true", True), (" TRUE ", True), ("1", True), ("Yes", True), ("false", False), ("0", False), ("no", False),
    ("y", None), ("maybe", None), ("", None), (None, None)])
def test_as_bool(spark, text, expected):
    assert one(spark, as_bool, text) is expected


@pytest.mark.parametrize("text,expected", [
    ("165.8", 165.8), (" 1e3 ", 1000.0), ("-.5", -0.5), ("1_000", 1000.0), ("1.5d", None), ("n/a", None),
    ("", None), (None, None), ("inf", float("inf"))])
def test_as_float(spark, text, expected):
    assert one(spark, as_float, text) == expected


def test_as_str_and_date(spark):
    assert one(spark, as_str, " \tabc\n") == "abc"
    assert one(spark, as_str, " \t ") is None
    assert one(spark, as_date, "1990-01-02 00:00:00") == date(1990, 1, 2)
    assert one(spark, as_date, " 2001-09-04") == date(2001, 9, 4)
    assert one(spark, as_date, "2011") is None
    assert one(spark, as_date, "unknown") is None


def test_first_present_skips_blank_and_missing(spark):
    df = spark.createDataFrame([(" ", "42.5", None)], "marketCap string, market_cap string, other string")
    assert df.select(first_present(df.columns, "mktCap", "marketCap", "market_cap").alias("v")).first().v == "42.5"


def test_normalize_symbols():
    assert normalize_symbols(" aapl ") == ["AAPL"]
    assert normalize_symbols(["msft", "MSFT ", "", "nvda"]) == ["MSFT", "NVDA"]
    assert normalize_symbols(None) is None


def test_snake_case_keeps_acronyms():
    assert snake_case("netIncomePerEBT") == "net_income_per_ebt"
    assert snake_case("ebitda") == "ebitda"
    assert snake_case("fiscalYear") == "fiscal_year"
    assert snake_case("priceToEarningsRatio") == "price_to_earnings_ratio"
    assert snake_case("EBITDAMargin") == "ebitda_margin"


def test_statement_schemas_have_declared_widths():
    assert [len(s.schema) for s in (INCOME_STATEMENT, BALANCE_SHEET, CASH_FLOW, RATIOS)] == [39, 61, 47, 66]


def test_history_windows():
    assert history_start(15, as_of=date(2026, 8, 10)) == date(2011, 8, 11)
    assert list(fiscal_years(3, as_of=date(1998, 6, 30))) == [1996, 1997, 1998]
