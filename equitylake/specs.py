"""Declared tables: name, ordered schema, row key, and partition grain.

Schemas are fixed, never inferred. The key is also the read order. A table
whose leading key column is a date is *time-indexed*: it is stored in
partitions of a date grain (month for prices, year for statements) so that a
date-range read prunes directories and an upsert rewrites only the grains it
touches. The universe has no time index and is stored as whole versions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

GRAIN_COLUMN = {"day": "pday", "month": "pmonth", "year": "pyear"}


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    grain: str | None = None  # "day" | "month" | "year" | None

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def dtype(self, name: str) -> T.DataType:
        return self.schema[name].dataType

    @property
    def time_index(self) -> str | None:
        lead = self.key[0]
        if isinstance(self.dtype(lead), (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return lead
        return None

    @property
    def partition_column(self) -> str | None:
        return GRAIN_COLUMN[self.grain] if self.grain else None

    def grain_of(self, col: Column) -> Column:
        """Partition value (int) of a date column: yyyymmdd, yyyymm or yyyy."""
        if self.grain == "day":
            return (F.year(col) * 10_000 + F.month(col) * 100 + F.day(col)).cast("int")
        if self.grain == "month":
            return (F.year(col) * 100 + F.month(col)).cast("int")
        if self.grain == "year":
            return F.year(col).cast("int")
        raise ValueError(f"{self.name} has no partition grain")

    def grain_value(self, day) -> int:
        """Partition value of a Python date, for building partition filters."""
        if self.grain == "day":
            return day.year * 10_000 + day.month * 100 + day.day
        if self.grain == "month":
            return day.year * 100 + day.month
        return day.year

    def grain_span(self, value: Column) -> tuple[Column, Column]:
        """First and last day of a partition value."""
        if self.grain == "day":
            day = F.make_date(F.floor(value / 10_000).cast("int"), F.floor(value / 100).cast("int") % 100, value % 100)
            return day, day
        if self.grain == "month":
            first = F.make_date(F.floor(value / 100).cast("int"), value % 100, F.lit(1))
            return first, F.last_day(first)
        return F.make_date(value, F.lit(1), F.lit(1)), F.make_date(value, F.lit(12), F.lit(31))

    @property
    def stored_schema(self) -> T.StructType:
        """Schema of the parquet files, partition column included."""
        if not self.partition_column:
            return self.schema
        return T.StructType(self.schema.fields + [T.StructField(self.partition_column, T.IntegerType())])


@dataclass(frozen=True)
class StatementSpec:
    """One statement feed: its name, whether it is filed, and its field list."""

    name: str
    filed: bool
    fields: tuple[str, ...] = field(repr=False)

    @property
    def schema(self) -> T.StructType:
        ident = [
            T.StructField("date", T.DateType()),
            T.StructField("symbol", T.StringType()),
            T.StructField("fiscal_year", T.IntegerType()),
            T.StructField("period", T.StringType()),
            T.StructField("reported_currency", T.StringType()),
        ]
        if self.filed:
            ident += [
                T.StructField("cik", T.StringType()),
                T.StructField("filing_date", T.DateType()),
                T.StructField("accepted_date", T.TimestampNTZType()),
            ]
        return T.StructType(ident + [T.StructField(n, T.DoubleType()) for n in self.fields])


def _struct(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in pairs])


S, D, DT, L, I, B = T.StringType(), T.DoubleType(), T.DateType(), T.LongType(), T.IntegerType(), T.BooleanType()

# The stored schemas -- column names, types and order -- and keys.
DAILY_PRICES = TableSpec(
    "daily_prices",
    _struct(("symbol", S), ("date", DT), ("open", D), ("high", D), ("low", D),
            ("close", D), ("adj_close", D), ("volume", L)),
    key=("date", "symbol"),
    grain="month",
)

TICKER_UNIVERSE = TableSpec(
    "ticker_universe",
    _struct(("symbol", S), ("company_name", S), ("security_type", S), ("exchange", S),
            ("exchange_full_name", S), ("sector", S), ("industry", S), ("country", S),
            ("currency", S), ("market_cap", D), ("beta", D), ("price", D), ("ipo_date", DT),
            ("cik", S), ("isin", S), ("cusip", S), ("is_etf", B), ("is_fund", B),
            ("is_adr", B), ("last_updated", T.TimestampType())),
    key=("symbol",),
)

# ---------------------------------------------------------------------------
# Statement field names, in the vendor's published order. They
# must equal the feed's columns (after camelCase -> snake_case) exactly.
# ---------------------------------------------------------------------------
INCOME_FIELDS = tuple("""
revenue cost_of_revenue gross_profit research_and_development_expenses
general_and_administrative_expenses selling_and_marketing_expenses
selling_general_and_administrative_expenses other_expenses operating_expenses
cost_and_expenses net_interest_income interest_income interest_expense
depreciation_and_amortization ebitda ebit non_operating_income_excluding_interest
operating_income total_other_income_expenses_net income_before_tax income_tax_expense
net_income_from_continuing_operations net_income_from_discontinued_operations
other_adjustments_to_net_income net_income net_income_deductions bottom_line_net_income eps
eps_diluted weighted_average_shs_out weighted_average_shs_out_dil
""".split())

BALANCE_FIELDS = tuple("""
cash_and_cash_equivalents short_term_investments cash_and_short_term_investments
net_receivables accounts_receivables other_receivables inventory prepaids
other_current_assets total_current_assets property_plant_equipment_net goodwill
intangible_assets goodwill_and_intangible_assets long_term_investments tax_assets
other_non_current_assets total_non_current_assets other_assets total_assets total_payables
account_payables other_payables accrued_expenses short_term_debt
capital_lease_obligations_current tax_payables deferred_revenue other_current_liabilities
total_current_liabilities long_term_debt capital_lease_obligations_non_current
deferred_revenue_non_current deferred_tax_liabilities_non_current
other_non_current_liabilities total_non_current_liabilities other_liabilities
capital_lease_obligations total_liabilities treasury_stock preferred_stock common_stock
retained_earnings additional_paid_in_capital accumulated_other_comprehensive_income_loss
other_total_stockholders_equity total_stockholders_equity total_equity minority_interest
total_liabilities_and_total_equity total_investments total_debt net_debt
""".split())

CASH_FLOW_FIELDS = tuple("""
net_income depreciation_and_amortization deferred_income_tax stock_based_compensation
change_in_working_capital accounts_receivables inventory accounts_payables
other_working_capital other_non_cash_items net_cash_provided_by_operating_activities
investments_in_property_plant_and_equipment acquisitions_net purchases_of_investments
sales_maturities_of_investments other_investing_activities
net_cash_provided_by_investing_activities net_debt_issuance long_term_net_debt_issuance
short_term_net_debt_issuance net_stock_issuance net_common_stock_issuance
common_stock_issuance common_stock_repurchased net_preferred_stock_issuance
net_dividends_paid common_dividends_paid preferred_dividends_paid other_financing_activities
net_cash_provided_by_financing_activities effect_of_forex_changes_on_cash net_change_in_cash
cash_at_end_of_period cash_at_beginning_of_period operating_cash_flow capital_expenditure
free_cash_flow income_taxes_paid interest_paid
""".split())

RATIO_FIELDS = tuple("""
gross_profit_margin ebit_margin ebitda_margin operating_profit_margin pretax_profit_margin
continuous_operations_profit_margin net_profit_margin bottom_line_profit_margin
receivables_turnover payables_turnover inventory_turnover fixed_asset_turnover
asset_turnover current_ratio quick_ratio solvency_ratio cash_ratio price_to_earnings_ratio
price_to_earnings_growth_ratio forward_price_to_earnings_growth_ratio
price_to_earnings_diluted_ratio price_to_earnings_diluted_growth_ratio price_to_book_ratio
price_to_sales_ratio price_to_free_cash_flow_ratio price_to_operating_cash_flow_ratio
debt_to_assets_ratio debt_to_equity_ratio debt_to_capital_ratio
long_term_debt_to_capital_ratio financial_leverage_ratio working_capital_turnover_ratio
operating_cash_flow_ratio operating_cash_flow_sales_ratio
free_cash_flow_operating_cash_flow_ratio debt_service_coverage_ratio interest_coverage_ratio
short_term_operating_cash_flow_coverage_ratio operating_cash_flow_coverage_ratio
capital_expenditure_coverage_ratio dividend_paid_and_capex_coverage_ratio
dividend_payout_ratio dividend_yield dividend_yield_percentage revenue_per_share
net_income_per_share interest_debt_per_share cash_per_share book_value_per_share
tangible_book_value_per_share shareholders_equity_per_share operating_cash_flow_per_share
capex_per_share free_cash_flow_per_share net_income_per_ebt ebt_per_ebit
price_to_fair_value debt_to_market_cap effective_tax_rate enterprise_value_multiple
dividend_per_share
""".split())

# Period codes per cadence.
ANNUAL_PERIODS = ("FY",)
QUARTERLY_PERIODS = ("Q1", "Q2", "Q3", "Q4")

INCOME_STATEMENT = StatementSpec("income_statement", True, INCOME_FIELDS)
BALANCE_SHEET = StatementSpec("balance_sheet", True, BALANCE_FIELDS)
CASH_FLOW = StatementSpec("cash_flow", True, CASH_FLOW_FIELDS)
RATIOS = StatementSpec("ratios", False, RATIO_FIELDS)
STATEMENTS = {s.name: s for s in (INCOME_STATEMENT, BALANCE_SHEET, CASH_FLOW, RATIOS)}


def _statement_table(statement: StatementSpec, cadence: str) -> TableSpec:
    return TableSpec(f"{statement.name}_{cadence}", statement.schema, key=("date", "symbol"), grain="year")


STATEMENT_TABLES = {
    (s.name, cadence): _statement_table(s, cadence)
    for s in STATEMENTS.values()
    for cadence in ("annual", "quarterly")
}

TABLES = {DAILY_PRICES.name: DAILY_PRICES, TICKER_UNIVERSE.name: TICKER_UNIVERSE}
TABLES.update({t.name: t for t in STATEMENT_TABLES.values()})

CADENCES = ("annual", "quarterly")


def statement_table(statement: str, cadence: str) -> TableSpec:
    """Pick a statement table by cadence; anything but annual/quarterly is an error."""
    if cadence not in CADENCES:
        raise ValueError(f"cadence must be one of {list(CADENCES)}, got {cadence!r}")
    return STATEMENT_TABLES[(statement, cadence)]
