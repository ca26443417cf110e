"""Guards on plan shape: the performance properties the engine relies on."""

import os

import pytest

from equitylake.operators.latest import latest_wins
from equitylake.plans import fixtures as fx
from equitylake.plans.statement_build import build_statement_table
from equitylake.plans.universe_build import build_universe
from equitylake.specs import DAILY_PRICES, INCOME_STATEMENT
from test_ingest import RUN

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_wins_limits_rows_before_the_shuffle(spark):
    plan = physical(latest_wins(fx.price_feed(spark, SF), DAILY_PRICES.key, ["seq"]))
    exchange = plan.find("Exchange hashpartitioning")
    assert "Partial" in plan and "Final" in plan
    assert plan.rfind("Partial") > exchange  # the partial limit sits below (after, in the text) the exchange


def test_statement_build_narrows_before_parsing_and_shuffles_once(spark):
    wanted = spark.createDataFrame([("U1",), ("U2",)], "symbol string")
    df = build_statement_table(fx.statement_text(spark, SF), INCOME_STATEMENT, "fiscalYear", "period",
                               ["seq"], wanted=wanted)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    semi, parse = plan.find("Join LeftSemi"), plan.find("try_to_date")
    assert semi != -1 and parse != -1 and parse < semi  # the parse projection sits above the join
    assert physical(df).count("Exchange hashpartitioning") == 1


def test_universe_build_keeps_a_small_plan(spark):
    df = build_universe(fx.profile_text(spark, SF), RUN, ["part", "seq"])
    plan = physical(df)
    assert len(plan) < 30_000  # no coercion tree re-inlined into a pushed-down filter
    assert plan.count("Exchange hashpartitioning") == 1
