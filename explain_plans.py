"""Write PLANS.md: the physical plans of the core operators at one scale factor.

    python explain_plans.py [sf_dir]

Each plan is Spark's ``explain("formatted")`` output for the DataFrame an
operator builds, so pushed filters, partition filters, exchanges and
broadcasts can be read without running anything.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from equitylake.operators.latest import latest_wins, merge_latest  # noqa: E402
from equitylake.plans import catalog, fixtures as fx, queries as q  # noqa: E402
from equitylake.plans.statement_build import build_statement_table  # noqa: E402
from equitylake.plans.universe_build import build_universe  # noqa: E402
from equitylake.session import get_session  # noqa: E402
from equitylake.specs import DAILY_PRICES, INCOME_STATEMENT  # noqa: E402


def formatted(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="formatted")
    return out.getvalue().replace(os.path.dirname(os.path.abspath(__file__)), ".")


def main(sf_dir: str) -> None:
    spark = get_session("local[8]", shuffle_partitions=8)
    market = catalog.market_store(spark, sf_dir)
    stored = market.scan(DAILY_PRICES).filter(F.col("pmonth") == 202401).drop("pmonth")
    fresh = fx.price_feed(spark, sf_dir).filter(F.col("feed") == "click")
    plans = [
        ("Q7 price panel (flagship): universe screen semi-joined to a date window",
         q.price_panel(market, start=date(2024, 1, 3), end=date(2024, 1, 28), security_type=["etf"])),
        ("Q1 daily prices: symbols + date range pushed to the scan, partition filter from the grain",
         q.daily_prices(market, ["U7", "U8"], date(2024, 1, 5), date(2024, 1, 25))),
        ("AGG1 latest-wins: partial WindowGroupLimit before the exchange",
         latest_wins(fx.price_feed(spark, sf_dir), DAILY_PRICES.key, ["seq"])),
        ("SNK2 range upsert merge: touched partition of the stored table overlaid by fresh rows",
         merge_latest(stored, fresh.select(*DAILY_PRICES.columns, "seq"), DAILY_PRICES.key, ["seq"])),
        ("J4+J5 statement build, narrowed to the equity screen before parsing",
         build_statement_table(fx.statement_text(spark, sf_dir), INCOME_STATEMENT, "fiscalYear", "period",
                               ["seq"], wanted=q.equity_symbols(market, ordered=False))),
        ("J1 universe build: staged projections, filter after the window",
         build_universe(fx.profile_text(spark, sf_dir), catalog.RUN_TS, ["part", "seq"])),
    ]
    lines = ["# Physical plans of the core operators", "",
             f"Generated by `python explain_plans.py {sf_dir}` (Spark's `explain(\"formatted\")`).", ""]
    for title, df in plans:
        lines += [f"## {title}", "", "```", formatted(df).rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.abspath(__file__)), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01")
