"""Benchmark the headline queries at one scale factor; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed to completion through the ``noop`` sink (the whole
plan runs, nothing is collected to the driver). Store builds (ingest through
the upsert path) are timed as their own entries, before the reads that use
them, after an untimed warm-up of the same builds on sf0.001 (JIT and
codegen caches). Every query runs ``BENCH_REPEAT`` times (default 2); the
best time is reported.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from equitylake.plans import catalog  # noqa: E402
from equitylake.session import get_session  # noqa: E402

HEADLINE = [
    # reads over stored tables
    "daily_prices_range", "prices_full_read", "history_window", "price_panel",
    "universe_screen", "equity_symbols", "statements_quarterly", "cash_flows",
    # operators and writes
    "latest_wins_prices", "upsert_prices", "upsert_recent_months", "upsert_universe",
    "universe_build", "classify_listings", "ingest_audit",
    "statement_restated", "statements_for_equities", "statement_parts_union",
    # landed files and the stream
    "price_history_json", "landing_ingest", "backfill_load",
]

BUILDS = {
    "build_price_store": catalog.price_store,
    "build_order_price_history": catalog.order_price_store,
    "build_universe_store": catalog.universe_store,
    "build_market_store": catalog.market_store,
    "build_income_statements": lambda s, d: catalog.statement_store(s, d, "income_statement"),
    "build_cash_flows": lambda s, d: catalog.statement_store(s, d, "cash_flow"),
    "land_price_histories": catalog._landed_histories,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    spark = get_session(f"local[{cpus}]", app_name="equitylake-bench", shuffle_partitions=max(8, 2 * cpus))

    # Warm the JVM (class loading, JIT, codegen caches) with the same builds
    # on the smallest scale factor, untimed: a one-off cost per JVM that a
    # long-running cluster job never sees again.
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        for build in BUILDS.values():
            build(spark, warm_dir)
    else:
        spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}

    def timed(name: str, run, runs: int) -> None:
        best = None
        try:
            for _ in range(runs):
                t0 = time.perf_counter()
                run()
                took = time.perf_counter() - t0
                best = took if best is None else min(best, took)
            times[name] = round(best, 3)
        except Exception as exc:  # report it in the JSON line and go on
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    for name, build in BUILDS.items():
        timed(name, lambda b=build: b(spark, sf_dir), 1)
    for name in HEADLINE:
        fn = catalog.QUERIES[name]
        timed(name, lambda f=fn: f(spark, sf_dir).write.format("noop").mode("overwrite").save(), repeat)

    match = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(match.group(1)) if match else sf_dir,
    }
    if errors:
        result["errors"] = errors
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
