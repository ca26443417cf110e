"""Run the warehouse jobs from the command line (directly, or as the module spark-submit runs).

    python -m equitylake seed-universe   --root R --landing L
    python -m equitylake seed-statements --root R --landing L --cache C [--years 15] [--as-of 2026-08-10]
    python -m equitylake stage           --root R --landing L --staging S [--shard-size 100]
    python -m equitylake load            --root R --staging S [--year 2025]
    python -m equitylake refresh         --root R --landing L
    python -m equitylake ingest          --root R --landing L --checkpoint C [--every "1 hour"]

The master and cluster settings come from the launcher. Each command prints
one JSON line describing what it did.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date

from equitylake.plans import price_load
from equitylake.plans.statement_build import seed_statements
from equitylake.plans.universe_build import seed_universe
from equitylake.session import get_session
from equitylake.sources.store import Store
from equitylake.specs import TICKER_UNIVERSE
from equitylake.streaming.landing import ingest_available, start_landing_ingest


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m equitylake", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *args: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        c.add_argument("--root", required=True, help="store root (shared file system)")
        for a in args:
            c.add_argument(f"--{a}", required=True)
        return c

    command("seed-universe", "landing")
    c = command("seed-statements", "landing", "cache")
    c.add_argument("--years", type=int, default=15)
    c.add_argument("--as-of", type=date.fromisoformat, default=None)
    c = command("stage", "landing", "staging")
    c.add_argument("--shard-size", type=int, default=price_load.SHARD_SIZE)
    c = command("load", "staging")
    c.add_argument("--year", type=int, default=None)
    command("refresh", "landing")
    c = command("ingest", "landing", "checkpoint")
    c.add_argument("--every", default=None, help='keep running on this trigger, e.g. "1 hour"')
    c.add_argument("--max-files", type=int, default=None)
    return p


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = get_session()
    store = Store(spark, args.root)
    if args.command == "seed-universe":
        audit = seed_universe(store, args.landing)
        result = {"shards": [r.asDict() for r in audit.orderBy("part").collect()] if audit is not None else []}
    elif args.command == "seed-statements":
        result = {"rows": seed_statements(store, args.landing, args.cache, args.years, args.as_of)}
    elif args.command == "stage":
        symbols = store.read(TICKER_UNIVERSE, columns=["symbol"], ordered=False)
        staged, failed = price_load.stage(spark, symbols, args.landing, args.staging, args.shard_size)
        result = {"staged": staged, "failed": failed}
    elif args.command == "load":
        result = {"rows": price_load.load(store, args.staging, args.year)}
    elif args.command == "refresh":
        result = {"rows": price_load.refresh_prices(store, args.landing)}
    else:
        if args.every:
            query = start_landing_ingest(spark, store, args.landing, args.checkpoint, args.max_files, args.every)
            query.awaitTermination()
        else:
            ingest_available(spark, store, args.landing, args.checkpoint, args.max_files)
        result = {"ingested": True}
    print(json.dumps({"command": args.command, **result}, default=str))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
