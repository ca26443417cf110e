"""J4/J5: normalise statement parts and build the statement tables.

A *part* is one (statement, fiscal-year bucket, period) file from the vendor.
J4 turns one all-text part into typed rows: headers to snake_case, each
declared column parsed leniently (absent -> typed null), symbols upper-cased
and stripped, optionally narrowed to a wanted symbol set, null keys dropped,
and the last row per (date, symbol) kept. J5 runs J4 over *all* parts at
once: the vendor's year bucket is not the period end, so neighbouring
buckets overlap and the later part must win. Both de-duplications collapse
into one latest-wins over the composite order (year, period, position).
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equitylake.functions.calendar import HISTORY_YEARS, fiscal_years, period_index, periods_for
from equitylake.functions.names import snake_columns
from equitylake.functions.text import as_float, as_int, as_timestamp_ntz, normalize_symbol
from equitylake.operators.joins import semi_join
from equitylake.operators.latest import latest_wins
from equitylake.plans.queries import equity_symbols
from equitylake.session import side_by_side
from equitylake.sources import files, landed
from equitylake.specs import CADENCES, STATEMENTS, StatementSpec, statement_table

_ISO_DAY = r"^\d{4}-\d{2}-\d{2}$"


def _parse(c: Column, dtype: T.DataType) -> Column:
    """One text column to its declared type; anything unparsable is null."""
    if isinstance(dtype, T.DateType):
        return F.when(c.rlike(_ISO_DAY), F.try_to_date(c, "yyyy-MM-dd"))
    if isinstance(dtype, T.TimestampNTZType):
        return as_timestamp_ntz(c)
    if isinstance(dtype, T.IntegerType):
        return as_int(c)
    if isinstance(dtype, T.DoubleType):
        return F.nullif(as_float(c), F.lit(float("nan")))
    return c.cast(dtype)


def typed_statement(raw: DataFrame, statement: StatementSpec, carry: Sequence[str] = ()) -> DataFrame:
    """PRJ3 + PRJ4 + SCL5/SCL6: rename, parse, normalise symbols.

    ``carry`` names columns (already snake_case) passed through unchanged,
    such as the part's year, period and the row position.
    """
    df = snake_columns(raw)
    present = set(df.columns)
    out = []
    for f in statement.schema.fields:
        if f.name in present:
            c = _parse(F.col(f"`{f.name}`").cast("string"), f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if f.name == "symbol":
            c = normalize_symbol(c)
        out.append(c.alias(f.name))
    return df.select(*out, *[F.col(f"`{c}`") for c in carry])


def narrow(typed: DataFrame, wanted: DataFrame | None) -> DataFrame:
    """FLT10: keep rows of wanted symbols (semi join, bounded broadcast)."""
    return typed if wanted is None else semi_join(typed, wanted.select("symbol"), "symbol")


_PART = ["__part_year", "__part_period"]


def _typed_parts(raw: DataFrame, statement: StatementSpec, part_year: str, part_period: str,
                 position: Sequence[str], wanted: DataFrame | None) -> DataFrame:
    """Typed, narrowed rows with non-null keys, tagged with their part.

    Narrowing runs first, on the normalised symbol alone: the global feed is
    mostly symbols outside the screen, and parsing every field of a row that
    is then dropped would be the bulk of the work.
    """
    tagged = raw.withColumn(_PART[0], F.col(part_year).cast("int")).withColumn(_PART[1], F.col(part_period))
    if wanted is not None:
        tagged = snake_columns(tagged)
        key = normalize_symbol(F.col("symbol")) if "symbol" in tagged.columns else F.lit(None).cast("string")
        tagged = semi_join(tagged.withColumn("__symbol", key),
                           wanted.select(F.col("symbol").alias("__symbol")), "__symbol").drop("__symbol")
    typed = typed_statement(tagged, statement, carry=_PART + list(position))
    return typed.dropna(subset=["date", "symbol"])


def normalise_parts(raw: DataFrame, statement: StatementSpec, part_year: str, part_period: str,
                    position: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """J4 over every part in ``raw``: one row per (part, date, symbol).

    ``part_year``/``part_period`` name the columns identifying each row's part;
    ``position`` orders rows inside a part.
    """
    typed = _typed_parts(raw, statement, part_year, part_period, position, wanted)
    return latest_wins(typed, _PART + ["date", "symbol"], list(position))


def restate(parts: DataFrame, statement: StatementSpec, position: Sequence[str]) -> DataFrame:
    """J5: across parts, the later (year, period) wins; within one, the later row."""
    order = [F.col(_PART[0]), period_index(F.col(_PART[1])), *[F.col(p) for p in position]]
    return latest_wins(parts, ["date", "symbol"], order).select(*statement.schema.names)


def build_statement_table(raw: DataFrame, statement: StatementSpec, part_year: str, part_period: str,
                          position: Sequence[str], wanted: DataFrame | None = None) -> DataFrame:
    """J4 + J5 as one latest-wins pass (one shuffle).

    Keeping the last row per (part, date, symbol) and then the last part per
    (date, symbol) selects exactly the row that sorts last by (year, period,
    position) within (date, symbol), so the per-part pass is folded away.
    """
    return restate(_typed_parts(raw, statement, part_year, part_period, position, wanted), statement, position)


PART_ORDER = ("_file", "_block", "_row")


# ------------------------------------------------------------- part cache
def _part_of(path: str) -> tuple[str, str] | None:
    """(year, period) from a ``.../year=Y/period_part=P/...`` path."""
    year = period = None
    for seg in path.split("/"):
        if seg.startswith("year="):
            year = seg[5:]
        elif seg.startswith("period_part="):
            period = seg[12:]
    return (year, period) if year is not None and period is not None else None


def _ledger_path(cache: str, statement: StatementSpec) -> str:
    return f"{cache}/statement={statement.name}/_parts.json"


def cached_parts(spark, cache: str, statement: StatementSpec) -> dict[tuple[str, str], str]:
    """Parts in the cache, those that keep no row included -> what each was made from."""
    path = _ledger_path(cache, statement)
    if not files.exists(spark, path):
        return {}
    return {(year, period): made for year, period, made in json.loads(files.read_text(spark, path))}


def _fingerprint(wanted: DataFrame | None) -> str:
    """Tells one wanted set from another: its size and a sum of its members' hashes."""
    if wanted is None:
        return "all"
    n, total = wanted.select("symbol").distinct().agg(
        F.count("symbol"), F.sum(F.xxhash64("symbol").cast("decimal(38,0)"))).first()
    return f"{n}:{total or 0}"


def cache_statement_parts(spark, landing: str, cache: str, statement: StatementSpec,
                          wanted: DataFrame | None = None) -> int:
    """SNK6: normalise (J4) every landed part that the cache does not hold as it is now; returns how many.

    The ledger says which files (by name, size and time) and which wanted set
    a part was made from: a late or changed file, or another wanted set, makes
    it anew, and a part that keeps no row is not asked for again. The ledger
    is written after the data, so parts of a crashed run are redone.
    """
    done = cached_parts(spark, cache, statement)
    of: dict[tuple[str, str], list[str]] = {}
    for path, stamp in files.stamps(spark, landing, (".csv",)).items():
        if f"/statement={statement.name}/" in path and (part := _part_of(path)) is not None:
            of.setdefault(part, []).append(f"{path} {stamp}")
    kept = _fingerprint(wanted)
    made = {part: hashlib.sha256("\n".join([kept, *sorted(found)]).encode()).hexdigest() for part, found in of.items()}
    todo = {part for part in made if done.get(part) != made[part]}
    if not todo:
        return 0
    folder = f"{cache}/statement={statement.name}"
    raw = landed.read_csv_by_header(spark, landing, [f.rpartition(" ")[0] for part in sorted(todo) for f in of[part]])
    before = files.stamps(spark, folder, (".parquet",))
    if raw is not None:
        parts = normalise_parts(raw, statement, "year", "period_part", list(PART_ORDER), wanted)
        (parts.select(*statement.schema.names, F.col(_PART[0]).alias("year"), F.col(_PART[1]).alias("period_part"))
              .repartitionByRange("year", "period_part", "date", "symbol")
              .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
              .partitionBy("year", "period_part").parquet(folder))
    # The write has replaced the directories of all parts that keep a row; what an
    # older run left of a part that keeps none any more goes now.
    stale = {_part_of(path) for path in before.keys() & files.stamps(spark, folder, (".parquet",)).keys()} & todo
    for year, period in stale:
        files.delete(spark, f"{folder}/year={year}/period_part={period}")
    ledger = done | {part: made[part] for part in todo}
    files.replace_text(spark, _ledger_path(cache, statement), json.dumps([[*part, m] for part, m in sorted(ledger.items())]))
    return len(todo)


def read_cached_parts(spark, cache: str, statement: StatementSpec) -> DataFrame | None:
    """SRC6: every cached part of one statement, with its (year, period)."""
    if not cached_parts(spark, cache, statement):
        return None
    schema = T.StructType(statement.schema.fields + [T.StructField("year", T.IntegerType()),
                                                     T.StructField("period_part", T.StringType())])
    folder = f"{cache}/statement={statement.name}"
    if not files.list_dirs(spark, folder, "year="):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def restate_cached(parts: DataFrame, statement: StatementSpec) -> DataFrame:
    """J5 over cached parts: each part is already one row per key, so only
    the part order (year, period) decides."""
    order = [F.col("year"), period_index(F.col("period_part"))]
    return latest_wins(parts, ["date", "symbol"], order).select(*statement.schema.names)


def seed_statements(store, landing: str, cache: str, years: int = HISTORY_YEARS,
                    as_of: date | None = None, parallel: int = 4) -> dict[str, int]:
    """J5 as a job: every statement family x cadence, narrowed to the equity
    screen, replaces its table. Landed parts go through the part cache (only
    new parts are normalised); only parts of the fiscal-year window and the
    cadence's periods are read back (partition pruning). Returns rows written
    per table. An empty equity universe is an error.

    The families are independent (own cache folder, own tables), so up to
    ``parallel`` of them run as concurrent Spark jobs, each family in a
    scheduler pool of its own: each is small next to a cluster, and one
    family's stragglers no longer idle the rest.
    """
    spark = store.spark
    wanted = equity_symbols(store, ordered=False)
    if wanted.isEmpty():
        raise RuntimeError("ticker_universe has no equities; build the universe first")
    span = fiscal_years(years, as_of=as_of or date.today())

    def seed_family(statement: StatementSpec) -> dict[str, int]:
        written = {}
        cache_statement_parts(spark, landing, cache, statement, wanted)
        parts = read_cached_parts(spark, cache, statement)
        for cadence in CADENCES:
            spec = statement_table(statement.name, cadence)
            if parts is None:
                written[spec.name] = store.write(spec, store.empty(spec), keyed=True)
                continue
            window = parts.filter(F.col("year").between(span.start, span.stop - 1)
                                  & F.col("period_part").isin(*periods_for(cadence)))
            written[spec.name] = store.write(spec, restate_cached(window, statement), keyed=True)
        return written

    results = side_by_side(spark, {name: functools.partial(seed_family, s) for name, s in STATEMENTS.items()}, parallel)
    return {name: rows for family in results.values() for name, rows in family.items()}
