"""The table store: read (SRC1), replace (SNK1), latest-wins upsert (SNK2, SNK3).

Layout under one root (any Hadoop file system: HDFS, object store, local)::

    <root>/<table>/v=000007/                          what one commit wrote
    <root>/<table>/v=000007/pmonth=202401/*.parquet   time-indexed tables
    <root>/<table>/_manifests/000007.json             the directories that make up version 7, and
                                                      which of them hold each key once

A version counts only once its manifest exists; the manifest is renamed into
place when all its data is written, so a crashed write is invisible and every
commit is atomic. Files are never changed: a replace writes the whole table
into a new directory, and an upsert of a time-indexed table writes only the
month (prices) or year (statements) partitions the fresh batch touches, whose
directories its manifest names in place of the old ones. A frame read before
an upsert goes on reading the version it was planned on. Superseded versions
are deleted once they are neither among the newest nor younger than the
retention time. Two writers of one table conflict loudly: the later one finds
the version's directory or manifest taken.

Inside a partition, files are range-partitioned and sorted by symbol then
date, so a symbol lookup skips whole files and row groups on parquet min/max
statistics, while the date range prunes partitions by directory. An upsert into directories that
hold each key once keeps the stored rows by an anti join with the fresh keys:
they are neither windowed nor shuffled before the layout.
"""

from __future__ import annotations

import functools
import json
import time
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equitylake.functions.text import normalize_symbols
from equitylake.operators.conform import conform, resolve_columns
from equitylake.operators.joins import once, semi_join
from equitylake.operators.latest import merge_latest, overlay
from equitylake.operators.predicates import all_of, date_between, symbol_in
from equitylake.sources import files
from equitylake.specs import TableSpec

# Fixed value: the text that rejects a date range on a table without dates.
NOT_TIMED_MESSAGE = "{} is keyed on {!r}, which is not a time index; start/end do not apply"
KEEP_VERSIONS = 2
# A superseded version is kept this long for readers that still hold it.
RETAIN_SECONDS = 24 * 3600
# Symbol lists longer than this filter through a broadcast semi join instead
# of an IN list; the list already sits on the driver, so its size is known.
MAX_IN_LIST = 10_000
MAX_RECORDS_PER_FILE = 5_000_000
# zstd: about a fifth smaller than snappy on the price history, written as
# fast and scanned faster (measured on an 80-month history).
COMPRESSION = "zstd"
# An ordered read sorts so many stored bytes in one task, without an exchange, if its rows are not more than so many bytes in
# memory: sorted and compressed, wide rows of many nulls or rows that repeat take a hundredth of that or less.
ORDERED_BYTES = 64 << 20
ORDERED_MEMORY = 256 << 20
# Bytes of a row in a sort besides its columns, and of a text beyond the eight bytes of each column.
ROW_BYTES, TEXT_BYTES = 64, 24
# Symbol lookups skip row groups by dictionary, or by Bloom filter where a row
# group has more symbols than a dictionary holds (sized by what it meets).
SYMBOL_FILTER = {"parquet.bloom.filter.enabled#symbol": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


class Store:
    def __init__(self, spark: SparkSession, root: str, retain_seconds: float = RETAIN_SECONDS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.retain_seconds = retain_seconds

    # ------------------------------------------------------------------ paths
    def table_dir(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def _manifest_dir(self, spec: TableSpec) -> str:
        return f"{self.table_dir(spec)}/_manifests"

    def _manifest_path(self, spec: TableSpec, version: int) -> str:
        return f"{self._manifest_dir(spec)}/{version:06d}.json"

    def _versions(self, spec: TableSpec) -> list[int]:
        """Committed versions, oldest first."""
        names = files.list_names(self.spark, self._manifest_dir(spec))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _manifest(self, spec: TableSpec, version: int) -> tuple[list[str], set[str]]:
        """The data directories of a version, relative to the table's, and those that are known to hold each key once."""
        found = json.loads(files.read_text(self.spark, self._manifest_path(spec, version)))
        return found["dirs"], set(found["keyed"])

    def _dirs_of(self, spec: TableSpec, version: int) -> list[str]:
        return self._manifest(spec, version)[0]

    def _commit(self, spec: TableSpec, version: int, dirs: Iterable[str], keyed: Iterable[str] = ()) -> None:
        """Make ``dirs`` the table: the only step a reader can see."""
        files.write_new(self.spark, self._manifest_path(spec, version), json.dumps({"dirs": sorted(dirs), "keyed": sorted(keyed)}))
        self._prune(spec)

    def data_paths(self, spec: TableSpec) -> list[str] | None:
        """The directories of the current version; None if the table was never written."""
        versions = self._versions(spec)
        if not versions:
            return None
        return [f"{self.table_dir(spec)}/{d}" for d in self._dirs_of(spec, versions[-1])]

    def exists(self, spec: TableSpec) -> bool:
        return bool(self._versions(spec))

    def _prune(self, spec: TableSpec) -> None:
        """Forget versions past their time, and delete the directories no remembered one names.

        A directory above the newest version is another writer's and stays.
        """
        versions = self._versions(spec)
        superseded = {v: files.modified(self.spark, self._manifest_path(spec, after)) for v, after in zip(versions, versions[1:])}
        old = [v for v in versions[:-KEEP_VERSIONS] if time.time() - superseded[v] >= self.retain_seconds]
        for v in old:
            files.delete(self.spark, self._manifest_path(spec, v))
        named = {d for v in versions if v not in old for d in self._dirs_of(spec, v)}
        table = self.table_dir(spec)
        for name in files.list_dirs(self.spark, table, "v="):
            if int(name[2:]) > versions[-1] or name in named:
                continue
            inner = [f"{name}/{d}" for d in files.list_dirs(self.spark, f"{table}/{name}", f"{spec.partition_column}=")] if spec.partition_column else []
            if not named.intersection(inner):
                files.delete(self.spark, f"{table}/{name}")
                continue
            for d in inner:
                if d not in named:
                    files.delete(self.spark, f"{table}/{d}")

    # ------------------------------------------------------------------- read
    def empty(self, spec: TableSpec, columns: Sequence[str] | None = None) -> DataFrame:
        schema = spec.schema
        if columns is not None:
            schema = T.StructType([schema[c] for c in columns])
        return self.spark.createDataFrame([], schema)

    def scan(self, spec: TableSpec) -> DataFrame | None:
        """Every stored row of the current version, partition column included."""
        paths = self.data_paths(spec)
        return None if paths is None else self._scan_dirs(spec, paths)

    def _scan_dirs(self, spec: TableSpec, paths: Sequence[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], spec.stored_schema)
        reader = self.spark.read.schema(spec.stored_schema).option("basePath", self.table_dir(spec))
        return reader.parquet(*paths).select(*spec.stored_schema.fieldNames())  # without the version in the path

    def register_views(self, specs: Iterable[TableSpec] | None = None) -> list[str]:
        """Expose each written table to Spark SQL as a temp view of its name.

        The view is the current version, partition column (``pmonth`` /
        ``pyear``) included: a SQL filter on it prunes directories, which a
        filter on ``date`` alone does not. Returns the names registered.
        """
        from equitylake.specs import TABLES
        names = []
        for spec in (specs if specs is not None else TABLES.values()):
            df = self.scan(spec)
            if df is not None:
                df.createOrReplaceTempView(spec.name)
                names.append(spec.name)
        return names

    def read(
        self,
        spec: TableSpec,
        *,
        symbols: str | Iterable[str] | None = None,
        start: date | None = None,
        end: date | None = None,
        columns: Sequence[str] | None = None,
        where: Column | None = None,
        ordered: bool = True,
    ) -> DataFrame:
        """Filtered read; every predicate reaches the parquet scan.

        Checks run in a fixed order: unknown columns raise first; an empty
        symbol list or a never-written table returns a typed empty frame; a
        date range on a table without a time index raises.
        """
        selection = resolve_columns(spec, columns)
        tickers = normalize_symbols(symbols)
        if tickers is not None and not tickers:
            return self.empty(spec, selection)
        paths = self.data_paths(spec)
        if paths is None:
            return self.empty(spec, selection)
        if (start is not None or end is not None) and spec.time_index is None:
            raise ValueError(NOT_TIMED_MESSAGE.format(spec.name, spec.key[0]))

        preds = [where]
        if tickers is not None and len(tickers) <= MAX_IN_LIST:
            preds.append(symbol_in(tickers))
        if spec.time_index and (start is not None or end is not None):
            preds.append(date_between(spec.time_index, start, end))
            # Partition pruning is not derived from the date predicate; state
            # the grain bounds explicitly so whole directories are skipped.
            pcol = spec.partition_column
            if start is not None:
                preds.append(F.col(pcol) >= F.lit(spec.grain_value(start)))
            if end is not None:
                preds.append(F.col(pcol) <= F.lit(spec.grain_value(end)))
        pred = all_of(*preds)
        keys = None
        if tickers is not None and len(tickers) > MAX_IN_LIST:
            keys = self.spark.createDataFrame([(t,) for t in tickers], "symbol string")

        def narrowed(df: DataFrame) -> DataFrame:
            if pred is not None:
                df = df.filter(pred)
            if where is not None and spec.partition_column and spec.time_index in str(where):
                df = self._pruned_by_day(spec, df, paths)
            if keys is not None:
                df = semi_join(df, keys, "symbol", known_rows=len(tickers))
            return df.select(*selection)

        if not ordered:
            return narrowed(self._scan_dirs(spec, paths))
        within = [p for p in paths if self._in_grains(spec, p, start, end)]
        held = T.StructType([spec.schema[c] for c in selection])
        runs = [self._sorted(spec, narrowed(self._scan_dirs(spec, run)), size, memory)
                for run, size, memory in self._runs(spec, within, self._row_bytes(held))]
        if not runs:
            return self.empty(spec, selection)
        if len(runs) > 1:
            # A union of frames of one partition each is one partition, one task's work; with a frame of none it has each run's.
            runs.append(self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in held.fields]))
        return functools.reduce(DataFrame.unionByName, runs)

    @staticmethod
    def _grain_in(spec: TableSpec, path: str) -> int | None:
        """The grain a partition directory holds; None for rows without a date."""
        value = path.rpartition("=")[2]
        return int(value) if value.isdigit() else None

    def _in_grains(self, spec: TableSpec, path: str, start: date | None, end: date | None) -> bool:
        if start is None and end is None or not spec.partition_column:
            return True
        grain = self._grain_in(spec, path)
        return (grain is not None and (start is None or grain >= spec.grain_value(start))
                and (end is None or grain <= spec.grain_value(end)))

    @staticmethod
    def _row_bytes(schema: T.StructType) -> int:
        """About what a row of ``schema`` takes in a sort."""
        texts = sum(isinstance(f.dataType, T.StringType) for f in schema.fields)
        return ROW_BYTES + 8 * len(schema.fields) + TEXT_BYTES * texts

    def _rows_in(self, spec: TableSpec, paths: Sequence[str]) -> list[int]:
        """The rows of each directory, which the files' footers tell."""
        if not paths:
            return []
        stored = self._scan_dirs(spec, paths)
        if not spec.partition_column:
            return [stored.count()]
        rows = {r["g"]: r["rows"] for r in stored.groupBy(F.col(spec.partition_column).alias("g")).agg(F.count(F.lit(1)).alias("rows")).collect()}
        return [rows.get(self._grain_in(spec, p), 0) for p in paths]

    def _runs(self, spec: TableSpec, paths: Sequence[str], row_bytes: int) -> list[tuple[list[str], int, int]]:
        """Neighbouring directories in the order of their grains (rows without a date first), joined up to ORDERED_BYTES and
        ORDERED_MEMORY, with their bytes and those of their rows in memory."""
        runs: list[tuple[list[str], int, int]] = []
        ordered = sorted(paths, key=lambda p: self._grain_in(spec, p) or 0) if spec.partition_column else list(paths)
        for path, size, rows in zip(ordered, files.sizes(self.spark, ordered), self._rows_in(spec, ordered)):
            memory = rows * row_bytes
            if runs and runs[-1][1] + size <= ORDERED_BYTES and runs[-1][2] + memory <= ORDERED_MEMORY:
                runs[-1] = (runs[-1][0] + [path], runs[-1][1] + size, runs[-1][2] + memory)
            else:
                runs.append(([path], size, memory))
        return runs

    def _sorted(self, spec: TableSpec, df: DataFrame, size: int, memory: int) -> DataFrame:
        """A run's rows in key order. Runs hold disjoint, ascending dates, so their union is the table's order without a global exchange;
        one that is too large for a task is range-partitioned by itself, into as many tasks as hold its rows."""
        if size <= ORDERED_BYTES and memory <= ORDERED_MEMORY:
            laid = df.coalesce(1)
        else:
            parts = max(-(-memory // ORDERED_MEMORY), -(-size // ORDERED_BYTES))
            laid = df.repartitionByRange(parts, *spec.key)
        return laid.sortWithinPartitions(*spec.key)

    def _pruned_by_day(self, spec: TableSpec, df: DataFrame, paths: Sequence[str]) -> DataFrame:
        """FLT3: ``df``, whose filter has a condition on the date, with the directories that condition excludes left unread.

        The days of the stored grains are joined on grain and day. Spark
        infers the condition on the day from the one on the date, and from the
        days that are left which partitions to read.
        """
        grains = [self._grain_in(spec, p) for p in paths]
        if None in grains or not grains:
            return df  # rows without a date lie on no day
        first, last = spec.grain_span(F.col("g"))
        days = self.spark.createDataFrame([(g,) for g in sorted(set(grains))], "g int").select(
            F.col("g").alias("__grain"), F.explode(F.sequence(first, last)).alias("__day"))
        return df.join(F.broadcast(days), (F.col(spec.partition_column) == F.col("__grain")) & (F.col(spec.time_index) == F.col("__day")),
                       "left_semi")

    # ------------------------------------------------------------------ write
    def _layout(self, spec: TableSpec, frame: DataFrame) -> DataFrame:
        """Range-partition and sort so files cover disjoint symbol ranges.

        Range (not hash) partitioning samples the keys first, so a month or a
        symbol holding a third of the rows is split across many tasks.
        """
        cluster = ["symbol"] + [k for k in spec.key if k != "symbol"] if "symbol" in spec.key else list(spec.key)
        if spec.partition_column:
            frame = frame.withColumn(spec.partition_column, spec.grain_of(F.col(spec.time_index)))
            cluster = [spec.partition_column] + cluster
        return frame.repartitionByRange(*cluster).sortWithinPartitions(*cluster)

    def _write_dirs(self, spec: TableSpec, frame: DataFrame) -> tuple[int, list[str], int]:
        """Write ``frame`` into the next version's directory; returns the version, its directories and its rows.

        The rows are counted by the write itself, behind the last exchange.

        The number goes past every existing directory, committed or not, so
        a crashed write's leftovers are never reused, and ``errorifexists``
        makes a concurrent writer that picked the same number fail instead of
        overwriting.
        """
        table = self.table_dir(spec)
        taken = [int(n[2:]) for n in files.list_dirs(self.spark, table, "v=") if n[2:].isdigit()]
        version = max([0, *taken, *self._versions(spec)]) + 1
        name = f"v={version:06d}"
        written = Observation()
        writer = (self._layout(spec, frame).observe(written, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists")
                  .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", COMPRESSION))
        if "symbol" in spec.key:
            writer = writer.options(**SYMBOL_FILTER)
        if not spec.partition_column:
            writer.parquet(f"{table}/{name}")
            return version, [name], written.get["rows"]
        writer.partitionBy(spec.partition_column).parquet(f"{table}/{name}")
        dirs = [f"{name}/{d}" for d in files.list_dirs(self.spark, f"{table}/{name}", f"{spec.partition_column}=")]
        return version, dirs, written.get["rows"]

    def write(self, spec: TableSpec, frame: DataFrame, keyed: bool = False) -> int:
        """SNK1: replace the whole table (keys are not de-duplicated); returns the rows written.

        ``keyed``: the caller knows that ``frame`` has one row for a key, so
        later upserts need not look for duplicates among the stored rows.
        """
        version, dirs, rows = self._write_dirs(spec, conform(frame, spec.schema))
        self._commit(spec, version, dirs, dirs if keyed else ())
        return rows

    def upsert(self, spec: TableSpec, fresh: DataFrame, order: Sequence[str] | None = None, computed: bool = False) -> int:
        """Merge ``fresh`` into the table on its key; fresh rows win whole.

        ``order`` names columns of ``fresh`` that say which of its own
        duplicate rows came last (ascending); by default the scan order of
        ``fresh``, which is deterministic for a file scan (a fresh frame that
        comes out of a shuffle should name its order explicitly). An empty
        ``fresh`` is a no-op. A fresh row replaces the stored row entirely,
        so a column it lacks becomes null. ``computed``: ``fresh`` is cheap to
        read again (checkpointed). Returns the number of fresh rows (before
        de-duplication).
        """
        # Copy the order columns under private names: an order column may
        # also be a column of the table (e.g. ``last_updated``).
        order_cols = [f"__order_{i}" for i in range(len(order or []))]
        fresh = fresh.select("*", *[F.col(f"`{c}`").alias(o) for c, o in zip(order or [], order_cols)])
        order = order_cols
        # Evaluated once: a landed feed is costly to parse, and is needed for
        # its span and again for the merge.
        fresh = conform(fresh, spec.schema, keep=order)
        fresh = fresh if computed else once(fresh)
        if spec.time_index is None:
            return self._upsert_keyed(spec, fresh, order)
        return self._upsert_range(spec, fresh, order)

    def _upsert_keyed(self, spec: TableSpec, fresh: DataFrame, order: list[str]) -> int:
        """SNK3: merge with the whole table and commit it as a new version."""
        rows = fresh.count()
        if rows == 0:
            return 0
        versions = self._versions(spec)
        dirs, keyed = self._manifest(spec, versions[-1]) if versions else ([], set())
        if not dirs:
            merged = merge_latest(None, fresh, spec.key, order)
        else:
            stored = self._scan_dirs(spec, [f"{self.table_dir(spec)}/{d}" for d in dirs]).select(*spec.columns)
            if keyed.issuperset(dirs):
                merged = overlay(stored, merge_latest(None, fresh, spec.key, order), spec.key, rows)
            else:
                merged = merge_latest(stored, fresh, spec.key, order)
        version, new, _ = self._write_dirs(spec, merged)
        self._commit(spec, version, new, new)
        return rows

    def _upsert_range(self, spec: TableSpec, fresh: DataFrame, order: list[str]) -> int:
        """SNK2: rewrite only the partitions ``fresh`` touches.

        One small aggregate finds the touched grains and the fresh date span
        (bounded by the number of months or years, never by rows). Stored rows
        of directories that hold each key once are kept unless a fresh row has
        their key. Of other directories (written by ``write``, which keeps
        duplicates), the rows inside the span are merged with fresh
        latest-wins, and those outside pass through untouched.
        """
        ti, pcol = spec.time_index, spec.partition_column
        grain = spec.grain_of(F.col(ti))
        span = (fresh.groupBy(grain.alias("g"))
                     .agg(F.min(ti).alias("lo"), F.max(ti).alias("hi"),
                          F.count_if(F.col(ti).isNull()).alias("nulls"),
                          F.count(F.lit(1)).alias("rows"))
                     .collect())
        if not span:
            return 0
        if any(r["nulls"] for r in span):
            raise ValueError(f"{spec.name}: fresh rows with a null {ti!r} cannot be placed")
        grains = sorted(r["g"] for r in span)
        lo, hi = min(r["lo"] for r in span), max(r["hi"] for r in span)
        rows = sum(r["rows"] for r in span)

        versions = self._versions(spec)
        dirs, keyed = self._manifest(spec, versions[-1]) if versions else ([], set())
        touched = {f"{pcol}={g}" for g in grains}
        old = [d for d in dirs if d.rpartition("/")[2] in touched]
        loose = [d for d in old if d not in keyed]
        loose_grains = [self._grain_in(spec, d) for d in loose]

        def stored_in(chosen: Sequence[str]) -> DataFrame:
            return self._scan_dirs(spec, [f"{self.table_dir(spec)}/{d}" for d in chosen]).drop(pcol)

        parts = []
        if len(loose) < len(grains):
            own = fresh.filter(~grain.isin(loose_grains)) if loose else fresh
            latest = merge_latest(None, own, spec.key, order)
            firm = [d for d in old if d in keyed]
            parts.append(overlay(stored_in(firm), latest, spec.key, rows) if firm else latest)
        if loose:
            stored = stored_in(loose)
            in_span = F.col(ti).between(F.lit(lo), F.lit(hi))
            own = fresh.filter(grain.isin(loose_grains))
            parts.append(merge_latest(stored.filter(in_span), own, spec.key, order))
            parts.append(stored.filter(~in_span))
        version, new, _ = self._write_dirs(spec, functools.reduce(DataFrame.unionByName, parts))
        if self._versions(spec) != versions:
            raise RuntimeError(f"{spec.name} was written by another job during this upsert; run it again")
        replaced = set(old)
        kept = [d for d in dirs if d not in replaced]
        still = [d for d in new if self._grain_in(spec, d) not in loose_grains]
        self._commit(spec, version, kept + new, [d for d in kept if d in keyed] + still)
        return rows
