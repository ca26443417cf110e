"""Readers (and fixture writers) for vendor files landed on shared storage.

Layouts (one directory per vendor request):

* statement parts   ``<root>/statement=<name>/year=<Y>/period_part=<P>/*.csv``
* profile shards    ``<root>/part=<N>/*.csv | *.json`` (JSON array or JSON lines)
* price histories   ``<root>/symbol=<S>/*.json`` (one history document per line)
* bundled histories ``<root>/symbol=~bundle/*`` (per line a symbol, URL-encoded, a tab and a history document); a landing
  may hold both kinds

CSV columns bind **by header name per file**: Spark binds a CSV schema by
position and reads one header for a whole directory, so files whose headers
differ would silently swap values. One Spark job finds the first line of
every file; files are grouped by it, each group is one scan, and the groups
are unioned by name. The first character alone rejects an error payload (JSON
where CSV was expected) and skips empty files; a JSON file's records are
judged by Spark. CSV is RFC 4180: quotes are doubled, a quoted field may hold
a newline, a backslash is itself; a row with another number of fields than its
header fails the read. A file with quoted newlines cannot be split, so a CSV
or JSON-array file is one task's work: land large feeds as many files.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equitylake.functions.text import normalize_symbol
from equitylake.operators.joins import semi_join
from equitylake.sources import files

class PayloadError(RuntimeError):
    """A landed file holds a vendor error message instead of data."""


# ------------------------------------------------------------ file probing
list_files = files.list_files

#: White space and byte-order marks before the first character of a file.
_LEADING = r"(?U)^[\s\ufeff]+"


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """First non-blank line -> the files that begin with it, found by one job; of a JSON file its first character.

    Empty files are left out. Only the distinct first lines and the names of
    the files come to the driver.
    """
    if not paths:
        return {}
    lines = spark.read.text(list(paths)).select(
        F.regexp_replace("value", _LEADING, "").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    text = F.when(F.substring("line", 1, 1).isin("[", "{"), F.substring("line", 1, 1)).otherwise(F.col("line"))
    first = lines.filter("line <> ''").groupBy("file").agg(F.min_by(text, "at").alias("first"))
    found = first.groupBy("first").agg(F.array_sort(F.collect_list("file")).alias("files")).collect()
    return {r["first"]: [unquote(f) for f in r["files"]] for r in sorted(found, key=lambda r: r["files"])}


def _header_names(line: str) -> list[str]:
    import csv
    csv.field_size_limit(max(csv.field_size_limit(), len(line) + 1))
    return [h.strip() for h in next(csv.reader([line]))]


# ------------------------------------------------------------------- CSV
def read_csv_by_header(spark: SparkSession, root: str, paths: Sequence[str] | None = None) -> DataFrame | None:
    """All-text CSV scan binding columns by each file's own header (SRC2).

    Returns ``None`` when every file is empty. Raises ``PayloadError`` for a
    file that starts like JSON. Columns missing from a file come back null.
    Metadata columns ``_file``, ``_block`` and ``_row`` give the scan order.
    """
    paths = list(paths) if paths is not None else list_files(spark, root, (".csv",))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for line, found in first_lines(spark, paths).items():
        if line in ("[", "{"):
            raise PayloadError(f"unexpected payload in {found[0]}: it starts with {line!r}")
        groups[tuple(_header_names(line))] += found
    frames = []
    for header, group in groups.items():
        schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
        df = (spark.read.schema(schema).option("header", True).option("basePath", root)
              .option("mode", "FAILFAST").option("columnPruning", False)
              .option("multiLine", True).option("escape", '"').option("maxCharsPerColumn", -1)
              .option("maxColumns", max(20480, len(header) + 1)).csv(group))
        frames.append(df.select("*", *_scan_order()))
    return _union(frames)


def _scan_order():
    return [F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_row")]


def _union(frames: list[DataFrame]) -> DataFrame | None:
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# --------------------------------------------------------- profile shards
def _records_of(line_rows: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON-lines rows (``value``) as records of ``schema``.

    A line that is no JSON object, or an object with keys of which none is a
    field of ``schema``, is a vendor error message and fails the read (null
    fields are left out of JSON lines, so no single key can be required).
    """
    fields = schema.fieldNames()
    text = F.trim(F.col("value"))
    keys = F.json_object_keys(text)
    known = F.coalesce((F.size(keys) == 0) | F.arrays_overlap(keys, F.lit(fields)), F.lit(False))
    record = F.when(known, F.from_json(text, schema, {"primitivesAsString": "true"})).otherwise(
        F.raise_error(F.concat(F.lit("unexpected payload in "), F.col("_file"), F.lit(": "), F.substring(text, 1, 200))))
    carried = [c for c in line_rows.columns if c != "value"]
    return line_rows.filter(text != "").select(*carried, record.alias("_record")).select("_record.*", *carried)


def read_profile_shards(spark: SparkSession, root: str, fields: Sequence[str]) -> DataFrame | None:
    """SRC3: every shard under ``<root>/part=N/`` as all-text rows.

    CSV binds by header. JSON (an array document, or JSON lines) is read
    against an explicit all-string schema of ``fields``, so no inference pass
    runs and absent keys are null. The part number is cast to int (path
    values are text; ``'10' < '9'`` as text).
    """
    frames = []
    csv_part = read_csv_by_header(spark, root, list_files(spark, root, (".csv",)))
    if csv_part is not None:
        frames.append(csv_part)
    text = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    kinds: dict[str, list[str]] = {"[": [], "{": []}
    for line, found in first_lines(spark, list_files(spark, root, (".json",))).items():
        if line not in kinds:
            raise PayloadError(f"unexpected payload in {found[0]}: it starts with {line[:1]!r}")
        kinds[line] = found
    if kinds["["]:
        arrays = (spark.read.schema(text).option("primitivesAsString", True).option("basePath", root)
                  .option("multiLine", True).option("mode", "FAILFAST").json(kinds["["]))
        frames.append(arrays.select("*", *_scan_order()))
    if kinds["{"]:
        lines = spark.read.option("basePath", root).text(kinds["{"]).select("*", *_scan_order())
        frames.append(_records_of(lines, text))
    out = _union(frames)
    if out is None:
        return None
    if "part" not in out.columns:
        raise ValueError(f"{root}: shards must sit in part=N directories")
    return out.withColumn("part", F.col("part").cast("int"))


def write_profile_shards(df: DataFrame, root: str, part: str = "part", order: str = "seq") -> None:
    """Land rows as shards: even parts as CSV, odd parts as JSON lines.

    Each shard is written in ``order`` inside its own directory, so reading
    it back in scan order reproduces the feed order.
    """
    text_cols = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c not in (part, order)]
    # Range partitioning on (part, order) splits a large shard over several
    # files whose names (task numbers) follow the feed order.
    laid = df.repartitionByRange(part, order).sortWithinPartitions(part, order).select(*text_cols, part)
    (laid.filter(F.col(part) % 2 == 0).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(part)
         .option("header", True).option("ignoreLeadingWhiteSpace", False).option("escape", '"')
         .option("ignoreTrailingWhiteSpace", False).csv(root))
    (laid.filter(F.col(part) % 2 == 1).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(part).json(root))


# ------------------------------------------------------- statement parts
def write_statement_parts(df: DataFrame, root: str, statement: str, year: str, period: str,
                          order: str) -> None:
    """Land all-text statement rows as one CSV per (year, period).

    Headers are deliberately *not* uniform: parts of even years list their
    columns reversed, which is exactly what a by-position reader gets wrong.
    """
    data_cols = [c for c in df.columns if c != order]
    base = df.withColumn("statement", F.lit(statement)) \
             .withColumn("year", F.col(year)).withColumn("period_dir", F.col(period))
    for parity, names in ((0, list(reversed(data_cols))), (1, data_cols)):
        part = base.filter(F.col("year").cast("int") % 2 == parity)
        (part.repartitionByRange("year", "period_dir", order).sortWithinPartitions("year", "period_dir", order)
             .select(*[F.col(f"`{c}`") for c in names], "statement", "year",
                     F.col("period_dir").alias("period_part"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("statement", "year", "period_part")
             .option("header", True).option("ignoreLeadingWhiteSpace", False).option("escape", '"')
             .option("ignoreTrailingWhiteSpace", False).csv(root))


def read_statement_parts(spark: SparkSession, root: str, statement: str) -> DataFrame | None:
    """SRC2 + SET1: every landed part of one statement, bound by header."""
    files = [f for f in list_files(spark, root, (".csv",)) if f"/statement={statement}/" in f]
    return read_csv_by_header(spark, root, files)


# --------------------------------------------------------- price history
# The vendor's field names. Numbers are read as their text, so a
# quoted price is a price and anything else is told apart from a missing one.
PRICE_FIELDS = ("open", "high", "low", "close", "adjClose", "volume")
ENTRY_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in ("date", *PRICE_FIELDS)])
CORRUPT = "_corrupt"
HISTORY_SCHEMA = T.StructType([
    T.StructField("historical", T.ArrayType(ENTRY_SCHEMA)),
    T.StructField(CORRUPT, T.StringType()),
])

HISTORY_CHUNK_ROWS = 1000
#: Stands for a symbol in the path of histories of many symbols (tickers are upper case, so none is called so).
BUNDLE = "~bundle"
#: Wanted symbols up to this length are a list in the filter of a bundle's lines; more are joined.
MAX_IN_LIST = 1_000


def write_price_histories(feed: DataFrame, root: str, order: str = "seq") -> None:
    """Land a price feed as bundled history documents (the F6 fixture).

    Rows are range-partitioned and sorted by (symbol, order); the
    monotonically increasing id then follows that order, so consecutive runs
    of ``HISTORY_CHUNK_ROWS`` ids form documents of bounded size, in feed
    order, without any per-symbol window. A symbol holding a third of all rows
    becomes many documents; one task writes a symbol's documents, as this
    fixture lands all of a symbol at one time. ``historical`` is in feed order
    inside each document. Files follow the bytes, not the symbols: a directory
    for each symbol costs the driver as many renames and listings.
    """
    entry = F.struct(
        F.col(order).alias("k"),
        F.date_format("date", "yyyy-MM-dd").alias("date"), "open", "high", "low", "close",
        F.col("adj_close").alias("adjClose"), F.col("volume").cast("double").alias("volume"))
    ranked = (feed.repartitionByRange("symbol", order).sortWithinPartitions("symbol", order)
                  .withColumn("chunk", F.floor(F.monotonically_increasing_id() / HISTORY_CHUNK_ROWS).cast("long")))
    docs = (ranked.groupBy("symbol", "chunk")
                  .agg(F.array_sort(F.collect_list(entry)).alias("h"))
                  .select("symbol", "chunk",
                          F.transform("h", lambda x: x.dropFields("k")).alias("historical")))
    write_history_lines(docs.select("symbol", "chunk", F.to_json(F.struct("historical")).alias("value")), root, ["chunk"])


def write_history_lines(lines: DataFrame, root: str, order: Sequence[str]) -> None:
    """Land documents (``symbol``, ``value``) as a bundle.

    A symbol's documents land in one file, in ``order``: what a landing says
    of one symbol was landed at one time.
    """
    line = F.concat(F.coalesce(F.url_encode("symbol"), F.lit("")), F.lit("\t"), F.col("value"))
    (lines.repartition("symbol").sortWithinPartitions("symbol", *order).select(line.alias("value"))
          .write.mode("overwrite").text(f"{root}/symbol={BUNDLE}"))


def write_empty_history(spark: SparkSession, root: str, symbol: str) -> None:
    """A delisted symbol: the vendor answers a bare ``{}``."""
    spark.createDataFrame([("{}",)], "value string").coalesce(1) \
         .write.mode("overwrite").text(f"{root}/symbol={symbol}")


def _number(text):
    return text.try_cast("double")


def _bad_entry(entry):
    """An entry without a readable date, or with a price that is text but no number."""
    bad = F.try_to_date(entry["date"], "yyyy-MM-dd").isNull()
    for field in PRICE_FIELDS:
        bad = bad | (entry[field].isNotNull() & _number(entry[field]).isNull())
    return bad


def parse_history_docs(lines: DataFrame, strict: bool = True) -> DataFrame:
    """One JSON history document per text line (``value``), with its symbol.

    Blank lines are skipped. A document is bad if it is no JSON object, is
    torn or of a wrong type, or has an entry with a missing or malformed date
    or price. Strict: a bad document fails the job, naming its symbol. Not
    strict: it becomes a document with no history and ``_bad_doc`` set, so the
    caller can set its symbol aside. A ``{}`` is a good document without
    entries. Every other column of ``lines`` is carried through.
    """
    text = F.trim(F.col("value"))
    carried = [c for c in lines.columns if c != "value"]
    parsed = F.when(text.startswith("{"), F.from_json(text, HISTORY_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT}))
    docs = lines.filter(text != "").select(*carried, text.alias("_text"), parsed.alias("_doc"))
    entry_bad = F.exists(F.col("_doc.historical"), lambda e: e.isNull() | _bad_entry(e))
    bad = F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull() | F.coalesce(entry_bad, F.lit(False))
    history = F.col("_doc.historical")
    if strict:
        message = F.concat(F.lit("unexpected price payload for symbol "), F.coalesce(F.col("symbol"), F.lit("?")),
                           F.lit(": "), F.substring("_text", 1, 200))
        return docs.select(*carried, F.when(bad, F.raise_error(message)).otherwise(history).alias("historical"))
    return docs.select(*carried, bad.alias("_bad_doc"), F.when(~bad, history).alias("historical"))


HISTORY_LINES_SCHEMA = "value string, symbol string, _landed timestamp, _file string, _block bigint, _row bigint"


def named_line() -> tuple[Column, Column]:
    """Symbol and document of a landed line (``value``, in the directory of ``symbol``): of a bundle's line, the symbol stands before
    its first tab. A line of a bundle that has none, or nothing before it, has no symbol."""
    value, bundled = F.col("value"), F.col("symbol") == BUNDLE
    tab = F.instr(value, "\t")
    name = F.when(tab > 1, F.substr(value, F.lit(1), tab - 1))
    symbol = F.when(bundled, F.coalesce(F.try_url_decode(name), name)).otherwise(F.col("symbol"))
    # Tickers are upper-cased and stripped wherever they enter.
    return normalize_symbol(symbol), F.when(bundled, F.substr(value, tab + 1)).otherwise(value)


def read_history_lines(spark: SparkSession, root: str, symbols: Iterable[str] | None = None) -> DataFrame:
    """Raw history lines with their symbol (from the path, or a bundle's line) and landing order.

    ``symbols`` (normalised) reads only their directories and, of bundles,
    keeps only their lines. A landing zone that does not exist yet, or holds
    no file, reads as empty.
    """
    landed = files.list_dirs(spark, root, "symbol=")
    if symbols is not None:
        wanted = set(symbols)
        landed = [d for d in landed if d == f"symbol={BUNDLE}" or unquote(d.removeprefix("symbol=")).strip().upper() in wanted]
    if not landed:
        return spark.createDataFrame([], HISTORY_LINES_SCHEMA)
    # By their directories: others are neither listed nor read, however many are wanted.
    paths = root if symbols is None else [f"{root}/{d}" for d in landed]
    lines = spark.read.option("basePath", root).text(paths)
    if "symbol" not in lines.columns:
        if symbols is not None:  # the directories are there, but hold no file
            return spark.createDataFrame([], HISTORY_LINES_SCHEMA)
        raise ValueError(f"{root}: histories must sit in symbol=<S> directories")
    symbol, document = named_line()
    lines = lines.select(document.alias("value"), symbol.alias("symbol"),
                         F.col("_metadata.file_modification_time").alias("_landed"), *_scan_order())
    if symbols is None or f"symbol={BUNDLE}" not in landed:
        return lines
    if len(wanted) <= MAX_IN_LIST:
        return lines.filter(F.col("symbol").isin(sorted(wanted)))
    keys = spark.createDataFrame([(s,) for s in wanted], "symbol string")
    return semi_join(lines, keys, "symbol", known_rows=len(wanted)).select(*lines.columns)


def named_directories(spark: SparkSession, root: str) -> int:
    """How many directories of a landing are of one symbol each."""
    return sum(d != f"symbol={BUNDLE}" for d in files.list_dirs(spark, root, "symbol="))


def read_price_histories(spark: SparkSession, root: str) -> DataFrame:
    """SRC4: nested history documents (JSON lines), one row per document."""
    return parse_history_docs(read_history_lines(spark, root))


def shape_prices(docs: DataFrame, strict: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """PRJ6: one price row per history entry, with its feed order.

    The symbol comes with the line, not from the payload. Volume is narrowed to a
    long leniently. Not strict: rows get a ``_bad`` flag, and every document
    without entries (``{}``, an empty history, or a bad document) leaves one
    marker row with a null ``pos``, so the caller knows the symbol was landed.
    ``carry`` names extra document columns passed through (e.g. a shard).
    """
    # posexplode_outer + a filter on its output: a plain posexplode makes
    # Spark infer ``size(historical) > 0`` and push it below any semi join,
    # inlining the parse (and its raise_error) onto lines that were meant
    # to be filtered out first.
    order = [c for c in PRICE_ORDER if c != "pos"]
    keep = ["symbol", *order, *carry] + ([] if strict else ["_bad_doc"])
    rows = docs.select(*keep, F.posexplode_outer("historical").alias("pos", "h"))
    if strict:
        rows = rows.filter(F.col("pos").isNotNull())
    price = {f: _number(F.col(f"h.{f}")) for f in PRICE_FIELDS}
    return rows.select(
        "symbol", F.try_to_date(F.col("h.date"), "yyyy-MM-dd").cast("date").alias("date"),
        price["open"].alias("open"), price["high"].alias("high"), price["low"].alias("low"), price["close"].alias("close"),
        price["adjClose"].alias("adj_close"), price["volume"].try_cast("long").alias("volume"),
        *order, "pos", *carry, *([] if strict else [F.col("_bad_doc").alias("_bad")]),
    )


# The later landing wins; within one, the later file, line and entry.
PRICE_ORDER = ("_landed", "_file", "_block", "_row", "pos")
