"""Operator 10, line dedup: sharded cuckoo filters over exact reference counts, insert and delete.

``LineIndex`` keeps, in a folder of the shared file system:

* ``refs``: the exact table, one row per (line key, document) reference, as a
  log of +1 and -1 rows, so that an insertion or a deletion only appends;
* ``filters``: for each shard of keys a cuckoo filter of the keys that have a
  live reference;
* ``met``: the keys that a filter held already when they came in again.

The filters decide which keys are counted. On the way to its shard a key
passes a filter of the keys its task has seen, then the shard's own: a key
that neither holds is new, and until it comes again it is in one document and
needs no count. Only keys that a filter held (repeated ones, and a few that
share a fingerprint) are counted exactly in the reference table; a false
positive so costs a count and never a wrong one. When a deletion takes a key's
last reference, its fingerprint leaves the filter. Shards are sized by the
references counted, and doubled when they outgrow that.

``decide`` gives the references whose lines go; ``dedup_lines`` drops the
lines. Deleting documents restores the counts they had raised, so the lines of
the others come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equitylake.llm.common import BROADCAST_ROWS, cut, fresh, looked_up, only
from equitylake.session import scratch_dir
from equitylake.sources import files

MIN_CHARS = 40
MIN_DOCS = 5
KEYS_PER_SHARD = 500_000
SLOTS = 4  # fingerprints in a cuckoo bucket
MAX_KICKS = 500
#: Keys of a task's own filter at first; a filter of twice as many follows when it is full.
TASK_KEYS = 1 << 16
LEAST_SHARDS = 8
REF_SCHEMA = "key binary, doc bigint, delta int"
FILTER_SCHEMA = "shard int, shards int, version int, n_keys bigint, buckets binary"
MET_SCHEMA = f"{FILTER_SCHEMA}, met array<binary>, asked array<binary>"
_ASCII_SPACE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z lower-cased."""
    stripped = F.trim(line, F.lit(_ASCII_SPACE))
    return F.translate(stripped, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(text: Column) -> Column:
    """The text's lines (null or empty text: one empty line)."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _digest(line: Column) -> Column:
    """SHA-256 of the line's key: equal exactly for equal keys, of bounded size."""
    return F.unhex(F.sha2(line_key(line), 256))


def references(docs: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc): the distinct keys of at least ``min_chars`` code points in each row; rows that repeat an id may repeat a pair."""
    rows = only(docs, id_col, text_col).toDF("doc", "text").where("doc is not null and text is not null")
    long = F.filter(lines_of(F.col("text")), lambda x: F.length(F.trim(x, F.lit(_ASCII_SPACE))) >= min_chars)
    keys = F.array_distinct(F.transform(long, _digest))
    return rows.select(F.col("doc").cast("bigint").alias("doc"), F.explode(keys).alias("key"))


# ------------------------------------------------------------------ cuckoo filter
class CuckooFilter:
    """Approximate set of 64-bit hashes with deletion; 16-bit fingerprints, four to a bucket, in one array."""

    def __init__(self, buckets: np.ndarray):
        self.buckets = buckets

    @classmethod
    def sized(cls, n: int) -> CuckooFilter:
        size = 1 << max(4, int(np.ceil(np.log2(max(1, n) / (SLOTS * 0.8)))))
        return cls(np.zeros((size, SLOTS), np.uint16))

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.buckets.tobytes()

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.buckets) - 1)
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (hashes & mask).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        return (np.asarray(bucket) ^ (np.asarray(prints).astype(np.int64) * 0x5BD1E995)) & (len(self.buckets) - 1)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, a, b = self._places(hashes)
        return (self.buckets[a] == prints[:, None]).any(1) | (self.buckets[b] == prints[:, None]).any(1)

    def insert(self, hashes: np.ndarray) -> bool:
        """Add one fingerprint per hash; False if the filter is too full (make a larger one)."""
        prints, a, b = self._places(hashes)
        left = np.arange(len(hashes))
        for place in (a, b):  # in bulk: as many of a bucket's arrivals as it has free slots
            left = left[np.argsort(place[left], kind="stable")]
            bucket = place[left]
            rank = np.arange(len(left)) - np.searchsorted(bucket, bucket)
            free = SLOTS - np.count_nonzero(self.buckets[bucket], axis=1)
            fits = rank < free
            slots = np.argsort(self.buckets[bucket[fits]] != 0, axis=1, kind="stable")
            self.buckets[bucket[fits], slots[np.arange(fits.sum()), rank[fits]]] = prints[left[fits]]
            left = left[~fits]
        return all(self._kick(int(a[i]), prints[i]) for i in left)

    def _kick(self, bucket: int, mark) -> bool:
        for turn in range(MAX_KICKS):
            slot = turn % SLOTS
            mark, self.buckets[bucket, slot] = self.buckets[bucket, slot], mark
            bucket = int(self._other(bucket, mark))
            empty = np.flatnonzero(self.buckets[bucket] == 0)
            if len(empty):
                self.buckets[bucket, empty[0]] = mark
                return True
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Remove one fingerprint per hash; only hashes that were inserted may be given."""
        for mark, *places in zip(*self._places(hashes)):
            for bucket in places:
                held = np.flatnonzero(self.buckets[bucket] == mark)
                if len(held):
                    self.buckets[bucket, held[0]] = 0
                    break


def _hashes(keys) -> np.ndarray:
    """The first eight bytes of each key's digest."""
    return np.frombuffer(b"".join(bytes(k)[:8] for k in keys), np.uint64)


def _rebuilt(shard: int, shards: int, version: int, live: np.ndarray) -> pd.DataFrame:
    room = 2 * len(live)
    while not (held := CuckooFilter.sized(room)).insert(live):
        room *= 2
    return pd.DataFrame({"shard": [shard], "shards": [shards], "version": [version], "n_keys": [len(live)], "buckets": [held.dump()]})


class _TaskFilter:
    """What a task has seen of its keys, in filters of growing size. A fingerprint that gets lost costs a row, no more."""

    def __init__(self):
        self.filters, self.room = [CuckooFilter.sized(TASK_KEYS)], TASK_KEYS
        self.told: set[int] = set()

    def new(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes to send on, whether each has come again): a key goes on when it is first seen, and once more when seen again."""
        keys, counts = np.unique(hashes, return_counts=True)
        held = np.zeros(len(keys), bool)
        for f in self.filters:
            held |= f.contains(keys)
        fresh_keys = keys[~held]
        if len(fresh_keys) > self.room:
            size = max(len(fresh_keys), 2 * TASK_KEYS << len(self.filters))
            self.filters.append(CuckooFilter.sized(size))
            self.room = size
        self.filters[-1].insert(fresh_keys)
        self.room -= len(fresh_keys)
        again = held | (counts > 1)
        send = ~held
        for i in np.flatnonzero(again):
            key = int(keys[i])
            if key not in self.told:
                self.told.add(key)
                send[i] = True
        return keys[send], again[send]


def _first_seen(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    seen = _TaskFilter()
    for batch in batches:
        if batch.num_rows:
            keys, again = seen.new(_hashes(batch.column(0).to_pylist()))
            octets = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(_shard_of(keys, shards)), octets, pa.array(again)], names=["shard", "h", "again"])


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    mixed = hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)  # independent of the bits that pick a bucket
    return (mixed % np.uint64(shards)).astype(np.int32)


# ------------------------------------------------------------------ the index
class LineIndex:
    """Reference counts of line keys over a changing set of documents.

    A document that is inserted again counts once; a null id or text holds no
    line. One writer at a time; each batch is appended whole or, if it fails,
    not at all.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int | None = None, min_chars: int = MIN_CHARS,
                 keys_per_shard: int = KEYS_PER_SHARD):
        self.spark, self.path, self.min_chars, self.keys_per_shard = spark, path, min_chars, keys_per_shard
        self.batches = 0  # a batch counts once its filters, written last, are complete
        while files.exists(spark, f"{path}/filters/batch={self.batches}/_SUCCESS"):
            self.batches += 1
        stored = self.filters().agg(F.max("shards")).first()[0] if self.batches else None
        self.shards = stored or shards  # none yet: the first batch's references decide

    # -- tables
    def _read(self, name: str, schema: str, batches: range) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{name}/batch={i}" for i in batches])

    def refs(self) -> DataFrame:
        """The log of references; rows of an insertion have delta 1, of a deletion less than 0."""
        return self._read("refs", REF_SCHEMA, range(self.batches))

    def filters(self) -> DataFrame:
        """One cuckoo filter per shard that has held a key, as of the last batch."""
        return self._read("filters", FILTER_SCHEMA, range(max(0, self.batches - 1), self.batches))

    def maybe_repeated(self) -> DataFrame:
        """(h): the first eight bytes of every key that a filter has held when it came in again."""
        return self._read("met", MET_SCHEMA, range(self.batches)).select(F.explode("met").alias("h")).distinct()

    # -- changes
    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> None:
        """Count the lines of new documents."""
        here = self._log(references(docs, id_col, text_col, self.min_chars).withColumn("delta", F.lit(1)))
        self._size(here)
        shards, version = self.shards, self.batches
        keys = here.select(F.substring("key", 1, 8).alias("h")).mapInArrow(
            lambda b: _first_seen(b, shards), "shard int, h binary, again boolean")

        def meet(key, rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            every = _hashes(rows["h"])
            now, place, counts = np.unique(every, return_inverse=True, return_counts=True)
            again = counts > 1
            again[place[rows["again"].to_numpy(bool)]] = True
            known = CuckooFilter.load(held["buckets"][0]) if len(held) else CuckooFilter.sized(2 * len(now))
            hit = known.contains(now) if len(held) else np.zeros(len(now), bool)
            n = (int(held["n_keys"][0]) if len(held) else 0) + int((~hit).sum())
            done = n <= known.buckets.size * 0.9 and known.insert(now[~hit])
            return pd.DataFrame({"shard": [int(key[0])], "shards": [shards], "version": [version if done else -1], "n_keys": [n],
                                 "buckets": [known.dump()], "met": [_octets(now[hit | again])], "asked": [_octets(now[hit])]})

        met_path = f"{self.path}/met/batch={version}"
        (keys.groupBy("shard").cogroup(self.filters().groupBy("shard")).applyInPandas(meet, MET_SCHEMA)
             .write.mode("overwrite").parquet(met_path))
        met = self.spark.read.schema(MET_SCHEMA).parquet(met_path)
        # A key that the filter seemed to hold, but that has no earlier reference, must enter it too.
        asked = met.select(F.explode("asked").alias("h"))
        absent = self.spark.createDataFrame([], "h binary")
        if self.batches and not asked.isEmpty():
            absent = cut(asked.join(self._live(self._of(self.refs(), asked)).select("h").distinct(), "h", "left_anti"))
        self._write_filters(met.select(*self.filters().columns), absent, F.lit(1))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Forget documents: their references are found in the exact table, by id."""
        gone = only(ids, id_col).toDF("doc").where("doc is not null").distinct()
        held = self._live(self.refs().join(gone, "doc", "left_semi"))
        here = self._log(held.select("key", "doc", (-F.col("held")).cast("int").alias("delta")))
        touched = cut(here.select(F.substring("key", 1, 8).alias("h")).distinct())
        left = self._live(self._of(self.refs().unionByName(here), touched)).select("h").distinct()
        lost = cut(touched.join(left, "h", "left_anti"))
        self.spark.createDataFrame([], MET_SCHEMA).write.mode("overwrite").parquet(f"{self.path}/met/batch={self.batches}")
        self._write_filters(self.filters(), lost, F.lit(-1))

    def _log(self, rows: DataFrame) -> DataFrame:
        here = f"{self.path}/refs/batch={self.batches}"
        rows.select("key", "doc", "delta").write.mode("overwrite").parquet(here)
        return self.spark.read.schema(REF_SCHEMA).parquet(here)

    def _size(self, here: DataFrame) -> None:
        """Shards for the references counted; more, all built anew, once the keys outgrow them."""
        coming = here.count()  # from the files' footers
        if self.shards is None:
            self.shards = max(LEAST_SHARDS, -(-coming // self.keys_per_shard))
        held = (self.filters().agg(F.sum("n_keys")).first()[0] or 0) if self.batches else 0
        if held <= 2 * self.keys_per_shard * self.shards:
            return
        while held > self.keys_per_shard * self.shards:
            self.shards *= 2
        again = f"{self.path}/filters/resharded={self.batches}-{self.shards}"
        self._built(self._live(self.refs()).select("h").distinct(), self.batches - 1).write.mode("overwrite").parquet(again)
        resharded = self.spark.read.schema(FILTER_SCHEMA).parquet(again)
        resharded.write.mode("overwrite").parquet(f"{self.path}/filters/batch={self.batches - 1}")

    def _built(self, live: DataFrame, version: int) -> DataFrame:
        """New filters of the hashes ``live`` (h)."""
        shards = self.shards
        return self._sharded(live).groupBy("shard").applyInPandas(
            lambda key, rows: _rebuilt(int(key[0]), shards, version, _hashes(rows["h"])), FILTER_SCHEMA)

    def _sharded(self, hashes: DataFrame) -> DataFrame:
        shards = self.shards

        def place(batches):
            for batch in batches:
                h = batch.column(0)
                yield pa.RecordBatch.from_arrays([pa.array(_shard_of(_hashes(h.to_pylist()), shards)), h], names=["shard", "h"])

        return hashes.select("h").mapInArrow(place, "shard int, h binary")

    @staticmethod
    def _of(refs: DataFrame, hashes: DataFrame) -> DataFrame:
        """The references whose keys begin with one of ``hashes``."""
        return refs.withColumn("h", F.substring("key", 1, 8)).join(hashes.distinct(), "h", "left_semi").select(*refs.columns)

    @staticmethod
    def _live(refs: DataFrame) -> DataFrame:
        return (refs.groupBy("key", "doc").agg(F.sum("delta").alias("held")).where("held > 0")
                    .select("key", "doc", "held", F.substring("key", 1, 8).alias("h")))

    def _write_filters(self, now: DataFrame, changed: DataFrame, sign: Column) -> None:
        """The batch's filters: ``now`` with the hashes ``changed`` (h) put in or taken out; written last."""
        version, shards = self.batches, self.shards

        def turn(key, rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(held):
                return _rebuilt(int(key[0]), shards, version, np.unique(_hashes(rows["h"][rows["sign"] > 0])))
            known, n = CuckooFilter.load(held["buckets"][0]), int(held["n_keys"][0])
            up, down = _hashes(rows["h"][rows["sign"] > 0]), _hashes(rows["h"][rows["sign"] < 0])
            known.delete(down)
            n += len(up) - len(down)
            done = int(held["version"][0]) >= 0 and n <= known.buckets.size * 0.9 and known.insert(up)
            return pd.DataFrame({"shard": [int(key[0])], "shards": [shards], "version": [version if done else -1], "n_keys": [n], "buckets": [known.dump()]})

        made = f"{self.path}/turned/batch={version}"
        final = f"{self.path}/filters/batch={version}"
        self.batches += 1  # from here on refs() holds this batch too
        try:
            changes = self._sharded(changed).withColumn("sign", sign)
            (changes.groupBy("shard").cogroup(now.groupBy("shard")).applyInPandas(turn, FILTER_SCHEMA)
                    .write.mode("overwrite").parquet(made))
            turned = self.spark.read.schema(FILTER_SCHEMA).parquet(made)
            # A filter that has grown too full is built anew from the exact table, at its new size.
            full = [r["shard"] for r in turned.where("version < 0").select("shard").limit(1).collect()]
            if full:
                outgrown = turned.where("version < 0").select("shard")
                live = self._sharded(self._live(self.refs()).select("h").distinct()).join(outgrown, "shard", "left_semi")
                turned = turned.where("version >= 0").unionByName(self._built(live.select("h"), version))
            turned.write.mode("overwrite").parquet(final)
        except BaseException:
            self.batches -= 1
            raise

    # -- results
    def counts(self) -> DataFrame:
        """(key, n_docs, keeper): the live documents of each key, the largest of them."""
        return self._live(self.refs()).groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))

    def decide(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(doc, key): the references whose lines go: keys of ``min_docs`` documents or more, except in the keeper.

        A key of a single document goes nowhere, so only those that may be
        repeated are counted. Few of them are broadcast; of more, the
        references meet them in a shuffle, as wide as the keys.
        """
        often = cut(self.maybe_repeated())
        refs = self.refs().withColumn("h", F.substring("key", 1, 8))
        few = often.count() <= BROADCAST_ROWS
        live = cut(self._live(refs.join(F.broadcast(often) if few else often, "h", "left_semi")).select("key", "doc"))
        counts = live.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper")).where(F.col("n_docs") >= min_docs)
        counts = cut(counts)
        total = counts.agg(F.sum("n_docs")).first()[0] or 0
        return looked_up(live, counts, "key", "n_docs", total, ["doc"]).where("doc <> keeper").select("doc", "key")


def _octets(hashes: np.ndarray) -> list[bytes]:
    return [h.tobytes() for h in hashes]


def line_index(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = MIN_CHARS) -> LineIndex:
    """A new index, in the shared scratch folder, that holds ``docs``."""
    index = LineIndex(spark, scratch_dir(spark, "line-index"), min_chars=min_chars)
    index.insert(docs, id_col, text_col)
    return index


def dedup_lines(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with ``text_col`` less the decided lines, and columns n_lines and n_dropped.

    Lines that stay are joined by a newline; a document whose lines all go
    has an empty text. A null or empty text is one empty line and becomes an
    empty text. Rows without an id lose nothing. Repeated rows are treated
    alike and all stay. The counters take a free name if theirs is taken.
    """
    n_lines, n_dropped, gone = fresh(docs, "n_lines", "n_dropped", "gone")
    doc = fresh(docs, "doc")[0]
    per_doc = decisions.groupBy("doc").agg(F.collect_set("key").alias(gone)).withColumnRenamed("doc", doc)
    joined = docs.join(per_doc.hint("shuffle_hash"), F.col(f"`{id_col}`") == F.col(doc), "left")
    text = F.col(f"`{text_col}`")
    kept, dropped = fresh(docs, "kept", "dropped")

    def stay(texts: pd.Series, digests: pd.Series) -> pd.DataFrame:
        found = [_kept(t, g, min_chars) for t, g in zip(texts, digests)]
        return pd.DataFrame(found, columns=["text", "n"])

    udf = F.pandas_udf(stay, "text string, n bigint")
    touched = F.when(F.col(gone).isNotNull(), text)
    out = joined.withColumn(kept, udf(touched, F.col(gone)))
    return out.select(
        *[F.coalesce(F.col(f"`{kept}`.text"), text, F.lit("")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        F.size(lines_of(text)).cast("bigint").alias(n_lines), F.coalesce(F.col(f"`{kept}`.n"), F.lit(0)).cast("bigint").alias(n_dropped))


def _kept(text: str | None, gone, min_chars: int) -> tuple[str | None, int | None]:
    import hashlib

    if text is None:
        return None, None
    gone = {bytes(g) for g in gone}
    lines = text.split("\n")
    stay = []
    for line in lines:
        raw = line.encode("utf-8", "surrogatepass").strip(b" \t\n\x0b\x0c\r").lower()
        if len(line) < min_chars or hashlib.sha256(raw).digest() not in gone:
            stay.append(line)
    return "\n".join(stay), len(lines) - len(stay)
