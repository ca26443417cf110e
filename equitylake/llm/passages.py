"""Operator 3, substring dedup by paragraph MinHash banding.

Paragraphs are a text's own: its lines and, where blank lines part it, its
blocks of several lines; a text under ``WORDS`` words is one too. Each has the
set of its 5-word shingles, MinHash signatures of it, and bands of few rows
tuned to make 0.99 of the pairs at a Jaccard similarity of 0.8 meet. Those
that meet are verified by the exact Jaccard similarity of their whole sets,
and links are closed by connected components. Equal paragraphs are one class
and meet once.

A repeated passage need not begin or end where a paragraph does, so passages
repeated word by word are found by anchored windows of ``WORDS`` words: one
starts at the last of the smallest shingle hashes of every stretch of places
at which a window of a ``PASSAGE`` can start. The choice depends on the words
of the stretch alone, so any ``PASSAGE`` words that two documents share hold
a window that both have, said once or again and again. A window that
documents share is extended word by word, against the text that stays, to
where the two part.

In each class that spans documents the smallest document keeps its text, and
the spans of all others are removals, merged where they touch.
"""

from __future__ import annotations

import gc
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from equitylake.llm.common import components, cut, hot_blocks, only, whole_groups
from equitylake.session import scratch_dir

SHINGLE = 5
WORDS = 22  # of a window
PASSAGE = 50  # shared passages from so many words on hold a shared window
STRETCH = PASSAGE - WORDS + 1  # places of a window in a passage; anchors lie no farther apart
REST = STRETCH - 1  # words of a passage on either side of a window, at most
#: 1 - (1 - 0.8^2)^5 = 0.994 of the pairs of similarity 0.8 meet.
BANDS, ROWS = 5, 2
SIMILARITY = 0.8
BLOCK_ROWS = 1024
SEGMENT_BYTES = 1 << 22
SEED = 3

_rng = np.random.default_rng(SEED)
_ODD = _rng.integers(0, 2**63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = _ODD[0]
_UNDO = np.uint64(pow(int(_BASE), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * _ODD[1]
    x = (x ^ (x >> np.uint64(29))) * _ODD[2]
    return x ^ (x >> np.uint64(32))


def _word_hashes(octets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word octets[start:end], by differences of polynomial prefix sums, a few MB at a time."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + SEGMENT_BYTES, "right")))
        part = octets[starts[at]:ends[upto - 1]]
        power, undo = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(len(part), b, np.uint64)))) for b in (_BASE, _UNDO))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[:-1])))
        a, b = starts[at:upto] - starts[at], ends[at:upto] - starts[at]
        # Powers of the base's inverse take a word's sum back to what it would be at the part's start.
        out[at:upto] = _mix((total[b] - total[a]) * undo[a] + (b - a).astype(np.uint64))
        at = upto
    return out


class Words(NamedTuple):
    """The words of a batch of texts, one after the other."""

    row: np.ndarray  # text of each word
    first: np.ndarray  # first word of each text
    counts: np.ndarray  # words of each text
    hashes: np.ndarray
    shingles: np.ndarray  # hash of the five words from each word on; nothing of use at a text's last four
    breaks: np.ndarray  # line feeds between the word and the one before


def read(texts: pa.Array) -> Words:
    """The words of a binary array."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    octets = _LOWER[np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]] if data is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    word = ~_SPACE[octets]
    edge = np.zeros(len(octets) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(word & (~np.concatenate(([False], word))[:-1] | edge[:-1]))
    ends = np.flatnonzero(word & (~np.concatenate((word, [False]))[1:] | edge[1:])) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    hashes = _word_hashes(octets, starts, ends)
    first = np.searchsorted(row, np.arange(len(texts)))
    counts = np.diff(np.append(first, len(row)))
    shingles = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= SHINGLE:
        shingles[:len(hashes) - SHINGLE + 1] = _mix(sum(hashes[j:len(hashes) - SHINGLE + 1 + j] * _ODD[8 + j] for j in range(SHINGLE)))
    breaks = np.diff(np.searchsorted(np.flatnonzero(octets == 10), starts), prepend=0)
    return Words(row, first, counts, hashes, shingles, breaks)


def _anchors(w: Words) -> np.ndarray:
    """Where in ``w`` a window starts: the last smallest shingle hash of every STRETCH places of a text at which one can, or of all, if fewer."""
    place = np.arange(len(w.row)) - w.first[w.row]
    places = w.counts[w.row] - WORDS + 1
    can = place < places
    # Texts are set apart by STRETCH places that hold no smaller value than any shingle.
    spot = np.arange(len(w.row)) + w.row * STRETCH
    value = np.full(len(w.row) + len(w.counts) * STRETCH + 1, 2**64 - 1, np.uint64)
    value[spot[can]] = _mix(w.shingles[can] + _ODD[3])
    best, reach = np.arange(len(value)), 1
    while reach < STRETCH:  # of the places from each one on: 2, 4, 8, 16, all
        step = min(reach, STRETCH - reach)
        later = best[step:]
        best = np.append(np.where(value[later] <= value[best[:-step]], later, best[:-step]), best[-step:])
        reach += step
    begins = can & ((place == 0) | (place + STRETCH <= places))
    chosen = np.zeros(len(value), bool)
    chosen[best[spot[begins]]] = True
    return np.flatnonzero(chosen[spot] & can)


def paragraphs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a binary array: each anchored window's row, first word, and shingle hashes [window, WORDS - SHINGLE + 1]."""
    w = read(texts)
    at = _anchors(w)
    return w.row[at], at - w.first[w.row[at]], _window_shingles(w, at)


def _window_shingles(w: Words, at: np.ndarray) -> np.ndarray:
    return w.shingles[at[:, None] + np.arange(WORDS - SHINGLE + 1)]


def natural(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``w`` the texts' own paragraphs start, and their words (at least SHINGLE)."""
    n = len(w.row)
    top = np.arange(n) == w.first[w.row]
    line = np.flatnonzero(top | (w.breaks > 0))
    block = np.flatnonzero(top | (w.breaks > 1))
    line_words, block_words = np.diff(np.append(line, n)), np.diff(np.append(block, n))
    several = block_words > line_words[np.searchsorted(line, block)]
    parted = block_words < w.counts[w.row[block]]
    short = w.counts[w.row[block]] < WORDS  # a block that is all of a short text
    use = several & (parted | short)
    whole = np.flatnonzero((w.counts < WORDS) & (np.bincount(w.row[block], minlength=len(w.counts)) > 1))
    at = np.concatenate((line, block[use], w.first[whole]))
    words = np.concatenate((line_words, block_words[use], w.counts[whole]))
    return at[words >= SHINGLE], words[words >= SHINGLE]


def _over(ufunc, values: np.ndarray, at: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``ufunc`` over the shingles' ``values`` of each paragraph."""
    edges = np.stack((at, at + words - SHINGLE + 1), axis=1).ravel()
    return ufunc.reduceat(np.append(values, values[-1:]), edges)[::2] if len(at) else np.empty(0, np.uint64)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def content_of(shingles: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each window's words, in order."""
    return _signed(_mix((shingles * _ODD[16:16 + shingles.shape[1]]).sum(1, dtype=np.uint64)))


def bag_of(w: Words, at: np.ndarray, words: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each paragraph's shingles, in any order."""
    return _signed(_mix(_over(np.add, _mix(w.shingles + _ODD[5]), at, words) + words.astype(np.uint64) * _ODD[6]))


def bands_of(w: Words, at: np.ndarray, words: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys [paragraph, band] of the MinHash signatures."""
    keys = np.empty((len(at), bands), np.int64)
    for band in range(bands):
        key = np.full(len(at), band + 1, np.uint64)
        for r in range(rows):
            salt = _ODD[32 + (band * rows + r) % 32] * np.uint64(1 + (band * rows + r) // 32)
            key = _mix(key + _over(np.minimum, _mix((w.shingles ^ salt) * _ODD[4]), at, words))
        keys[:, band] = _signed(key)
    return keys


def _units(batches):
    for batch in batches:
        w = read(batch.column(1))
        windows = _anchors(w)
        at, words = natural(w)
        both = np.concatenate((windows, at))
        if len(both):
            row = w.row[both]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(both - w.first[row], pa.int64()),
                 pa.array(np.concatenate((np.full(len(windows), WORDS), words)), pa.int64()), pa.array(np.arange(len(both)) < len(windows)),
                 pa.array(np.concatenate((content_of(_window_shingles(w, windows)), bag_of(w, at, words))))],
                names=["doc", "first", "words", "exact", "content"])


def _band_rows(batches, bands: int, rows: int, gather: int = 100_000):
    """(key, content), the repeats of a task's stretch left out: a paragraph found everywhere is sent on once a stretch."""
    def out(held):
        content, at = np.unique(np.concatenate([c for c, _ in held]), return_index=True)
        keys = np.concatenate([k for _, k in held])[at]
        return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(content, bands))], names=["key", "content"])

    held, n = [], 0
    for batch in batches:
        w = read(batch.column(0))
        at, words = natural(w)
        held.append((bag_of(w, at, words), bands_of(w, at, words, bands, rows)))
        n += len(at)
        if n >= gather:
            yield out(held)
            held, n = [], 0
    if n:
        yield out(held)


def _met(batches):
    """The rows (key, content) of keys with more than one content, once each; rows come sorted by both.

    The new key is a hash of the contents that met: those that meet in several bands are compared once.
    """
    for part, starts in whole_groups(batches, 1):
        key, content = part.column(0).to_numpy(), part.column(1).to_numpy()
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (content[1:] != content[:-1])))
        group = np.cumsum(np.isin(np.arange(len(key)), starts)) - 1
        kinds = np.bincount(group[new], minlength=len(starts))
        name = _signed(_mix(np.add.reduceat(np.where(new, _mix(content.view(np.uint64) + _ODD[7]), np.uint64(0)), starts)))
        keep = new & (kinds[group] > 1)
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(name[group[keep]]), pa.array(content[keep])], names=["key", "content"])


_LOOKED = "content bigint, keeper bigint, doc bigint, shingles array<bigint>, places array<bigint>, which array<int>, around binary"


def _look(batches):
    """What is asked of each text's units: a paragraph's shingle set; or of windows of one content their places and the words around.

    ``around`` holds, for each different surroundings, 2 x REST hashes of 32 bits: of the words before, going backwards, and of those after;
    0 is none. ``which`` says whose surroundings a place has.
    """
    for batch in batches:
        w = read(batch.column(1))
        asked = batch.column(2)
        row = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
        place, words, exact, content, keeper = (asked.flatten().field(i) for i in range(5))
        place, words, content = place.to_numpy(), words.to_numpy(), content.to_numpy()
        exact, keeper = exact.to_numpy(zero_copy_only=False), keeper.to_numpy()
        at = w.first[row] + place
        fits = place + words <= w.counts[row]  # rows that repeat an id may have other texts
        one, many = np.flatnonzero(fits & ~exact), np.flatnonzero(fits & exact)
        one = one[bag_of(w, at[one], words[one]) == content[one]]
        many = many[content_of(_window_shingles(w, at[many])) == content[many]]
        docs = batch.column(0)
        if len(one):
            size = words[one] - SHINGLE + 1
            unit = np.repeat(np.arange(len(one)), size)
            values = _signed(w.shingles[at[one][unit] + np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)])
            order = np.lexsort((values, unit))
            unit, values = unit[order], values[order]
            new = np.concatenate(([True], (unit[1:] != unit[:-1]) | (values[1:] != values[:-1])))
            sets = pa.ListArray.from_arrays(_bounds(np.bincount(unit[new], minlength=len(one))), values[new])
            yield _looked(content[one], keeper[one], docs.take(pa.array(row[one])), shingles=sets)
        if len(many):
            j = np.arange(REST)
            before, after = at[many, None] - 1 - j, at[many, None] + WORDS + j
            low = w.first[row[many]][:, None]
            high = low + w.counts[row[many]][:, None]
            short = (w.hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            around = np.concatenate((np.where(before >= low, short[np.maximum(before, 0)], 0),
                                     np.where(after < high, short[np.minimum(after, len(short) - 1)], 0)), axis=1).astype(np.uint32)
            kind = _mix((around * _ODD[np.arange(2 * REST) % 64] + np.arange(2 * REST, dtype=np.uint64)).sum(1, dtype=np.uint64))
            order = np.lexsort((place[many], kind, content[many], row[many]))
            many, around, kind = many[order], around[order], kind[order]
            group = np.concatenate(([True], (row[many][1:] != row[many][:-1]) | (content[many][1:] != content[many][:-1])))
            new = group | np.concatenate(([True], kind[1:] != kind[:-1]))
            of = np.cumsum(group) - 1
            number = np.cumsum(new) - 1
            head = np.flatnonzero(group)
            n = _bounds(np.bincount(of))
            blob = pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(_bounds(np.bincount(of[new]) * 8 * REST)),
                                                                  pa.py_buffer(np.ascontiguousarray(around[new]))])
            yield _looked(content[many[head]], keeper[many[head]], docs.take(pa.array(row[many[head]])),
                          places=pa.ListArray.from_arrays(n, place[many]),
                          which=pa.ListArray.from_arrays(n, (number - number[head][of]).astype(np.int32)), around=blob)


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)


def _looked(content, keeper, doc, shingles=None, places=None, which=None, around=None) -> pa.RecordBatch:
    given = [(shingles, pa.list_(pa.int64())), (places, pa.list_(pa.int64())), (which, pa.list_(pa.int32())), (around, pa.binary())]
    return pa.RecordBatch.from_arrays(
        [pa.array(content), pa.array(keeper), doc, *[pa.nulls(len(content), kind) if x is None else x for x, kind in given]],
        names=["content", "keeper", "doc", "shingles", "places", "which", "around"])


def _around(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All surroundings [n, 2 x REST] of a column of ``_look``'s, and where each row's begin."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return np.frombuffer(data.tobytes(), np.uint32).reshape(-1, 2 * REST), (offsets - offsets[0]) // (8 * REST)


def _extend(batches, pairs: int = 20_000):
    """(doc, keeper, component, first, end) of each place, from (content, keeper, doc, places, which, around, the keeper's around)."""
    for batch in batches:
        mine, m = _around(batch.column(5))
        theirs, t = _around(batch.column(6))
        far = np.zeros((len(mine), 2), np.int64)
        kinds = np.repeat(np.diff(t), np.diff(m))  # of the keeper's surroundings, for each of mine
        begin = np.repeat(t[:-1], np.diff(m))
        s = 0
        while s < len(mine):
            e = max(s + 1, int(np.searchsorted(np.cumsum(kinds[s:]), pairs, "right")) + s)
            i = np.repeat(np.arange(s, e), kinds[s:e])
            j = np.arange(len(i)) - np.repeat(np.cumsum(kinds[s:e]) - kinds[s:e], kinds[s:e]) + begin[i]
            same = ((mine[i] == theirs[j]) & (mine[i] != 0)).reshape(len(i), 2, REST)
            np.maximum.at(far, i, np.logical_and.accumulate(same, axis=2).sum(2))
            s = e
        lists = batch.column(3)
        row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        place, which = lists.flatten().to_numpy(), batch.column(4).flatten().to_numpy()
        mine_of = m[row] + which
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [batch.column(2).take(take), batch.column(1).take(take), batch.column(0).take(take),
             pa.array(place - far[mine_of, 0]), pa.array(place + WORDS + far[mine_of, 1])],
            names=["doc", "keeper", "component", "first", "end"])


def _similar(batches, least: float):
    """Spanning links (a, b) of the paragraphs of each bucket's block pair whose Jaccard similarity is ``least`` or more."""
    for part, starts in whole_groups(batches, 3):
        lo, hi, blk, content = (part.column(i).to_numpy() for i in (1, 2, 3, 4))
        lists = part.column(5).combine_chunks()
        lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
        flat, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        bound = np.concatenate(([0], np.cumsum(sizes)))
        out_a, out_b = [], []
        for s, e in zip(starts.tolist(), np.append(starts[1:], part.num_rows).tolist()):
            kinds, ids = np.unique(flat[bound[s]:bound[e]], return_inverse=True)
            at = bound[s:e + 1] - bound[s]
            split = e if lo[s] == hi[s] else s + int(np.searchsorted(blk[s:e], hi[s]))  # rows come sorted by block
            for i in range(s, split):
                right = i + 1 if lo[s] == hi[s] else split
                if right < e:
                    alike = _alike(ids[at[i - s]:at[i - s + 1]], ids[at[right - s]:], at[right - s:-1] - at[right - s], len(kinds))
                    near = right + np.flatnonzero(alike >= least)
                    out_a.append(np.full(len(near), content[i]))
                    out_b.append(content[near])
        if out_a:
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
            a, b = at[:len(a)], at[len(a):]
            low = np.arange(len(ids))
            while len(ids):  # the smallest content each one reaches in this stretch
                new = low.copy()
                np.minimum.at(new, a, np.minimum(low[a], low[b]))
                np.minimum.at(new, b, np.minimum(low[a], low[b]))
                new = new[new]
                if (new == low).all():
                    break
                low = new
            if len(ids):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[low])], names=["a", "b"])


def _alike(one: np.ndarray, others: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The exact Jaccard similarity of a set of numbers under ``n`` and each of the sets laid end to end in ``others``."""
    mark = np.zeros(n, np.int64)
    mark[one] = 1
    shared = np.add.reduceat(mark[others], starts)
    return shared / (len(one) + np.diff(np.append(starts, len(others))) - shared)


def jaccard(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The exact Jaccard similarity of a set of shingles (an array, repeats allowed) and each row's."""
    kinds, ids = np.unique(np.concatenate((one, others.ravel())), return_inverse=True)
    sets = [np.unique(x) for x in ids[len(one):].reshape(others.shape)]
    return _alike(np.unique(ids[:len(one)]), np.concatenate(sets), _bounds([len(x) for x in sets])[:-1], len(kinds))


def _let_go(spark) -> None:
    """Spark's cleaner takes the shuffle files of frames that are gone when the driver collects its garbage: let it, before more are written."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def repeated(docs: DataFrame, least: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text",
             bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, first_word, end_word, component, keeper): the spans of words to remove.

    ``keeper`` is the document that keeps the text, the smallest id of the
    class; the class is named by the hash of a paragraph or a window. Spans of
    a document that touch and have one keeper are merged, under the smallest
    class; spans of different keepers may overlap. Text repeated within one
    document only is left alone. Null and empty texts, those under five words,
    and rows with a null id hold no paragraph. Rows that repeat an id are one
    document. An empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = only(docs, id_col, text_col).toDF("doc", "text").where("doc is not null and text is not null")
    texts = texts.select(F.col("doc").cast("bigint").alias("doc"), F.col("text").cast("binary").alias("text"))
    path = scratch_dir(spark, "paragraphs")
    texts.mapInArrow(_units, "doc bigint, first bigint, words bigint, exact boolean, content bigint").write.parquet(path)
    units = spark.read.parquet(path)

    # The bands are made from the texts again: that costs less than keeping them.
    keyed = texts.select("text").mapInArrow(partial(_band_rows, bands=bands, rows=rows), "key bigint, content bigint")
    met = cut(keyed.repartition("key").sortWithinPartitions("key", "content").mapInArrow(_met, "key bigint, content bigint").distinct())
    # A place of each paragraph that documents share or that met another is where its shingles can be read.
    asked = met.select("content").distinct().withColumn("asked", F.lit(True))
    classes = units.where("not exact").groupBy("content").agg(F.min(F.struct("doc", "first", "words")).alias("at"), F.max("doc").alias("hi"))
    classes = cut(classes.join(asked.hint("shuffle_hash"), "content", "left").where("asked or at.doc <> hi"))
    shared = cut(units.where("exact").groupBy("content").agg(F.min("doc").alias("keeper"), F.max("doc").alias("hi"))
                      .where("keeper <> hi").select("content", "keeper"))
    wanted = (units.where("exact").join(shared, "content").select("doc", "first", "words", "exact", "content", "keeper").unionByName(
        classes.where("asked").select("at.*", F.lit(False).alias("exact"), "content", F.col("at.doc").alias("keeper"))))
    per_doc = wanted.groupBy("doc").agg(F.collect_list(F.struct("first", "words", "exact", "content", "keeper")).alias("asked"))
    _let_go(spark)
    path = scratch_dir(spark, "passages")
    texts.join(per_doc.hint("shuffle_hash"), "doc").select("doc", "text", "asked").mapInArrow(_look, _LOOKED).write.parquet(path)
    looked = spark.read.parquet(path)
    _let_go(spark)

    sets = looked.where("shingles is not null").select("content", "shingles").dropDuplicates(["content"])
    dealt = hot_blocks(met, ["key"], "content", BLOCK_ROWS).join(sets, "content")
    ordered = (dealt.select("key", "lo", "hi", "blk", "content", "shingles").repartition("key", "lo", "hi")
                    .sortWithinPartitions("key", "lo", "hi", "blk"))
    linked = cut(components(ordered.mapInArrow(partial(_similar, least=least), "a bigint, b bigint")))

    equal = classes.where("at.doc <> hi").select("content")
    groups = (equal.join(linked.withColumnRenamed("node", "content"), "content", "full")
                   .select("content", F.coalesce("component", "content").alias("component")))
    placed = cut(units.where("not exact").join(groups, "content").select("component", "doc", "first", "words"))
    spread = (placed.groupBy("component").agg(F.min("doc").alias("keeper"), F.max("doc").alias("hi"))
                    .where("keeper <> hi").select("component", "keeper"))
    own = placed.join(spread, "component").where("doc <> keeper").select(
        "doc", "keeper", "component", "first", (F.col("first") + F.col("words")).alias("end"))

    windows = looked.where("around is not null")
    kept = windows.where("doc = keeper").select("content", F.col("around").alias("kept"))
    passages = (windows.where("doc <> keeper").join(kept, "content")
                       .select("content", "keeper", "doc", "places", "which", "around", "kept")
                       .mapInArrow(_extend, "doc bigint, keeper bigint, component bigint, first bigint, end bigint"))
    order = W.partitionBy("doc", "keeper").orderBy("first", "component")
    runs = (own.unionByName(passages)
               .withColumn("new", F.coalesce(F.col("first") > F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(True)).cast("int"))
               .withColumn("run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))))
    return (runs.groupBy("doc", "keeper", "run").agg(F.min("first").alias("first_word"), F.max("end").alias("end_word"),
                                                     F.min("component").alias("component"))
                .select(F.col("doc").alias(id_col), "first_word", "end_word", "component", "keeper"))


def remove(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the words of ``spans`` (as ``repeated`` returns them) and the white space after each taken out of the text."""
    gathered = spans.groupBy(F.col(f"`{id_col}`").alias("gone_id")).agg(F.collect_list(F.struct("first_word", "end_word")).alias("gone_spans"))
    joined = docs.join(gathered, F.col(f"`{id_col}`") == F.col("gone_id"), "left")

    def shorten(texts: pd.Series, gone: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or g is None else _without(t, g) for t, g in zip(texts, gone)], dtype=object)

    udf = F.pandas_udf(shorten, "string")
    touched = F.col("gone_spans").isNotNull()
    new = udf(F.when(touched, F.col(f"`{text_col}`")), F.col("gone_spans"))
    return joined.withColumn("gone_text", new).select(
        *[F.coalesce("gone_text", F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def _without(text: str, gone) -> str:
    octets = np.frombuffer(text.encode("utf-8"), np.uint8)
    word = np.concatenate(([False], ~_SPACE[octets]))
    starts = np.append(np.flatnonzero(word[1:] & ~word[:-1]), len(octets))
    keep = np.ones(len(octets), bool)
    for span in gone:
        keep[starts[span["first_word"]]:starts[min(span["end_word"], len(starts) - 1)]] = False
    return octets[keep].tobytes().decode("utf-8")
