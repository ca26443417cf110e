"""Operator 5, quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered
thresholds cut its score: P(grade <= k) = sigmoid(threshold_k - w.x). A
document gets its expected grade and its tail probability P(grade >= g), by
which documents are selected.

Features are the words a text holds and their beginnings (which inflected
forms of a word share), by presence, so a telling word weighs the same in a
long text as in a short one; and the shares of word shapes, repeats and sizes.
Only features whose training documents differ in grade by more than chance
enter the model: most words tell nothing, and would be learnt by heart.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitylake.llm.common import fresh, lots, only

HASH_BITS = 18
#: Bound of the labelled rows a model is fitted on: those of smallest id hash.
MAX_TRAIN = 12_000
#: A feature enters the model if its correlation with some grade split is so many standard errors from none.
LEAST_SIGNAL = 4.0
#: Texts are scored in lots of so many bytes; a longer text alone.
LOT_BYTES = 2 << 20
SCORE_TYPE = "expected double, tail double"
_WORD_EDGE = re.compile(r"^\W+|\W+$")


def _number(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % (1 << HASH_BITS)


_EMPTY, _AGAIN, _DISTINCT = map(_number, ("empty", "word repeated at once", "distinct words"))


def _shape(word: str) -> str:
    """Case and trailing marks of a word: what tells markup, shouting and symbol noise from prose."""
    core = _WORD_EDGE.sub("", word)
    case = "none" if not core else "upper" if core.isupper() and len(core) > 1 else "digit" if core.isdigit() else "word"
    return f"{case} {word[len(word.rstrip('!?.,;:%$#&*|')):][:3]}"


class _Words:
    """Feature numbers of words, remembered up to a bound (then forgotten and begun anew).

    ``active`` (a flag per feature) leaves out the numbers a model does not use.
    """

    def __init__(self, active: np.ndarray | None = None, bound: int = 200_000):
        self.active, self.bound, self.known = active, bound, {}

    def __getitem__(self, word: str) -> tuple[tuple[int, ...], int]:
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= self.bound:
                self.known.clear()
            low = _WORD_EDGE.sub("", word).lower()
            held = {_number(f"w {low}"), _number(f"4 {low[:4]}"), _number(f"5 {low[:5]}")}
            if self.active is not None:
                held = {i for i in held if self.active[i]}
            got = self.known[word] = tuple(held), _number(f"s {_shape(word)}")
        return got


def features(text: str, words: _Words) -> tuple[set[int], dict[int, float]]:
    """Features a text holds, and those with a value. A text of no words has one feature, its emptiness."""
    tokens = text.split()
    n = len(tokens)
    if not n:
        return {_EMPTY}, {}
    held: set[int] = set()
    counts: Counter = Counter()
    distinct = Counter(tokens)
    for word, c in distinct.items():
        own, shape = words[word]
        held.update(own)
        counts[shape] += c
    counts[_AGAIN] += sum(x == y for x, y in zip(tokens, tokens[1:]))
    counts[_DISTINCT] += len(distinct)
    counts[_number(f"size {min(12, n.bit_length())}")] += n
    return held, {i: math.sqrt(c / n) for i, c in counts.items()}


def _vectors(batches):
    words = _Words()
    for batch in batches:
        found = [features(t or "", words) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([sorted(h) for h, _ in found], pa.list_(pa.int32())), pa.array([list(v) for _, v in found], pa.list_(pa.int32())),
             pa.array([list(v.values()) for _, v in found], pa.list_(pa.float64()))], names=["grade", "held", "valued", "value"])


@dataclass(frozen=True)
class OrdinalModel:
    """weights (one per hashed feature) and increasing thresholds between the grades 0..len(thresholds)."""

    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade = 0), P(grade = 1), ... for each score."""
        upto = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - np.asarray(scores)[:, None], -30, 30)))
        return np.diff(upto, axis=1, prepend=0.0, append=1.0)

    def expected(self, scores: np.ndarray) -> np.ndarray:
        p = self.probabilities(scores)
        return p @ np.arange(p.shape[1])

    def tail(self, scores: np.ndarray, grade: int) -> np.ndarray:
        """P(grade >= ``grade``)."""
        return self.probabilities(scores)[:, grade:].sum(axis=1)


def _descend(slope_of, x: np.ndarray, rounds: int, memory: int = 10) -> np.ndarray:
    """Minimise a smooth function, given as x -> (value, slope), by limited-memory BFGS with step halving."""
    f, g = slope_of(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        d, parts = -g, []
        for s, y in reversed(steps):
            parts.append((s @ d) / (s @ y))
            d = d - parts[-1] * y
        d = d * ((steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1])) if steps else d / max(1.0, np.linalg.norm(g))
        for (s, y), part in zip(steps, reversed(parts)):
            d = d + s * (part - (y @ d) / (s @ y))
        size = 1.0
        while True:
            new_f, new_g = slope_of(x + size * d)
            if new_f <= f + 1e-4 * size * (g @ d) or size < 1e-8:
                break
            size /= 2
        s, y = size * d, new_g - g
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        settled = f - new_f < 1e-7 * max(1.0, abs(f))
        x, f, g = x + s, new_f, new_g
        if settled:
            break
    return x


def signal(grades: np.ndarray, index: np.ndarray, value: np.ndarray, row: np.ndarray, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each feature: standard errors of its strongest correlation with a grade split, and its standard deviation."""
    n, size = len(grades), 1 << HASH_BITS
    mean = np.bincount(index, value, size) / n
    spread = np.sqrt(np.maximum(np.bincount(index, value * value, size) / n - mean**2, 1e-12))
    best = np.zeros(size)
    for k in range(1, n_grades):
        above = (grades >= k) - (grades >= k).mean()
        if above.any():
            shared = np.bincount(index, value * above[row], size) / n
            best = np.maximum(best, np.abs(shared) / spread / above.std() * math.sqrt(n))
    return best, spread


def fit_ordinal(grades: np.ndarray, index: np.ndarray, value: np.ndarray, row: np.ndarray, n_grades: int,
                rounds: int = 150, ridge: float = 1e-3, least_signal: float = LEAST_SIGNAL) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty.

    ``row``, ``index``, ``value`` are the non-zero entries of the feature
    matrix; features are scaled to unit spread, weak ones shrunk. Thresholds
    start at the grades' smoothed shares and stay ordered, as what is fitted
    is the logarithm of their gaps.
    """
    strength, spread = signal(grades, index, value, row, n_grades)
    scale = np.where(strength >= least_signal, np.minimum(1.0, strength / 20) / spread, 0.0)
    used = scale[index] > 0
    index, row, value = index[used], row[used], (value * scale[index])[used]
    columns, slot = np.unique(index, return_inverse=True)
    n, m, at = len(grades), len(columns), np.arange(len(grades))
    shares = np.cumsum(np.bincount(grades, minlength=n_grades) + 1.0)[:-1] / (n + n_grades)
    start = np.log(shares / (1 - shares))

    def thresholds(free: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))

    def slope_of(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, free = x[:m], x[m:]
        scores = np.bincount(row, value * w[slot], minlength=n)
        upto = 1 / (1 + np.exp(-np.clip(thresholds(free)[None, :] - scores[:, None], -35, 35)))
        upto = np.hstack((np.zeros((n, 1)), upto, np.ones((n, 1))))
        dense = upto * (1 - upto)
        p = np.maximum(upto[at, grades + 1] - upto[at, grades], 1e-12)
        by_score = (dense[at, grades + 1] - dense[at, grades]) / p / n
        by_cut = (np.bincount(grades, dense[at, grades] / p / n, n_grades + 1)
                  - np.bincount(grades + 1, dense[at, grades + 1] / p / n, n_grades + 1))[1:-1]
        onward = np.cumsum(by_cut[::-1])[::-1]  # a gap moves all thresholds after it
        by_free = np.concatenate((onward[:1], onward[1:] * np.exp(free[1:])))
        return (-np.log(p).mean() + ridge / 2 * (w @ w),
                np.concatenate((np.bincount(slot, value * by_score[row], m) + ridge * w, by_free)))

    first = np.concatenate((np.zeros(m), start[:1], np.log(np.maximum(np.diff(start), 1e-3))))
    x = _descend(slope_of, first, rounds)
    weights = np.zeros(1 << HASH_BITS)
    weights[columns] = x[:m] * scale[columns]
    return OrdinalModel(weights, thresholds(x[m:]))


def _fit_task(rows: pd.DataFrame, n_grades: int) -> pd.DataFrame:
    def entries(index: str) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(list(rows[index])).astype(np.int64), np.repeat(np.arange(len(rows)), rows[index].map(len).to_numpy())

    (held, held_row), (valued, valued_row) = entries("held"), entries("valued")
    model = fit_ordinal(rows["grade"].to_numpy(np.int64), np.concatenate((held, valued)),
                        np.concatenate((np.ones(len(held)), np.concatenate(list(rows["value"])))), np.concatenate((held_row, valued_row)), n_grades)
    return pd.DataFrame({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tolist()]})


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int, id_col: str = "doc_id", text_col: str = "text",
        grade_col: str = "grade", max_train: int = MAX_TRAIN) -> OrdinalModel | None:
    """A model of ``ratings`` (id, grade 0..n_grades-1), or None if no document is rated.

    Fitted on at most ``max_train`` rated ids, those of smallest hash, in one
    task of that bounded size. Ratings with a null or out-of-range grade or a
    null id are left out; an id rated more than once counts with its lowest
    grade; a null text counts as empty. Of documents that share an id one is
    fitted, that of smallest text hash.
    """
    rated = only(ratings, id_col, grade_col).toDF("id", "grade").where(f"grade between 0 and {n_grades - 1} and id is not null")
    sample = rated.groupBy("id").agg(F.min("grade").cast("int").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(max_train)
    # Of max_train rows at most: a size that does not grow with the data.
    rows = only(docs, id_col, text_col).toDF("id", "text").join(F.broadcast(sample), "id")
    rows = rows.groupBy("id", "grade").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("grade", "text")
    vectors = rows.mapInArrow(_vectors, "grade int, held array<int>, valued array<int>, value array<double>")
    model = (vectors.withColumn("all", F.lit(1)).groupBy("all")
                    .applyInPandas(lambda pdf: _fit_task(pdf, n_grades), "weights binary, thresholds array<double>").collect())
    if not model:
        return None
    return OrdinalModel(np.frombuffer(model[0]["weights"], np.float64), np.array(model[0]["thresholds"]))


def batch_scores(texts: pa.Array, words: _Words, weights: np.ndarray) -> np.ndarray:
    """w.x of each text by the features of ``features``; texts go in lots of bounded size, however many rows a batch has."""
    return np.concatenate([_lot_scores(texts.slice(a, b - a), words, weights) for a, b in lots(texts, LOT_BYTES)] or [np.empty(0)])


def _lot_scores(texts: pa.Array, words: _Words, weights: np.ndarray) -> np.ndarray:
    """A word is looked up once, and what texts hold is counted in arrays. Sums go by feature number, so the order of the words has no say."""
    rows, size = len(texts), 1 << HASH_BITS
    parts = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    tokens = parts.flatten()
    doc = np.repeat(np.arange(rows), np.diff(parts.offsets.to_numpy()))
    real = pc.not_equal(tokens, "").to_numpy(zero_copy_only=False)  # ends of a text that are white space leave empty parts
    coded = tokens.dictionary_encode()
    place, doc = coded.indices.to_numpy()[real], doc[real]
    known = [words[w] for w in coded.dictionary.to_numpy(zero_copy_only=False).tolist()]
    shape = np.array([s for _, s in known], np.int64)
    width = np.array([len(h) for h, _ in known], np.int64)
    held = np.array([i for h, _ in known for i in h], np.int64)
    first = np.cumsum(width) - width

    n = np.bincount(doc, minlength=rows)
    pairs, counts = np.unique(doc * max(1, len(known)) + place, return_counts=True)
    of, word = np.divmod(pairs, max(1, len(known)))
    # Presence: the distinct features of a text's distinct words.
    wide = width[word]
    at = np.repeat(first[word] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
    own, feature = np.divmod(np.unique(np.repeat(of, wide) * size + held[at]), size)
    total = np.bincount(own, weights[feature], rows).astype(np.float64)  # of no entry at all bincount makes integers
    # Shares: word shapes, repeats at once, distinct words, the size itself.
    again = np.bincount(doc[1:][(place[1:] == place[:-1]) & (doc[1:] == doc[:-1])], minlength=rows)
    some = np.flatnonzero(n)
    sizes = {int(x): _number(f"size {min(12, int(x).bit_length())}") for x in np.unique(n[some])}
    keys = np.concatenate((of * size + shape[word], some * size + _AGAIN, some * size + _DISTINCT,
                           some * size + np.array([sizes[int(x)] for x in n[some]], np.int64)))
    amounts = np.concatenate((counts, again[some], np.bincount(of, minlength=rows)[some], n[some]))
    kinds, slot = np.unique(keys, return_inverse=True)
    own, feature = np.divmod(kinds, size)
    total += np.bincount(own, weights[feature] * np.sqrt(np.bincount(slot, amounts, len(kinds)) / n[own]), rows)
    return np.where(n > 0, total, weights[_EMPTY])


def scorer(docs: DataFrame, model: OrdinalModel, grade: int, text_col: str = "text") -> Column:
    """A struct column (expected grade, tail probability of ``grade`` or more) of each row's whole text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    words = None

    def score(texts: pa.Array) -> pa.Array:
        nonlocal words
        found = held.value
        words = words or _Words(found.weights != 0)
        raw = batch_scores(texts, words, found.weights)
        return pa.StructArray.from_arrays([pa.array(found.expected(raw)), pa.array(found.tail(raw, grade))], ["expected", "tail"])

    score.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(score, SCORE_TYPE)(F.col(f"`{text_col}`"))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of ``labels``: 0 poor, 1 good but toxic, 2 good; null marks give no grade."""
    return labels.select("doc_id", F.expr("case when quality = 0 then 0 when quality = 1 then 2 - toxic end").alias("grade"))


def scores(docs: DataFrame, model: OrdinalModel | None, grade: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, expected_grade, tail) per row of ``docs``; both null without a model. Null text: scored as empty."""
    rows = only(docs, id_col, text_col)
    if model is None:
        return rows.select(id_col, F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail"))
    found = fresh(rows, "found")[0]
    return (rows.withColumn(found, scorer(rows, model, grade, text_col))
                .select(id_col, F.col(f"{found}.expected").alias("expected_grade"), F.col(f"{found}.tail").alias("tail")))


def select(docs: DataFrame, model: OrdinalModel | None, grade: int, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose chance of ``grade`` or more is at least ``least`` (all, without a model)."""
    if model is None:
        return docs
    return docs.where(scorer(docs, model, grade, text_col)["tail"] >= least)
