"""The ordinal classifier: its likelihood's slopes, held-out accuracy, selection."""

import random

import numpy as np
import pyarrow as pa
from corpora import AWKWARD, SCHEMA, documents, words

from equitylake.llm import quality


def test_fit_recovers_ordered_grades():
    rng = np.random.default_rng(1)
    n, d = 600, 40
    x = rng.normal(size=(n, d))
    true = rng.normal(size=d)
    grades = np.digitize(x @ true + rng.logistic(size=n), [-3, 3])
    row, index = np.divmod(np.arange(n * d), d)
    model = quality.fit_ordinal(grades, index, x.ravel(), row, 3, ridge=1e-5, least_signal=0)
    assert model.thresholds[0] < model.thresholds[1]
    scores = x @ model.weights[:d]
    p = model.probabilities(scores)
    assert np.allclose(p.sum(1), 1) and (p >= 0).all()
    assert np.corrcoef(scores, x @ true)[0, 1] > 0.95
    assert (p.argmax(1) == grades).mean() > 0.75
    assert np.allclose(model.tail(scores, 1), p[:, 1:].sum(1)) and np.allclose(model.expected(scores), p @ [0, 1, 2])


def corpus(n, seed):
    pick = random.Random(seed)
    vocabulary = words(9, 400).split()
    texts, grades = [], []
    for i in range(n):
        grade = i % 3
        w = [pick.choice(vocabulary) for _ in range(pick.randint(30, 400))]
        if grade == 0:
            w = [x.upper() + "!!" for x in w]
        if grade == 1:
            for k in range(0, len(w), 20):
                w[k] = pick.choice(["scum", "stupid"])
        texts.append(" ".join(w))
        grades.append(grade)
    return texts, grades


def test_held_out_documents_are_graded(spark):
    texts, grades = corpus(900, 3)
    docs = documents(spark, [*texts, *AWKWARD]).withColumnRenamed("lang", "found").withColumnRenamed("source", "tail")
    ratings = spark.createDataFrame([(i, g) for i, g in enumerate(grades) if i < 600] + [(0, 2), (None, 1), (1, None), (2, 7), (9999, 1)], "doc_id bigint, grade int")
    model = quality.fit(docs, ratings, 3)
    got = {r.doc_id: r for r in quality.scores(docs, model, 2).collect()}
    assert len(got) == len(texts) + len(AWKWARD)
    held = range(600, 900)
    assert np.mean([(got[i].tail >= 0.5) == (grades[i] == 2) for i in held]) > 0.98
    by_grade = [np.mean([got[i].expected_grade for i in held if grades[i] == g]) for g in range(3)]
    assert by_grade[0] < by_grade[1] < by_grade[2]
    kept = quality.select(docs, model, 2)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.tail >= 0.5}


def test_the_training_bound_is_kept(spark):
    texts, grades = corpus(60, 4)
    docs, ratings = documents(spark, texts), spark.createDataFrame(list(enumerate(grades)), "doc_id bigint, grade int")
    one = quality.fit(docs, ratings, 3, max_train=1)  # one document tells no feature from another
    assert np.count_nonzero(one.weights) == 0 < np.count_nonzero(quality.fit(docs, ratings, 3).weights)


def test_without_ratings_nothing_is_rejected(spark):
    docs = documents(spark, [None, "", "some text", "some text"])
    none = spark.createDataFrame([], "doc_id bigint, grade int")
    assert quality.fit(docs, none, 3) is None
    assert quality.select(docs, None, 2).count() == 4
    assert [r.tail for r in quality.scores(docs, None, 2).collect()] == [None] * 4
    empty = spark.createDataFrame([], SCHEMA)
    assert quality.fit(empty, spark.createDataFrame([(1, 1)], "doc_id bigint, grade int"), 3) is None


def test_marks_become_grades(spark):
    labels = spark.createDataFrame([(1, 0, 0), (2, 0, 1), (3, 1, 1), (4, 1, 0), (5, None, 0), (6, 1, None)], "doc_id bigint, quality int, toxic int")
    assert {r.doc_id: r.grade for r in quality.graded(labels).collect()} == {1: 0, 2: 0, 3: 1, 4: 2, 5: None, 6: None}


def test_fit_agrees_with_a_plain_optimiser():
    """The minimum of the same penalised likelihood, by plain gradient descent with numerical slopes on a small problem."""
    rng = np.random.default_rng(4)
    n, d, ridge = 120, 3, 1e-2
    x = rng.normal(size=(n, d))
    grades = np.digitize(x @ [1.0, -0.5, 0.2] + rng.logistic(size=n), [-1, 1])
    row, index = np.divmod(np.arange(n * d), d)
    model = quality.fit_ordinal(grades, index, x.ravel(), row, 3, rounds=500, ridge=ridge, least_signal=0)
    strength, spread = quality.signal(grades, index, x.ravel(), row, 3)
    scale = (np.minimum(1.0, strength / 20) / spread)[:d]

    def loss(free):
        cuts = np.array([free[d], free[d] + np.exp(free[d + 1])])
        upto = 1 / (1 + np.exp(-(cuts[None, :] - (x * scale @ free[:d])[:, None])))
        p = np.diff(upto, axis=1, prepend=0.0, append=1.0)[np.arange(n), grades]
        return -np.log(p).mean() + ridge / 2 * free[:d] @ free[:d]

    free = np.zeros(d + 2)
    for _ in range(6000):
        slope = np.array([(loss(free + e) - loss(free - e)) / 2e-5 for e in np.eye(d + 2) * 1e-5])
        free -= 0.3 * slope
    assert np.allclose(model.thresholds, [free[d], free[d] + np.exp(free[d + 1])], atol=5e-3)
    assert np.allclose(model.weights[:d], free[:d] * scale, atol=5e-3)


def test_an_id_that_repeats_is_fitted_once(spark):
    texts, grades = corpus(90, 5)
    ratings = spark.createDataFrame(list(enumerate(grades)), "doc_id bigint, grade int")
    once = quality.fit(documents(spark, texts), ratings, 3)
    many = quality.fit(documents(spark, [*enumerate(texts), *[(0, texts[0])] * 500]), ratings, 3)
    assert np.allclose(once.weights, many.weights) and np.allclose(once.thresholds, many.thresholds)


def test_batch_scores_are_those_of_the_features(monkeypatch):
    rng = np.random.default_rng(8)
    weights = np.where(rng.random(1 << quality.HASH_BITS) < 0.5, rng.normal(size=1 << quality.HASH_BITS), 0.0)
    texts = [*AWKWARD, *corpus(30, 6)[0], "a a a b\u2003c\x1cd\x85e\u00a0f", "A\u200bB c", "!!! ??? a", " lead", "trail ", "Same same SAME same."]
    words_of = quality._Words(weights != 0)
    want = []
    for t in texts:
        held, valued = quality.features(t or "", words_of)
        want.append(sum(weights[j] for j in held) + sum(weights[j] * v for j, v in valued.items()))
    assert np.allclose(quality.batch_scores(pa.array(texts, pa.string()), quality._Words(weights != 0), weights), want)
    assert np.allclose(quality.batch_scores(pa.array(["x", *texts]).slice(1), words_of, weights), want)
    monkeypatch.setattr(quality, "LOT_BYTES", 500)
    assert np.allclose(quality.batch_scores(pa.array(texts, pa.string()), words_of, weights), want)
    assert len(quality.batch_scores(pa.array([], pa.string()), words_of, weights)) == 0
    assert np.allclose(quality.batch_scores(pa.array([None, ""], pa.string()), words_of, weights), weights[quality._EMPTY])
