"""Graph search against brute force."""

import numpy as np
from pyspark.sql import functions as F

from equitylake.llm import hnsw

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, query, k):
    q = np.array(dict(rows)[query], np.float64)
    found = []
    for i, v in rows:
        v = np.array(v, np.float64)
        if i != query and len(v) == len(q):
            found.append((-float(v @ q / (np.linalg.norm(v) * np.linalg.norm(q))), i))
    return sorted(found)[:k]


def vectors(n, dim=24, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, dim))
    return [[float(x) for x in np.float32(centres[rng.integers(10)] + rng.normal(size=dim))] for _ in range(n)]


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_recall_over_several_shards_and_query_blocks(spark):
    rows = list(enumerate(vectors(1500)))
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = answers(hnsw.nearest(df, df.where("vec_id % 50 = 0"), 5, shard_rows=400, query_block=10))
    assert sorted(got) == list(range(0, 1500, 50))
    hits = 0
    for q, found in got.items():
        want = brute(rows, q, 5)
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in want} & {i for _, i, _ in found})
        scores = {i: -s for s, i in brute(rows, q, len(rows))}
        assert all(abs(scores[i] - s) < 1e-12 for _, i, s in found)
    assert hits >= 0.98 * 5 * len(got)


def test_copies_ties_and_odd_rows(spark):
    v = vectors(30)
    rows = [(i, x) for i, x in enumerate(v)] + [(100 + i, v[7]) for i in range(20)] + [(200, v[0][:5]), (201, v[1][:5])]
    odd = [(300, None), (301, []), (302, [0.0] * 24), (303, [None] * 24), (304, [float("nan")] * 24), (None, v[3])]
    df = spark.createDataFrame([(i, x, 0) for i, x in [*rows, *odd, rows[2]]], SCHEMA).withColumnRenamed("label", "shard")
    got = answers(hnsw.nearest(df, df, 5))
    assert sorted(got) == sorted(i for i, _ in rows)
    for q, found in got.items():
        want = brute(rows, q, 5)
        assert [i for _, i, _ in found] == [i for _, i in want]


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, [1.0, 2.0], 0)], SCHEMA)
    assert hnsw.nearest(none, none, 5).count() == 0
    assert hnsw.nearest(none, some, 5).count() == 0
    assert hnsw.nearest(some, some, 5).count() == 0
    assert hnsw.nearest(some, some.where(F.lit(False)), 5).count() == 0


def test_rows_that_repeat_an_id_are_rows_of_their_own(spark):
    v = vectors(12)
    rows = [(i, x) for i, x in enumerate(v[:8])] + [(3, v[8]), (3, v[9]), (5, v[10]), (5, v[10])]
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], SCHEMA)
    got = hnsw.nearest(df, df.where("vec_id in (3, 6)"), 4).collect()
    distinct = rows[:-1]

    def want(own):
        q = np.array(distinct[own][1], np.float64)
        return sorted((-float(np.array(x) @ q / (np.linalg.norm(x) * np.linalg.norm(q))), i) for n, (i, x) in enumerate(distinct) if n != own)[:4]

    sets = {3: [want(3), want(8), want(9)], 6: [want(6)]}
    for q, lists in sets.items():
        found = sorted((r.rank, r.vec_id, round(r.score, 9)) for r in got if r.query_id == q)
        assert found == sorted((n + 1, i, round(-s, 9)) for one in lists for n, (s, i) in enumerate(one))


def test_shards_grow_with_the_table():
    assert hnsw.shard_rows_for(50_000, 6) == hnsw.SHARD_ROWS
    assert hnsw.shard_rows_for(10**7, 200) == 25_000
    assert hnsw.shard_rows_for(10**10, 8000) == hnsw.MOST_SHARD_ROWS
