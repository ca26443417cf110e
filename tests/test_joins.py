"""Joins against key lists: the small side is computed once, a filter stands before a shuffle."""

import pytest
from pyspark.sql import functions as F

from equitylake.operators.joins import anti_join, attach, may_match, semi_join
from equitylake.operators.latest import overlay
from test_plans import physical


def big_and_small(spark, n=4000):
    big = spark.range(n).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"), F.col("id").alias("v"))
    small = spark.range(0, n, 10).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"), (F.col("id") * 2).alias("w"))
    return big, small


@pytest.mark.parametrize("bound", [1_000_000, 5])
def test_joins_agree_within_and_beyond_the_bound(spark, bound):
    big, small = big_and_small(spark)
    big = big.unionByName(spark.createDataFrame([(None, -1)], "symbol string, v bigint"))
    assert {r.v for r in semi_join(big, small, max_broadcast_rows=bound).collect()} == set(range(0, 4000, 10))
    assert {r.v for r in anti_join(big, small, max_broadcast_rows=bound).collect()} == set(range(4000)) - set(range(0, 4000, 10)) | {-1}
    assert {(r.v, r.w) for r in attach(big, small, max_broadcast_rows=bound).collect()} == {(v, 2 * v) for v in range(0, 4000, 10)}


def test_small_side_is_computed_once(spark):
    evaluated = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            evaluated.add(b.num_rows)
            yield b

    big, small = big_and_small(spark)
    counted = small.mapInArrow(count, "symbol string, w bigint")
    assert semi_join(big, counted).count() == 400
    assert evaluated.value == 400


def test_filter_passes_every_match_and_few_others(spark):
    big, small = big_and_small(spark, 20_000)
    passed = {r.v for r in may_match(big, small, ["symbol"], 2000).collect()}
    matches = set(range(0, 20_000, 10))
    assert passed >= matches
    assert len(passed - matches) < 0.1 * 18_000


def test_filter_stands_before_the_shuffle_of_the_big_side(spark):
    big, small = big_and_small(spark)
    plan = semi_join(big, small, max_broadcast_rows=5)._jdf.queryExecution().optimizedPlan().toString()
    first, second = plan.split("Join Inner")[1:]
    assert "(symbol" in first and "__word" in second and "strategy=broadcast" in second  # the filter's join is below


def test_overlay_replaces_by_key_with_null_parts(spark):
    stored = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0), (None, 1, 3.0)], "symbol string, d int, c double")
    fresh = spark.createDataFrame([(9.0, 1, "B"), (8.0, 1, None), (7.0, 2, "A")], "c double, d int, symbol string")
    want = {("A", 1, 1.0), ("B", 1, 9.0), (None, 1, 8.0), ("A", 2, 7.0)}
    for bound in (10, 1):
        assert {tuple(r) for r in overlay(stored, fresh, ["symbol", "d"], 3, bound).collect()} == want
    assert "Exchange hashpartitioning" not in physical(overlay(stored, fresh, ["symbol", "d"], 3))
