"""Helpers of the corpus operators: whole groups, hot look-ups, checkpoints that go."""

import gc
import os
import random
import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from equitylake.llm import common


def test_whole_groups_come_whole_and_once():
    pick = random.Random(1)
    for _ in range(200):
        keys = sorted((pick.randint(0, 4), pick.randint(0, 2)) for _ in range(pick.randint(0, 25)))
        rows = [(a, b, n) for n, (a, b) in enumerate(keys)]
        batches, at = [], 0
        while at < len(rows):
            n = pick.randint(0, 5)
            part = rows[at:at + n]
            batches.append(pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], pa.int64()) for i in range(3)], names=["a", "b", "n"]))
            at += n
        seen, groups = [], []
        for table, starts in common.whole_groups(iter(batches), 2):
            found = list(zip(*(table.column(i).to_pylist() for i in range(3))))
            seen += found
            groups += [found[s:e] for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(found)])]
        assert seen == rows
        assert [g[0][:2] for g in groups] == sorted(set(keys)) and all(len({r[:2] for r in g}) == 1 for g in groups)


def test_a_group_of_many_batches_is_put_together_once():
    n = 3000
    batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(1000, np.int64))], names=["a"]) for _ in range(n)]
    began = time.perf_counter()
    (table, starts), = common.whole_groups(iter(batches), 1)
    assert table.num_rows == n * 1000 and starts.tolist() == [0]
    assert time.perf_counter() - began < 5


def test_look_ups_of_hot_and_rare_keys_agree(spark, monkeypatch):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 700).alias("k"))
    facts = common.cut(rows.where("k is not null and k % 2 <> 0").groupBy("k").agg(F.count(F.lit(1)).alias("n")).withColumn("v", F.col("k") * 10))
    want = sorted((r.id, r.k, None if r.k is None or r.k % 2 == 0 else r.k * 10) for r in rows.collect())
    for few, hot in ((common.BROADCAST_ROWS, common.HOT_KEYS), (1, 300), (1, 10**9)):
        monkeypatch.setattr(common, "BROADCAST_ROWS", few)
        monkeypatch.setattr(common, "HOT_KEYS", hot)
        got = common.looked_up(rows, facts, "k", "n", 3000, ["id"])
        assert got.columns == ["id", "k", "v"]
        assert sorted(((r.id, r.k, r.v) for r in got.collect()), key=lambda r: r[0]) == sorted(want, key=lambda r: r[0])


def test_checkpoints_go_with_their_frame(spark):
    def size():
        root = spark.sparkContext.getCheckpointDir().replace("file:", "")
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names)

    spark.range(1).checkpoint() if spark.sparkContext.getCheckpointDir() else common.cut(spark.range(1))
    before = size()
    frame = common.cut(spark.range(300_000).withColumn("x", F.rand(1)))
    assert size() - before > 1_000_000
    del frame
    for _ in range(40):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
        if size() - before < 500_000:
            break
    assert size() - before < 500_000
