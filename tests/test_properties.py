"""Latest-wins does not depend on how the input is partitioned."""

from hypothesis import given, settings
from hypothesis import strategies as st

from equitylake.operators.latest import latest_wins

rows = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 3), st.integers(-5, 5)), min_size=1, max_size=40,
                unique_by=lambda r: r[2] * 1000 + r[0] * 10 + r[1])


@settings(max_examples=15, deadline=None)
@given(rows, st.integers(1, 7))
def test_latest_wins_is_partitioning_invariant(spark, data, parts):
    df = spark.createDataFrame([(a, b, i, v) for i, (a, b, v) in enumerate(data)], "a int, b int, seq int, v int")
    want = {}
    for i, (a, b, v) in enumerate(data):
        want[(a, b)] = v  # later seq wins
    got = latest_wins(df.repartition(parts), ["a", "b"], ["seq"]).collect()
    assert {(r.a, r.b): r.v for r in got} == want


def test_scan_order_survives_file_splits(spark, tmp_path):
    """The last row of a key in *file* order wins, however the file is split."""
    from equitylake.sources import landed

    root = tmp_path / "parts" / "statement=x" / "year=2011" / "period_part=FY"
    root.mkdir(parents=True)
    lines = ["symbol,revenue"] + [f"S{i % 37},{i}" for i in range(20000)]
    (root / "a.csv").write_text("\n".join(lines) + "\n")
    want = {}
    for i in range(20000):
        want[f"S{i % 37}"] = str(i)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("4k", "64k", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            raw = landed.read_statement_parts(spark, str(tmp_path / "parts"), "x")
            got = latest_wins(raw, ["symbol"], ["_file", "_block", "_row"]).collect()
            assert {r.symbol: r.revenue for r in got} == want, split
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_merge_latest_fresh_wins_whole_rows(spark):
    from equitylake.operators.latest import merge_latest
    stored = spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0)], "k int, name string, v double")
    fresh = spark.createDataFrame([(2, None, 21.0, 1), (2, "b3", 22.0, 2), (3, "c", 30.0, 1)],
                                  "k int, name string, v double, seq int")
    got = {r.k: (r.name, r.v) for r in merge_latest(stored, fresh.select("k", "name", "v", "seq"), ["k"], ["seq"]).collect()}
    assert got == {1: ("a", 10.0), 2: ("b3", 22.0), 3: ("c", 30.0)}
    only_fresh = merge_latest(None, fresh.filter("seq = 1"), ["k"], ["seq"])
    assert only_fresh.columns == ["k", "name", "v"] and only_fresh.count() == 2


def _py_float(text):
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


number_text = st.text(alphabet="0123456789.+-eE_ \t", max_size=12) | st.sampled_from(
    ["inf", "-Infinity", "nan", " NaN ", "1_000", "1__0", "_1", "1_", "1e1_0", ".5", "5.", ".", "e5", "1.5d", "0x10"])


@settings(max_examples=10, deadline=None)
@given(st.lists(number_text, min_size=50, max_size=80))
def test_as_float_agrees_with_python_float(spark, texts):
    import math

    from equitylake.functions.text import as_float
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", as_float("t").alias("v")).collect()}
    for i, t in enumerate(texts):
        want, have = _py_float(t), got[i]
        if want is not None and math.isnan(want):
            assert have is not None and math.isnan(have), t
        else:
            assert have == want, (t, have, want)


ws_text = st.text(alphabet=" \t\n\r\x0b\x0c\x85\xa0 　abcXYZ-.", max_size=10)


@settings(max_examples=10, deadline=None)
@given(st.lists(ws_text, min_size=40, max_size=60))
def test_as_str_agrees_with_python_strip(spark, texts):
    from equitylake.functions.text import as_str
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", as_str("t").alias("v")).collect()}
    assert got == {i: (t.strip() or None) for i, t in enumerate(texts)}


def _py_date(text):
    from datetime import date
    try:
        return date.fromisoformat(str(text).strip()[:10])
    except (TypeError, ValueError):
        return None


week_text = st.builds(lambda y, sep, w, tail: f"{y:04d}{sep}W{w:02d}{tail}", st.integers(1, 9999),
                      st.sampled_from(["", "-"]), st.integers(0, 54),
                      st.sampled_from(["", "-1", "-7", "-0", "-8", "3", "9", "6xy", "-5 "]))
date_text = week_text | st.text(alphabet="0123456789- :abTW", min_size=6, max_size=14) | st.sampled_from(
    ["2011-09-24", "20110924", "2011-02-30", "2024-02-29", " 1990-01-02 00:00:00", "2011-9-24", "20110230",
     "0000-01-01", "00000101", "0001-01-01", "2011092412", "20110924ab", "201109240", "2011-0924",
     "2011-W39", "2011W39", "2011-W39-6", "2011W396", "2011-W396", "2011W39-6", "2020-W53", "2021-W53",
     "2015-W53-7", "2011W396xy", "2011-w39"])


@settings(max_examples=20, deadline=None)
@given(st.lists(date_text, min_size=40, max_size=60))
def test_as_date_agrees_with_python_fromisoformat(spark, texts):
    from equitylake.functions.text import as_date
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", as_date("t").alias("v")).collect()}
    assert got == {i: _py_date(t) for i, t in enumerate(texts)}


def test_merge_latest_order_may_be_a_data_column(spark):
    from equitylake.operators.latest import merge_latest
    stored = spark.createDataFrame([(1, 5)], "k int, version int")
    fresh = spark.createDataFrame([(1, 7), (1, 6), (2, 1)], "k int, version int")
    got = merge_latest(stored, fresh, ["k"], ["version"])
    assert got.columns == ["k", "version"]
    assert sorted((r.k, r.version) for r in got.collect()) == [(1, 7), (2, 1)]
