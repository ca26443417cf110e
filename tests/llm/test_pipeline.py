"""The pipeline's stages against brute-force versions, and the registered queries."""

import corpus_pipeline
import duckdb
import pytest
from corpora import AWKWARD, documents, words, write
from test_linededup import brute as brute_lines
from test_pii import brute as brute_spans
from test_quality import corpus
from test_simhash import brute_components, brute_print

import __spark_entry__ as entry
from equitylake.llm import queries


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    texts, grades = corpus(240, 5)
    line = words(70, 12)
    for i in range(2, 240, 3):
        texts[i] += f"\n{line}\ncall +44 20 7946 09{i:02d} or a{i}@b.org"
    texts += [texts[5], texts[8].upper().lower(), *AWKWARD]
    write(documents(spark, texts), folder, "documents")
    labels = [(i, int(g > 0), int(g == 1)) for i, g in enumerate(grades) if i < 150]
    write(spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), folder, "labels")
    return folder


def test_stages_match_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "pii", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    before = {r.doc_id: r.text for r in docs.collect()}

    good = stages["quality_classifier"](spark, docs, folder).checkpoint()
    assert good.columns == columns
    kept = {r.doc_id for r in good.collect()}
    scored = {r.doc_id: r.kept for r in queries.op5_quality(spark, folder).collect()}
    assert kept == {i for i, k in scored.items() if k}
    assert {i for i in range(240) if i % 3 == 2} <= kept and not {i for i in range(240) if i % 3 < 2} & kept

    lines = stages["line_dedup"](spark, good, folder).checkpoint()
    assert lines.columns == columns
    got = {r.doc_id: r for r in lines.collect()}
    assert {i: r.text for i, r in got.items()} == {i: t for i, _, _, t in brute_lines([(i, before[i]) for i in kept])}
    assert all(r.n_chars == len(r.text) for r in got.values())

    single = stages["simhash_near_dedup"](spark, lines, folder).checkpoint()
    assert single.columns == columns
    want = brute_components([(i, brute_print(r.text)) for i, r in got.items()], 2)
    left = {r.doc_id: r.text for r in single.collect()}
    assert sorted(left) == sorted(i for i in want if want[i] == i)

    clean = stages["pii"](spark, single, folder).checkpoint()
    assert clean.columns == columns
    for r in clean.collect():
        assert not brute_spans(r.text) and r.n_chars == len(r.text)
        if not brute_spans(left[r.doc_id]):
            assert r.text == left[r.doc_id]

    packed = stages["packing"](spark, clean, folder).collect()
    assert sum(r.n_tokens for r in packed) == sum(len((r.text or "").split()) for r in clean.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect()), key=repr) == sorted(map(tuple, packed), key=repr)
    assert corpus_pipeline.ORACLE_SQL is None


def test_line_query_matches_its_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    want = con.execute(queries.SQL["op10_line_dedup"]).fetchall()
    names = [c[0] for c in con.description]
    got = [tuple(r[n] for n in names) for r in entry.queries()["op10_line_dedup"](spark, folder).collect()]
    assert sorted(got) == sorted(want)


def test_one_query_for_each_operator():
    names = list(entry.queries())
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names
