"""Piece encoding: best scores against a plain dynamic programme, exact round trips."""

import os
import random

import numpy as np
import pyarrow as pa
import pytest
from corpora import AWKWARD, SCHEMA, documents

from equitylake.llm import pieces

pytestmark = pytest.mark.skipif(not os.path.exists(pieces.MODEL), reason="public tokenizer files not present")


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel.load(pieces.MODEL)


def brute(model, text):
    """Best total score of a marked text over all segmentations into pieces and bytes."""
    normal = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds) if k == "n"}
    best = [0.0]
    for end in range(1, len(text) + 1):
        own = text[end - 1] in normal
        found = float("-inf") if own else best[end - 1] + model.byte_score * len(text[end - 1].encode())
        for start in range(max(0, end - 16), end):
            if text[start:end] in normal:
                found = max(found, best[start] + normal[text[start:end]])
        best.append(found)
    return best[-1]


def score(model, ids):
    return sum(model.scores[i] if model.kinds[i] == "n" else model.byte_score for i in ids)


def texts(n):
    pick = random.Random(7)
    return ["".join(pick.choice("the and of ning  \n\té日本𝄞▁x<s>ñ.") for _ in range(pick.randint(0, 60))) for _ in range(n)]


def test_segmentation_is_best(model):
    for text in texts(150):
        marked = (" " + text.replace(pieces.MARK, "")).replace(" ", pieces.MARK)
        assert score(model, pieces.best_pieces(model, marked)) == pytest.approx(brute(model, marked), rel=1e-12)


def test_stretches_are_independent(model):
    encoder = pieces.Encoder(model, remembered=3)
    for text in texts(150):
        text = text.replace(pieces.MARK, "")
        whole = pieces.best_pieces(model, (" " + text).replace(" ", pieces.MARK)) if text else []
        assert list(encoder.encode(text)) == whole


def test_many_at_once_give_the_same_pieces(model):
    pick = random.Random(11)
    words = ["".join(pick.choice("theandofnig▁▁xrsé日") for _ in range(pick.randint(0, 40))) for _ in range(2000)]
    words = [w for w in words if model.characters.issuperset(w)] + ["", "a", "▁", "▁▁▁"]
    assert len(words) > 300
    found = pieces.best_many(model, words)
    assert [list(memoryview(f).cast("i")) for f in found] == [pieces.best_pieces(model, w) for w in words]
    assert pieces.best_many(model, []) == [] and pieces.best_many(model, [""]) == [b""]


def test_batches_agree_with_single_texts(model, monkeypatch):
    every = [*texts(300), *AWKWARD, "a  b", "▁x", "\x00", "x" * 5000, " lead", "trail ", "\n\n", None, ""]
    want = [pieces.Encoder(model).encode(t or "") for t in every]
    for lot, remembered in ((pieces.LOT_BYTES, 10**6), (200, 10**6), (50, 5)):
        monkeypatch.setattr(pieces, "LOT_BYTES", lot)
        encoder = pieces.Encoder(model, remembered)
        for texts_of in (pa.array(every), pa.array([None, *every, "x"]).slice(1, len(every))):
            counts, flat = encoder.batch(texts_of)
            assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == want
    assert pieces.Encoder(model).batch(pa.array([], pa.string()))[0].tolist() == []


def test_round_trip(spark, model):
    every = [*AWKWARD, *texts(200), "▁", " ▁▁ ", "<0x0A>", "\u0000", "<unk></s>"]
    docs = documents(spark, [*enumerate(every), (3, every[3]), (None, "null id")]).withColumnRenamed("lang", "piece_ids").withColumnRenamed("source", "decoded")
    rows = pieces.encoded(docs, model).collect()
    assert len(rows) == len(every) + 2
    for r in rows:
        text = "null id" if r.doc_id is None else every[r.doc_id]
        assert r.round_trip is (None if text is None else True)
        assert r.n_pieces == len(r.piece_ids or [])
        assert (r.piece_ids is None) == (text is None)
    again = pieces.decode(pieces.encode(docs, model), model, "piece_ids_")
    assert again.columns == [*docs.columns, "piece_ids_", "decoded_"]
    assert all(r.decoded_ == r.text for r in again.collect())


def test_odd_ids_and_an_empty_table(spark, model):
    ids = spark.createDataFrame([([None, -1, 10**6, 0, 1],), ([],), (None,)], "piece_ids array<int>")
    assert [r.decoded for r in pieces.decode(ids, model).collect()] == ["", "", None]
    assert pieces.encoded(spark.createDataFrame([], SCHEMA), model).count() == 0
