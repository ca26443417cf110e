"""Passage dedup: anchors, exact Jaccard, and planted passages."""

import random

import numpy as np
import pyarrow as pa
from corpora import AWKWARD, SCHEMA, documents, words

from equitylake.llm import passages


def test_paragraphs_depend_on_their_words_alone():
    shared = words(1, 70)
    texts = [f"{words(2, 33)} {shared} {words(3, 50)}", f"{words(4, 8)}\n{shared.upper()}\t{words(5, 90)}", shared, "", words(6, 10)]
    row, place, shingles = passages.paragraphs(pa.array([t.encode() for t in texts]))
    content = passages.content_of(shingles)
    by_row = [set(content[row == i].tolist()) for i in range(5)]
    assert by_row[0] & by_row[1] and by_row[0] & by_row[2] and not by_row[3] and not by_row[4]
    for i, p, c in zip(row, place, content):
        w = texts[i].lower().split()[p:p + passages.WORDS]
        again = passages.paragraphs(pa.array([" ".join(w).encode()]))
        assert len(w) == passages.WORDS
        assert len(again[0]) == 0 or passages.content_of(again[2])[0] == c or again[1][0] != 0
    parts = [passages.paragraphs(pa.array([t.encode()])) for t in texts]  # batching makes no difference
    assert np.concatenate([passages.content_of(s) for _, _, s in parts if len(s)]).tolist() == content.tolist()


def test_jaccard_is_exact():
    rng = np.random.default_rng(1)
    sets = rng.integers(0, 12, size=(40, 10))
    for one in sets:
        want = [len(set(one) & set(o)) / len(set(one) | set(o)) for o in sets]
        assert np.allclose(passages.jaccard(one, sets), want)


def test_segments_of_long_texts_make_no_difference(monkeypatch):
    text = pa.array([words(3, 4000).encode(), words(4, 10).encode()])
    whole = passages.paragraphs(text)
    monkeypatch.setattr(passages, "SEGMENT_BYTES", 64)
    assert all((a == b).all() for a, b in zip(whole, passages.paragraphs(text)))


def grams(words):
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def planted():
    pick = random.Random(8)
    texts = [words(1000 + i, pick.randint(60, 300)) for i in range(60)]
    shared = {k: words(500 + k, 51 + k) for k in range(12)}
    holders = {}
    for k, passage in shared.items():
        for i in pick.sample(range(60), 3):
            w = texts[i].split()
            at = pick.randint(0, len(w))
            texts[i] = " ".join(w[:at]) + f"\n{passage} " + " ".join(w[at:])
            holders.setdefault(k, set()).add(i)
    texts += [texts[5], texts[5].upper(), " ".join(["again"] * 80), " ".join(["again"] * 90)]
    return texts, shared, holders


def test_planted_passages_are_found_and_clean_documents_left_alone(spark):
    texts, shared, holders = planted()
    all_texts = [*texts, *AWKWARD]
    docs = documents(spark, all_texts).withColumnRenamed("lang", "first").withColumnRenamed("source", "content")
    found = passages.repeated(docs)
    spans = found.collect()
    got = {r.doc_id for r in spans}
    want = {i for s in holders.values() for i in s - {min(s)}} | {60, 61, 63}
    assert want <= got
    assert got <= {i for s in holders.values() for i in s} | {60, 61, 62, 63}
    for r in spans:
        assert r.keeper < r.doc_id
        held = all_texts[r.doc_id].lower().split()[r.first_word:r.end_word]
        own = grams(held[:passages.WORDS])
        assert len(own & grams(all_texts[r.keeper].lower().split())) >= 0.8 * len(own)
    left = {r.doc_id: r.text for r in passages.remove(docs, found).collect()}
    for i, t in enumerate(all_texts):
        if i not in got:
            assert left[i] == t
        else:
            gone = {w for r in spans if r.doc_id == i for w in range(r.first_word, r.end_word)}
            assert left[i].split() == [w for k, w in enumerate(t.split()) if k not in gone]


def test_near_paragraphs_link_by_jaccard(spark, monkeypatch):
    """A paragraph whose last word differs keeps a similarity of 0.8 or more."""
    passage = words(77, passages.WORDS + 30).split()
    texts = []
    for i in range(12):
        w = list(passage)
        w[passages.WORDS + 5] = f"odd{i}"
        texts.append(" ".join(w))
    spans = passages.repeated(documents(spark, texts)).collect()
    assert {r.doc_id for r in spans} == set(range(1, 12))


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    text = words(3, 120)
    got = passages.repeated(documents(spark, [(4, text), (4, text), (None, text)])).collect()
    assert got == []
    got = passages.repeated(documents(spark, [(4, text), (4, text), (9, text), (9, text)])).collect()
    assert {r.doc_id for r in got} == {9} and {r.keeper for r in got} == {4}
    empty = spark.createDataFrame([], SCHEMA)
    assert passages.repeated(empty).count() == 0
    assert passages.remove(empty, passages.repeated(empty)).count() == 0


def removed(spark, texts):
    """The words each document loses."""
    gone = {i: set() for i in range(len(texts))}
    for r in passages.repeated(documents(spark, texts)).collect():
        gone[r.doc_id] |= set(range(r.first_word, r.end_word))
    return gone


def test_near_paragraphs_of_any_length_link(spark):
    """A word changed anywhere, at a similarity of the whole paragraphs of 0.8 or more."""
    texts, want = [], {}
    for k, (length, edits) in enumerate([(60, [30]), (100, [33, 66]), (200, [40, 80, 120]), (52, [25]), (16, [15])]):
        for tail in ("\n", "\n\n"):
            paragraph = words(900 + k + len(tail) * 50, length).split()
            other = [f"odd{j}" if j in edits else w for j, w in enumerate(paragraph)]
            assert len(grams(paragraph) & grams(other)) >= 0.8 * len(grams(paragraph) | grams(other))
            for held in (paragraph, other):
                if tail == "\n\n" and length > 30:  # wrapped at other words
                    held = [*held[:9 + len(texts) % 2], "\n", *held[9 + len(texts) % 2:]]
                texts.append(words(2000 + len(texts), 40) + tail + " ".join(held) + tail + words(3000 + len(texts), 40))
            want[len(texts) - 1] = set(range(40, 40 + length))
    gone = removed(spark, texts)
    assert gone == {i: want.get(i, set()) for i in range(len(texts))}


def test_the_whole_of_a_shared_passage_goes(spark):
    texts, want = [], []
    for k in range(40):
        shared = words(5000 + k, 50 + k % 31)
        for side in range(2):
            head = words(6000 + 2 * k + side, 30 + k)
            texts.append(f"{head} {shared} {words(7000 + 2 * k + side, 35)}")
            want.append(set(range(30 + k, 80 + k + k % 31)) if side else set())
    assert removed(spark, texts) == dict(enumerate(want))


def test_phrases_said_again_and_again_go_whole(spark):
    texts, want = [], []
    for period in range(1, 9):
        for times in (-(-50 // period), -(-120 // period)):
            shared = " ".join([words(8000 + period * 10 + times, period)] * times)
            for side in range(2):
                n = len(texts)
                texts.append(f"{words(9000 + n, 33 + n)} {shared} {words(9500 + n, 41)}")
                want.append(set(range(33 + n, 33 + n + period * times)) if side else set())
    assert removed(spark, texts) == dict(enumerate(want))


def test_short_paragraphs_and_texts_are_units(spark):
    line, verse = words(41, 20), words(42, 6).split()
    texts = [line, line, words(43, 30) + "\n" + line + "\n" + words(44, 30), words(45, 5), words(45, 5), words(46, 4), words(46, 4),
             " ".join(verse[:3]) + "\n" + " ".join(verse[3:]), " ".join(verse[:2]) + "\n" + " ".join(verse[2:])]
    whole = {1: set(range(20)), 2: set(range(30, 50)), 4: set(range(5)), 8: set(range(6))}
    assert removed(spark, texts) == {i: whole.get(i, set()) for i in range(len(texts))}


def test_near_paragraphs_match_all_pairs(spark):
    """Every pair of a few hundred paragraphs by exact Jaccard, and the components of those at 0.8 or more."""
    pick = random.Random(21)
    texts = []
    for c in range(60):
        base = words(7000 + c, 44).split()
        for _ in range(pick.randint(1, 7)):
            w = list(base)
            for _ in range(pick.randint(0, 3)):
                at = pick.choice([0, 1, 2, 41, 42, 43, pick.randint(0, 43)])
                if pick.random() < 0.7:
                    w[at] = f"other{pick.randint(0, 99)}"
                else:
                    w = w[:-2] if at > 20 else w[1:]
                    w += ["more"] * (44 - len(w))
            texts.append(" ".join(w))
    pick.shuffle(texts)
    sets = [grams(t.split()) for t in texts]
    low = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    for _ in texts:
        for i, j in pairs:
            low[i] = low[j] = min(low[i], low[j])
    found = {(r.doc_id, r.first_word, r.end_word, r.keeper) for r in passages.repeated(documents(spark, texts)).collect()}
    near = {(i, 0, len(t.split()), low[i]) for i, t in enumerate(texts) if low[i] != i}
    assert len(pairs) > 150 and near <= found
    for doc, first, end, keeper in found - near:  # the others are passages that the keeper holds word for word
        assert " ".join(texts[doc].split()[first:end]) in texts[keeper]
