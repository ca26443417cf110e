"""Personal data: base spans against Python's own regular expressions, added spans, redaction."""

import random
import re

from corpora import AWKWARD, SCHEMA, documents
from pyspark.sql import functions as F

from equitylake.llm import pii

FIXED = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice) % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": True, "ip": kind == "ip" and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in hit.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def brute(text):
    return sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(FIXED) for m in re.finditer(p, text or "") if valid(kind, m[0]))


EDGES = [
    "a@b.c.@d.ee x@y.z_p@q.rr a@@b.cc .@-.-", "1.2.3.4.5.6.7.8 1.2.3 256.1.1.1 00255.0.0.1 1.2.3.4567", "+1 (918) 555-2191 ++12345678901+1 2 3",
    "4791340811390172 4799 1346 8104 4206 4-0-2-1-2-7-1-4-5-5-1-0-2-8-5-9 4021271455102859  1", "é𝄞 a@b.cc 𝄞 10.0.0.1é+44 20 7946 0958",
    "mail me@x.org,you@y.org;1.1.1.1@host.net", "9" * 5000 + ".1.1.1 " + "a" * 20_000 + "@" + "b." * 3000 + "c", "12 " * 4000,
]


def test_base_spans_match_python(spark):
    pick = random.Random(4)
    noise = ["".join(pick.choice("a1.@+- ()é2") for _ in range(300)) for _ in range(60)]
    texts = [*AWKWARD, *EDGES, *noise]
    docs = documents(spark, texts).withColumnRenamed("lang", "key").withColumnRenamed("source", "spans")
    for r in pii.span_report(docs).collect():
        base = [(s.start, s.rank - 1, s.kind, s.end) for s in r.spans if s.base]
        assert base == brute(texts[r.doc_id]), texts[r.doc_id][:200]


def secrets(n):
    pick = random.Random(6)

    def run(alphabet, size):
        return "".join(pick.choice(alphabet) for _ in range(size))

    out = []
    for i in range(n):
        out.append((f"some words password={run('0123456789abcdef', 18)} and more", True))
        out.append((f'and token = "{run("0123456789abcdef", 40)}" there', True))
        out.append((f"key AKIA{run('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 16)} in use", True))
        out.append((f"chapter {i} of the story of a longwordwithoutanydigitsinit", False))
        out.append((f"released as version {i}.{i}.{i} of release-candidate-{i}", False))
    return out


def test_credentials_are_added_and_plain_text_left_alone(spark):
    cases = secrets(40)
    got = {r.doc_id: r.spans for r in pii.span_report(documents(spark, [t for t, _ in cases])).collect()}
    for i, (text, has) in enumerate(cases):
        assert bool(got[i]) == has, (text, got[i])
        assert all(s.kind == "secret" and not s.base for s in got[i])


def test_reliable_labelers_win():
    votes = [((1, 1, None), 90), ((1, 0, 1), 5), ((0, 0, None), 200), ((0, 1, 0), 10)]
    share, chances, posterior = pii.reliabilities(votes)
    assert posterior[1, 1, None] > 0.95 and posterior[0, 0, None] < 0.05
    assert 0.1 < share < 0.6 and chances[0][0] > chances[0][1]
    assert pii.reliabilities([])[2] == {}


def test_redaction(spark):
    texts = ["write to a.b@c.org or 10.1.2.3.", None, "", "clean text", "𝄞 +44 20 7946 0958 é a@b.cc", "1.2.3.4@x.yy end"]
    docs = documents(spark, texts).withColumnRenamed("lang", "prev").withColumnRenamed("source", "wide")
    clean = pii.redact(docs, chars_col="n_chars")
    assert clean.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    want = ["write to [EMAIL] or [IP].", None, "", "clean text", "𝄞 [PHONE] é [EMAIL]", "[EMAIL] end"]
    assert got == {i: (t, None if t is None else len(t)) for i, t in enumerate(want)}


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    docs = documents(spark, [(1, "a@b.cc"), (1, "a@b.cc"), (1, "c d@e.ff"), (None, "g@h.ii"), (None, None)])
    got = sorted((str(r.doc_id), [(s.start, s.end) for s in r.spans]) for r in pii.span_report(docs).collect())
    assert got == [("1", [(0, 6)]), ("1", [(0, 6)]), ("1", [(2, 8)]), ("None", []), ("None", [(0, 6)])]
    assert pii.redact(docs).count() == 5
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.span_report(empty).count() == 0 and pii.redact(empty).count() == 0


def test_a_span_that_overlaps_none_that_stays_stays(spark, monkeypatch):
    """Three in a chain: the second goes because of the first, the third stays; redaction hides all three."""
    chain = [("secret", 0, 10, False), ("number", 8, 20, False), ("secret", 18, 30, False), ("number", 29, 31, False),
             ("email", 32, 40, True), ("number", 42, 50, False), ("number", 42, 46, False), ("secret", 46, 55, False), ("secret", 50, 58, False)]
    free = spark.createDataFrame([(k, *s) for k in ("a", "b") for s in chain], "key string, kind string, start bigint, end bigint, base boolean")
    got = sorted((r.key, r.start, r.end) for r in pii.settled(free).collect())
    assert got == [(k, *s) for k in ("a", "b") for s in [(0, 10), (18, 30), (32, 40), (42, 50), (50, 58)]]
    spots = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(a).cast("bigint").alias("start"), F.lit(b).cast("bigint").alias("end"), F.lit(base).alias("base"))
                      for k, a, b, base in chain])
    monkeypatch.setattr(pii, "candidates", lambda rows: rows.select("key", F.explode(spots).alias("s")).select("key", "s.*"))
    monkeypatch.setattr(pii, "added", lambda found: found.withColumn("probability", F.lit(1.0)))
    (row,) = pii.redact(documents(spark, ["0123456789" * 6])).collect()
    assert row.text == "[SECRET]1[EMAIL]01[NUMBER]89"
