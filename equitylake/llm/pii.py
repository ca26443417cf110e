"""Operator 6, personal data by weak supervision, in DataFrame expressions only.

Every whole text is scanned once per family of candidates. A candidate's
place follows from the lengths of the gaps that ``split`` leaves between the
matches, summed in order, so nothing depends on the length of the text.

* Base spans (email, ip, card, phone) are the valid matches of the fixed
  patterns; they always stay.
* All other candidates (credential-like tokens, national phone and identity
  numbers, invalid matches of the base patterns) get votes from five
  labelers: a strict format (regex), a gazetteer of issuers, the words before
  the span (context), a gazetteer of harmless surroundings, and the make-up
  of the characters. Counts of vote patterns, at most a few hundred whatever
  the corpus holds, go through expectation-maximisation for the labelers'
  reliabilities; the posterior of each pattern is the soft label that trains
  a logistic span classifier on the span's own features, again from counts
  of feature patterns. Candidates of probability 0.5 or more that overlap no
  base span become spans of kind ``secret`` or ``number``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from equitylake.llm.common import cut, fresh, only

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "number")
_LOCAL = "[A-Za-z0-9._%+-]"
# The base patterns, written so that no run of characters is scanned twice: a
# possessive quantifier where giving back cannot help, and a start only where
# a run or the rest of one begins (\G: right after the last match).
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9+/_-])(?:A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9+/_-])|(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+)",
    "number": r"(?<![A-Za-z0-9+.-])\(?[0-9]{3}\)?[\x20.-](?:[0-9]{3}[\x20.-][0-9]{4}|[0-9]{2}-[0-9]{4})(?![0-9A-Za-z-])",
}
# A text without this cannot hold a match.
_NEEDS = {"email": "@", "phone": r"\+", "secret": "[0-9]|A[KS]IA"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
VALID = {
    "email": "true",
    "ip": rf"hit rlike r'^{_BYTE}(?:\.{_BYTE}){{3}}$'",
    "card": "length(digits) between 14 and 19 and luhn_check(digits)",
    "phone": "length(digits) between 10 and 15",
    "secret": "false",
    "number": "false",
}
# Votes on a candidate: 1 personal, 0 harmless, null abstains.
LABELERS = {
    "format": r"""case kind
        when 'secret' then int(hit rlike r'^(?:A[KS]IA[0-9A-Z]{16}|[0-9a-f]{16,}|gh[pousr]_[A-Za-z0-9]{36}|sk[-_][A-Za-z0-9_-]{20,}|xox[abp]-.+)$')
        when 'number' then int(hit rlike r'^(?:\(?[2-9][0-9]{2}\)?[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}|[0-8][0-9]{2}-[0-9]{2}-[0-9]{4})$')
        else 0 end""",
    "issuer": r"""case when kind = 'secret' and lower(hit) rlike r'^(?:akia|asia|gh[pousr]_|xox[abp]-|sk[-_]|pk[-_]|aiza|eyj)' then 1
        when kind = 'number' and hit rlike r'^\(?8(?:00|33|44|55|66|77|88)' then 0 end""",
    "context": r"""case when left rlike r'(?:pass(?:word|wd|phrase)?|pwd|token|secret|api[_-]?key|auth|credential|key|ssn|social security|tel|phone|mobile|call|fax)["\x27]?\s*(?:number|no\.?|is)?\s*[:=]?\s*["\x27]?$' then 1 end""",
    "harmless": r"""case when left rlike r'(?:version|commit|revision|isbn|issn|doi|https?:|www\.|build|order|invoice|ref|sha(?:1|256)?)[^a-z]*$' then 0 end""",
    "make_up": r"""case when kind = 'secret' then case when n_digits >= 4 and n_kinds >= 8 then 1 when n_kinds < 7 then 0 end
        when kind = 'number' then int(n_kinds >= 5) when length(digits) < 7 then 0 end""",
}
# What the span classifier sees of a candidate: its family, shape and setting.
FEATURES = {
    "family": "kind",
    "length": "least(6, floor(log2(length(hit))))",
    "digit_share": "floor(4 * n_digits / (length(hit) + 1))",
    "case": "concat(int(hit rlike '[a-z]'), int(hit rlike '[A-Z]'))",
    "assigned": r"""int(left rlike r'[:=]\s*["\x27]?$')""",
    "before": r"""case when left = '' then 'start' when left rlike r'\s$' then 'space' else 'other' end""",
    "variety": "least(4, floor(n_kinds / 4))",
    "opening": "case when hit rlike '^[A-Z]{4}' then 'upper' when hit rlike '^[a-z]{2,4}[_-]' then 'prefix' when hit rlike '^[0-9a-f]+$' then 'hex' end",
}
CONTEXT_CHARS = 40


# ------------------------------------------------------------------ candidates
def _hits(kind: str, text: Column) -> Column:
    pattern = PATTERNS[kind]
    # One gap more than matches: its row has no hit and goes after the explode.
    both = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1),
                      lambda hit, gap: F.struct(hit.alias("hit"), F.length(gap).alias("gap"),
                                                F.lower(F.substring(gap, -CONTEXT_CHARS, CONTEXT_CHARS)).alias("left")))
    rows = F.transform(both, lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), x["hit"].alias("hit"),
                                                   x["gap"].alias("gap"), x["left"].alias("left")))
    rows = F.filter(rows, lambda x: x["hit"].isNotNull())
    return F.when(text.rlike(_NEEDS.get(kind, "[0-9]")), rows)


def candidates(rows: DataFrame) -> DataFrame:
    """(key, kind, start, end, hit, left, ...) of every match in ``rows`` (key, text); places in code points, end exclusive."""
    empty = F.array().cast("array<struct<kind:string,i:int,hit:string,gap:int,left:string>>")
    found = rows.select("key", F.explode(F.concat(*[F.coalesce(_hits(k, F.col("text")), empty) for k in KINDS])).alias("c")).select("key", "c.*")
    found = found.dropDuplicates(["key", "kind", "i"])  # rows that repeat have one set of spans
    placed = found.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(
        W.partitionBy("key", "kind").orderBy("i")))
    shaped = (placed.withColumn("start", F.col("end") - F.length("hit"))
                    .withColumn("digits", F.regexp_replace("hit", "[^0-9]", ""))
                    .withColumn("n_digits", F.length("digits"))
                    .withColumn("n_kinds", F.size(F.array_distinct(F.split("hit", "")))))
    valid = F.expr("case kind " + " ".join(f"when '{k}' then {v}" for k, v in VALID.items()) + " end")
    return shaped.withColumn("base", valid).drop("i", "gap")


# ------------------------------------------------------------------ weak supervision
def reliabilities(patterns: list[tuple[tuple, float]], rounds: int = 50) -> tuple[float, list[tuple[float, float]], dict]:
    """Expectation-maximisation over counted vote patterns.

    Each labeler has a chance to vote 1 on a personal and on a harmless
    candidate (abstentions say nothing). Beta priors keep a labeler that
    hardly votes, or a corpus with few candidates, near 0.8 and 0.2. Returns
    the share of personal candidates, the chances, and a posterior for each pattern.
    """
    n_labelers = max((len(v) for v, _ in patterns), default=0)
    share, chances = 0.5, [(0.8, 0.2)] * n_labelers
    posterior: dict = {}
    for _ in range(rounds):
        for votes, _n in patterns:
            odds = math.log(share / (1 - share))
            for vote, (yes, no) in zip(votes, chances):
                if vote is not None:
                    odds += math.log(yes / no) if vote else math.log((1 - yes) / (1 - no))
            posterior[votes] = 1 / (1 + math.exp(-odds))
        total = sum(n for _, n in patterns)
        share = (1 + sum(n * posterior[v] for v, n in patterns)) / (2 + total)
        chances = []
        for j in range(n_labelers):
            cast = [(v[j], n, posterior[v]) for v, n in patterns if v[j] is not None]
            yes = (8 + sum(n * p for vote, n, p in cast if vote)) / (10 + sum(n * p for _, n, p in cast))
            no = (2 + sum(n * (1 - p) for vote, n, p in cast if vote)) / (10 + sum(n * (1 - p) for _, n, p in cast))
            chances.append((yes, no))
    return share, chances, posterior


def fit_logistic(patterns: list[tuple[tuple, float, float]], rounds: int = 300, ridge: float = 1.0) -> dict:
    """Weights of (feature position, value), and of None the intercept, from (values, count, mean soft label)."""
    weights: dict = {None: 0.0} | {(j, x): 0.0 for values, _, _ in patterns for j, x in enumerate(values)}
    steps = dict.fromkeys(weights, 1e-6)
    for _ in range(rounds):
        slope = {k: ridge * w if k is not None else 0.0 for k, w in weights.items()}
        for values, n, label in patterns:
            keys = [None, *enumerate(values)]
            gap = n * (1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights[k] for k in keys))))) - label)
            for k in keys:
                slope[k] += gap
        for k, g in slope.items():  # steps scaled by each weight's own gradients
            steps[k] += g * g
            weights[k] -= 0.5 * g / math.sqrt(steps[k])
    return weights


def _score(weights: dict) -> Column:
    total = F.lit(float(weights[None]))
    for j, name in enumerate(FEATURES):
        of = {x: w for k, w in weights.items() if k is not None and k[0] == j for x in (k[1],)}
        term = F.lit(0.0)
        for x, w in sorted(of.items(), key=repr):
            term = F.when(F.col(f"f_{name}") == F.lit(x), F.lit(w)).otherwise(term)
        total = total + term
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def added(found: DataFrame) -> DataFrame:
    """``found`` with ``probability`` that a candidate is personal (base spans: 1)."""
    rows = found.withColumns({f"v_{n}": F.expr(e) for n, e in LABELERS.items()}
                             | {f"f_{n}": F.expr(e).cast("string") for n, e in FEATURES.items()})
    votes, features = [f"v_{n}" for n in LABELERS], [f"f_{n}" for n in FEATURES]
    # Patterns, not candidates, come to the driver: at most the product of the columns' values.
    counted = rows.where("not base").groupBy(*votes, *features).agg(F.count(F.lit(1)).alias("n")).collect()
    by_votes: dict = {}
    for r in counted:
        key = tuple(r[v] for v in votes)
        by_votes[key] = by_votes.get(key, 0) + r["n"]
    _, _, posterior = reliabilities(sorted(by_votes.items(), key=repr))
    by_features: dict = {}
    for r in counted:
        n, s = by_features.get(key := tuple(r[f] for f in features), (0, 0.0))
        by_features[key] = (n + r["n"], s + r["n"] * posterior[tuple(r[v] for v in votes)])
    weights = fit_logistic([(k, n, s / n) for k, (n, s) in sorted(by_features.items(), key=repr)])
    return rows.withColumn("probability", F.when(F.col("base"), 1.0).otherwise(_score(weights))).drop(*votes, *features)


def spans(rows: DataFrame, overlapping: bool = False) -> DataFrame:
    """(key, kind, start, end, base) of the spans in ``rows`` (key, text): base ones, and added ones of probability 0.5 or more.

    An added span that overlaps one that stays before it goes, unless ``overlapping`` asks for all;
    of those that start together the longest is first.
    """
    scored = added(cut(candidates(rows)))
    chosen = scored.where("probability >= 0.5").withColumn(
        "kind", F.when(F.col("base") | (F.col("kind") == "secret"), F.col("kind")).otherwise("number"))
    order = W.partitionBy("key").orderBy("start", F.desc("base"), F.desc("end"), "kind")
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    free = chosen.withColumn("free", F.col("base") | ((F.coalesce(base_end, F.lit(-1)) <= F.col("start"))
                                                      & (F.coalesce(base_start, F.col("end")) >= F.col("end"))))
    free = free.where("free").select("key", "kind", "start", "end", "base")
    return free if overlapping else settled(free)


def settled(free: DataFrame) -> DataFrame:
    """``free`` (key, kind, start, end, base) without the added spans that overlap one that stays before them; none overlaps a base span."""
    order = W.partitionBy("key").orderBy("start", F.desc("base"), F.desc("end"), "kind")
    added_end = F.max(F.when(~F.col("base"), F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    runs = free.withColumn("new", (F.col("base") | (F.coalesce(added_end, F.lit(-1)) <= F.col("start"))).cast("int")).withColumn(
        "run", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    gathered = runs.groupBy("key", "run").agg(F.array_sort(F.collect_list(F.struct(
        "start", (-F.col("end")).alias("back"), "kind", "end", "base"))).alias("all"))
    stay = F.aggregate(F.slice("all", F.lit(2), F.size("all")), F.slice("all", 1, 1),
                       lambda kept, s: F.when(s["start"] >= F.element_at(kept, -1)["end"], F.concat(kept, F.array(s))).otherwise(kept))
    return gathered.select("key", F.explode(stay).alias("s")).select("key", "s.kind", "s.start", "s.end", "s.base")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``docs`` with its text (null: empty) and a key that is equal only for rows of the same id and text."""
    key, text = fresh(docs, "span_key", "span_text")
    body = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.withColumn(text, body).withColumn(
        key, F.concat_ws(":", F.col(f"`{id_col}`").cast("string"), F.sha2(body, 256))), key, text


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def span_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, spans (array of start, rank, kind, end, base; by start, then kind).

    A null text counts as empty and has no spans; repeated rows each get the
    same spans; null ids are treated like any other. Empty table: no rows.
    """
    rows, key, text = keyed(docs, id_col, text_col)
    found = spans(rows.select(F.col(key).alias("key"), F.col(text).alias("text")))
    gathered = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(
        "start", _rank(F.col("kind")).alias("rank"), "kind", "end", "base"))).alias("spans"))
    none = F.array().cast(gathered.schema["spans"].dataType)
    return (rows.select(F.col(f"`{id_col}`").alias(id_col), F.col(key).alias("key")).join(gathered, "key", "left")
                .select(id_col, F.coalesce("spans", none).alias("spans")))


def joined(spans_col: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None) -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets ([EMAIL]); spans that overlap, added ones too, are one, named by the first.

    A null text stays null, and all other columns stay as they are, except
    ``chars_col``, set to the new length where the text has changed.
    """
    rows, key, text = keyed(docs, id_col, text_col)
    found = spans(rows.select(F.col(key).alias("key"), F.col(text).alias("text")), overlapping=True)
    order = W.partitionBy("key").orderBy("start", _rank(F.col("kind")), "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    runs = found.withColumn("new", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int")).withColumn(
        "run", F.sum("new").over(order))
    whole = runs.groupBy("key", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"),
                                           F.min_by("kind", F.struct("start", _rank(F.col("kind")))).alias("kind"))
    prev, wide, gone = fresh(rows, "prev", "wide", "gone")
    whole = whole.withColumn("prev", F.coalesce(F.lag("end").over(W.partitionBy("key").orderBy("run")), F.lit(0)))
    gathered = whole.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "prev"))).alias(gone),
                                        F.max("end").alias(prev)).withColumnRenamed("key", f"{key}_")
    out = rows.join(gathered, F.col(key) == F.col(f"{key}_"), "left")
    # In UTF-32 a code point is four bytes: a slice costs its own length wherever it starts.
    out = out.withColumn(wide, F.when(F.col(gone).isNotNull(), F.encode(F.col(text), "UTF-32")))
    piece = lambda s: F.concat(F.decode(F.substring(F.col(wide), s["prev"].cast("int") * 4 + 1, (s["start"] - s["prev"]).cast("int") * 4), "UTF-32"),
                               F.lit("["), F.upper(s["kind"]), F.lit("]"))
    tail = F.decode(F.expr(f"substring(`{wide}`, int(`{prev}`) * 4 + 1)"), "UTF-32")
    clean = F.concat(F.array_join(F.transform(F.col(gone), piece), ""), tail)
    out = out.withColumn(text, F.when(F.col(gone).isNotNull(), clean))
    new = {text_col: F.coalesce(F.col(text), F.col(f"`{text_col}`"))}
    if chars_col:
        kind = docs.schema[chars_col].dataType
        new[chars_col] = F.when(F.col(text).isNotNull(), F.length(F.col(text)).cast(kind)).otherwise(F.col(f"`{chars_col}`"))
    return out.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
