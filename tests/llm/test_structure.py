"""Structure repair against a plain search over audits, whole and in segments."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import corpora

from equitylake.llm import queries, structure

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
LEGAL = re.compile(r"(s?(ua)+)?")
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def cheapest(rows):
    """(cost, audit, lines) of the best repair of (role, text, fault) rows: best first over whole strings."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, made, lines = heapq.heappop(heap)
        if i == len(rows) and LEGAL.fullmatch(made):
            return cost, audit, lines
        if (i, made[-1:], audit) in done:
            continue
        done.add((i, made[-1:], audit))
        steps = []
        if len(audit) < 3 * len(rows) + 3:
            steps += [("I", 2, i, r[0], f"{r}:") for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            steps.append(("D", 3, i + 1, "", None))
            if fault not in ("blank", "duplicate"):
                extra = int(fault == "truncated")
                steps.append(("K", extra, i + 1, role[:1], f"{role}:{text}"))
                steps += [("R", 2 + extra, i + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        for letter, more, to, initial, line in steps:
            if letter == "K" and not initial:
                continue
            if re.fullmatch(r"s?(ua)*u?", made + initial):
                heapq.heappush(heap, (cost + more, audit + letter, to, made + initial, lines if line is None else (*lines, line)))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return out


def expected(conv, rows):
    """A result row from damaged (turn, role, text) rows in order."""
    marked = faults([r[1:] for r in rows])
    kinds = [f for *_, f in marked]
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, *_), (b, *_) in itertools.pairwise(marked))
    cost, audit, lines = cheapest(marked)
    return (conv, gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(conv, rows):
    out = []
    for turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if d:
            row = (turn, "user" if d == 4 else role, "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text)
            out += [row] * (2 if d == 3 else 1)
    return out


def test_solver_is_cheapest_and_least(spark):
    kinds = [(r, f) for r in ("system", "user", "assistant", "") for f in ("", "blank", "truncated")]
    pick = random.Random(1)
    for rows in [*itertools.product(kinds, repeat=2), *(pick.choices(kinds, k=pick.randint(3, 5)) for _ in range(120))]:
        cost, audit, _ = cheapest([(r, "x", f) for r, f in rows])
        found, edges, end = structure.solve(structure._kinds([r for r, _ in rows], [f for _, f in rows]))
        assert (found, "".join(e[3] for e in edges) + end[2]) == (cost, audit)


def test_segments_chain_to_the_whole():
    pick = random.Random(2)
    for _ in range(200):
        kinds = tuple((pick.randrange(4), pick.random() < 0.2, pick.random() < 0.3) for _ in range(pick.randint(2, 14)))
        whole = structure.solve(kinds)
        size = pick.randint(1, 4)
        parts = [kinds[i:i + size] for i in range(0, len(kinds), size)]
        path = structure.chain([structure.table(p) for p in parts])
        found = [structure.solve(p, a, None if p is parts[-1] else b) for p, (a, b) in zip(parts, path)]
        assert sum(f[0] for f in found) == whole[0]
        assert [e for f in found for e in f[1]] == whole[1] and found[-1][2] == whole[2]


SAYS = ["Yes.", "No!", "and then", "", " \t", "Why? ", "é.", None]


def chats(seed, n=40):
    pick = random.Random(seed)
    return [(c, t if pick.random() < 0.9 else t + 3, pick.choice(["user", "assistant", "system", "tool", None, ""] if c % 2 else ["user", "assistant"]),
             pick.choice(SAYS) if pick.random() < 0.4 else f"Said {pick.randint(0, 9)}.") for c in range(n) for t in range(pick.randint(1, 7))]


def grouped(rows):
    found = {}
    for conv, *row in rows:
        found.setdefault(conv, []).append(tuple(row))
    return found


def as_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_matches_the_search(spark, scratch):
    rows = [r for r in chats(3) if r[1] is not None]
    one_a_turn = {(c, t): (c, t, r, x) for c, t, r, x in rows}  # ties have an order of their own
    rows = [*one_a_turn.values(), (90, None, "user", "Null turn."), (90, 5, "assistant", "Yes."), (91, 0, None, None),
            (None, 1, "user", "Nobody."), (None, 2, "assistant", "Else.")]
    corpora.write(spark.createDataFrame(rows, SCHEMA).repartition(3), scratch, "conversations")
    found = as_rows(queries.QUERIES["op12_structure"](spark, scratch))
    want = [expected(c, damage(c, sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0)))) for c, rs in grouped(rows).items()]
    assert found == sorted(want, key=str)


def test_long_conversation_in_small_segments(spark):
    pick = random.Random(5)
    rows = [(1, t, pick.choice(["user", "assistant"]), f"Said {pick.randint(0, 25)}{pick.choice(['.', ''])}") for t in range(40)]
    rows += [(2, t, "user", "Same.") for t in range(30)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    whole = structure.structure_report(df, df).collect()
    by_row = structure.repair_structure(df, segment=7)
    cut_up = {r["key"]: r for r in structure.report(by_row).collect()}
    for r in whole:
        assert tuple(r[c] for c in COLUMNS[1:]) == tuple(cut_up[f"c{r['conv_id']}"][c] for c in COLUMNS[1:])
    two = next(r for r in whole if r["conv_id"] == 2)
    assert two["duplicate"] == 29 and two["cost"] == 29 * 3 + 2 and two["audit"] == "K" + "D" * 29 + "I"


def test_empty_tables_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", key string, segment int")
    assert structure.structure_report(empty, empty).collect() == []
    df = spark.createDataFrame([(1, 0, "user", "Hi.", "k", 3), (1, 0, "user", "Hi.", "k", 3)], SCHEMA + ", key string, segment int")
    row = structure.structure_report(df, df.where("conv_id = 2")).collect()[0]
    assert tuple(row[c] for c in COLUMNS) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert as_rows(structure.structure_report(df, df)) == [expected(1, [(0, "user", "Hi.")] * 2)]


def test_very_long_text(spark):
    text = "word " * 200_000 + "end."
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], SCHEMA)
    assert as_rows(structure.structure_report(df, df)) == [expected(1, [(0, "user", text), (1, "assistant", text)])]
