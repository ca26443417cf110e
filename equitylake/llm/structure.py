"""Operator 12, conversation structure repair by scalar big-integer weights.

A repaired conversation is (s?(ua)+)? in its roles' initials. Each row is
kept, given another role or deleted, and empty turns may be inserted anywhere.
The edits form a DAG over (row, last role): an edge inserts up to two turns
and edits a row. Its weight is one integer: the cost in the high digits, and
below, in the place of the row, a slot of fixed width for the letters of its
edits, zeros at the end of the slot where there are fewer. No slot of a row
is another's beginning (each ends at its first letter that is no insertion),
so comparing slots in order compares the whole audits, and the ordinary
minimum of sums of weights is the cheapest repair, of equals the one whose
audit is least. One audit stands for one repair.

Conversations may be of any length: rows are ordered over tasks and cut into
segments (``turns``). A segment of a longer conversation is summed up by its
least weight from each state to each state, these tables are chained along the
conversation, and each segment is repaired between its two states.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equitylake.llm.common import BROADCAST_ROWS, cut, looked_up, whole_groups
from equitylake.llm.turns import BLANKS, SEGMENT_TURNS, in_order, long_ones

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: By state: the role an inserted or changed turn takes.
_NEXT = (USER, USER, ASSISTANT, USER)
_LEGAL = ("su", "ua", "au")
DELETE, INSERT, KEEP, CHANGE = "DIKR"
CHANGE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: A slot's letters, in base 8 by their ASCII order, zero for none.
SLOT_LETTERS, LETTER_BITS = 3, 3
SLOT_BITS = SLOT_LETTERS * LETTER_BITS


def _slot(letters: str) -> int:
    return sum((1 + "DIKR".index(c)) << LETTER_BITS * (SLOT_LETTERS - 1 - i) for i, c in enumerate(letters))


def _inserted(state: int, n: int) -> tuple[int, list[int]]:
    """The state after ``n`` insertions, and their roles."""
    roles = []
    for _ in range(n):
        state = _NEXT[state]
        roles.append(state)
    return state, roles


def _edges(state: int, kind: tuple[int, bool, bool]) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(cost, slot, next state, letters, roles put before) of every way to edit a row of ``kind`` (role by initial, must go, truncated)."""
    role, must_go, truncated = kind
    found = []
    for n in range(SLOT_LETTERS):
        at, before = _inserted(state, n)
        ways = [(DELETE, DELETE_COST, at)]
        if not must_go:
            extra = TRUNCATED_COST * truncated
            if role and (role == _NEXT[at] or (role == SYSTEM and at == START)):
                ways.append((KEEP, extra, role))
            ways.append((CHANGE, CHANGE_COST + extra, _NEXT[at]))
        found += [(INSERT_COST * n + cost, _slot(INSERT * n + letter), to, INSERT * n + letter, tuple(before)) for letter, cost, to in ways]
    return found


_EDGES = {(s, (r, g, t)): _edges(s, (r, g, t)) for s in range(4) for r in range(4) for g in (False, True) for t in (False, True)}
#: By last state: (cost, slot, letters, roles) of the insertions that end a conversation legally.
_ENDS = [[(INSERT_COST * n, _slot(INSERT * n), INSERT * n, tuple(_inserted(s, n)[1])) for n in range(SLOT_LETTERS)
          if _inserted(s, n)[0] in (START, ASSISTANT)] for s in range(4)]


def _swept(kinds, last: list[int | None]) -> tuple[list[int | None], list[list]]:
    """The least weight from each state before the first row, and each row's best edge by state; ``last`` is the weight after the last row."""
    top = SLOT_BITS * (len(kinds) + 1)  # one slot more, for the insertions at the end
    after, best = last, []
    for back, kind in enumerate(reversed(kinds), 1):
        now, picks = [], []
        for s in range(4):
            least, pick = None, None
            for edge in _EDGES[s, kind]:
                rest = after[edge[2]]
                if rest is not None:
                    weight = (edge[0] << top) + (edge[1] << SLOT_BITS * back) + rest
                    if least is None or weight < least:
                        least, pick = weight, edge
            now.append(least)
            picks.append(pick)
        after = now
        best.append(picks)
    return after, best[::-1]


def solve(kinds, start: int = START, to: int | None = None) -> tuple[int, list[tuple], tuple]:
    """(cost, edge of each row, end) of the best repair of rows from state ``start`` to the end, or else to state ``to`` of a row that goes on."""
    top = SLOT_BITS * (len(kinds) + 1)
    if to is None:
        ends = [min(_ENDS[s]) if _ENDS[s] else None for s in range(4)]
        last = [None if e is None else (e[0] << top) + e[1] for e in ends]
    else:
        ends = [(0, 0, "", ())] * 4
        last = [0 if s == to else None for s in range(4)]
    weights, best = _swept(kinds, last)
    state, chosen = start, []
    for picks in best:
        chosen.append(picks[state])
        state = picks[state][2]
    return weights[start] >> top, chosen, ends[state]


@lru_cache(maxsize=65_536)
def _solved(kinds: tuple, start: int, to: int | None):
    return solve(kinds, start, to)


def table(kinds) -> tuple[list[int], list[int]]:
    """Flat 4x4 tables of a segment: least cost from state to state (-1: none), and the order of the audits from one state."""
    top = SLOT_BITS * (len(kinds) + 1)
    by_end = [_swept(kinds, [0 if s == t else None for s in range(4)])[0] for t in range(4)]
    costs, ranks = [], []
    for s in range(4):
        row = [by_end[t][s] for t in range(4)]
        audits = sorted({w & ((1 << top) - 1) for w in row if w is not None})
        costs += [-1 if w is None else w >> top for w in row]
        ranks += [-1 if w is None else audits.index(w & ((1 << top) - 1)) for w in row]
    return costs, ranks


def chain(tables: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """(state before, state after) of each segment on the best way through all; audits from one state to two differ, so ranks decide ties."""
    ahead: list[list[int | None]] = [[min(_ENDS[s])[0] if _ENDS[s] else None for s in range(4)]]
    for cost, _ in reversed(tables):
        ways = [[cost[4 * s + t] + ahead[-1][t] for t in range(4) if cost[4 * s + t] >= 0 and ahead[-1][t] is not None] for s in range(4)]
        ahead.append([min(w, default=None) for w in ways])
    ahead.reverse()
    state, path = START, []
    for (cost, rank), after in zip(tables, ahead[1:]):
        to = min((t for t in range(4) if cost[4 * state + t] >= 0 and after[t] is not None),
                 key=lambda t: (cost[4 * state + t] + after[t], rank[4 * state + t]))
        path.append((state, to))
        state = to
    return path


# ------------------------------------------------------------------ tasks
def _initial(role: str) -> int:
    return {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(role[:1], 0)


def _kinds(roles: list[str], faults: list[str]) -> tuple:
    return tuple((_initial(r), f in ("blank", "duplicate"), f == "truncated") for r, f in zip(roles, faults))


def _ranges(part: pa.Table, starts):
    return zip(starts.tolist(), [*starts[1:].tolist(), part.num_rows])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, starts in whole_groups(batches, 1):
        roles, faults = (part.column(c).to_pylist() for c in ("role", "fault"))
        found = [table(_kinds(roles[s:e], faults[s:e])) for s, e in _ranges(part, starts)]
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(starts)).combine_chunks(), pa.array([c for c, _ in found], pa.list_(pa.int64())),
             pa.array([r for _, r in found], pa.list_(pa.int64())), pa.array([roles[e - 1] for _, e in _ranges(part, starts)], pa.string())],
            names=["segment", "cost", "rank", "final"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, starts in whole_groups(batches, 1):
        rows = part.to_pylist()
        out: dict = {"segment": [], "n": [], "offset": [], "state": [], "to": [], "previous": [], "late": []}
        for s, e in _ranges(part, starts):
            previous = None
            for row, (state, to) in zip(rows[s:e], chain([(r["cost"], r["rank"]) for r in rows[s:e]])):
                values = (row["segment"], row["n"], row["offset"], state, None if row["last"] else to, previous, row["late"] or [])
                for name, x in zip(out, values):
                    out[name].append(x)
                previous = row["final"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, starts in whole_groups(batches, 1):
        roles, texts, faults = (part.column(c).to_pylist() for c in ("role", "text", "fault"))
        states, to, offsets, previous, lates = (part.column(c).to_pylist() for c in ("state", "to", "offset", "previous", "late"))
        out: dict = {c: [] for c in ("pos", "fault", "illegal", "audit", "cost", "repaired_role", "lines")}
        for s, e in _ranges(part, starts):
            for i in lates[s] or []:
                faults[s + i] = "duplicate"
            single = states[s] is None
            _, edges, end = _solved(_kinds(roles[s:e], faults[s:e]), START if single else states[s], None if single else to[s])
            before = previous[s]
            for i, edge in zip(range(s, e), edges):
                letter, role = edge[3][-1], None
                if letter == KEEP:
                    role = roles[i]
                elif letter == CHANGE:
                    role = ROLES[edge[2]]
                lines = [f"{ROLES[r]}:" for r in edge[4]] + ([] if role is None else [f"{role}:{texts[i]}"])
                last = i == e - 1
                out["pos"].append((offsets[s] or 0) + i - s)
                out["fault"].append(faults[i])
                out["illegal"].append(before is not None and before[:1] + roles[i][:1] not in _LEGAL)
                out["audit"].append(edge[3] + (end[2] if last else ""))
                out["cost"].append(edge[0] + (end[0] if last else 0))
                out["repaired_role"].append(role)
                out["lines"].append(lines + [f"{ROLES[r]}:" for r in end[3]] if last else lines)
                before = roles[i]
        kinds = (pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.list_(pa.string()))
        own = [part.column(c).combine_chunks() for c in ("key", "conv", "turn", "role", "text")]
        yield pa.RecordBatch.from_arrays([*own, *(pa.array(v, k) for v, k in zip(out.values(), kinds))],
                                         names=["key", "conv", "turn", "role", "text", *out])


# ------------------------------------------------------------------ operator
def repair_structure(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                     segment: int = SEGMENT_TURNS) -> DataFrame:
    """Per turn: key (names the conversation, never null), conv, turn, role, text, pos, fault, illegal, audit, cost, repaired_role, lines.

    Turns go by number, nulls first, ties by role, then the text's hash and
    the text; rows that repeat are turns of their own. A null role or text is
    one space. Rows of a null conversation are one conversation. ``fault`` is
    the first of blank, duplicate (of an earlier row's role and text),
    truncated, or empty. ``illegal``: the roles before and here do not follow
    each other. ``audit`` holds the letters of the insertions before the row
    and of its edit, at the last row those after it too; ``repaired_role`` is
    null for a deleted row; ``lines`` are the repaired ``role:text`` turns it
    leaves. In the order of ``pos`` audits and lines join to the repaired
    conversation. An empty table gives no rows.
    """
    def own(c: str) -> Column:
        return F.col(f"`{c}`")

    role, text = (F.coalesce(own(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    rows = (turns.select(F.coalesce(F.concat(F.lit("c"), own(conv_col).cast("string")), F.lit("")).alias("key"), own(conv_col).alias("conv"),
                         own(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
                 .withColumn("h", F.xxhash64("text"))
                 .withColumn("said", F.when(trimmed != "", F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))))
    fault = (F.when(trimmed == "", "blank").when(F.col("again"), "duplicate")
              .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated").otherwise(""))
    numbered = cut(in_order(rows, ["turn", "role", "h", "text"], "said", segment)
                   .select("key", "segment", "place", "conv", "turn", "role", "text", "said", fault.alias("fault")))
    # Conversations in several segments: rows that an earlier segment holds, then the best way through the segments.
    parts = cut(long_ones(numbered))
    narrow = numbered.join(parts.select("segment", "n"), "segment").select("key", "segment", "place", "role", "said", "fault", "n")
    narrow = cut(narrow)
    first = Window.partitionBy("key", "said").orderBy("segment")
    late = (narrow.where("said is not null and fault <> 'duplicate'").select("key", "said", "segment", "place")
                  .withColumn("nth", F.row_number().over(first)).where("nth > 1")
                  .groupBy("segment").agg(F.collect_list("place").alias("late")))
    late = cut(late)
    judged = (narrow.join(late, "segment", "left")
                    .select("segment", "place", "role", F.when(F.array_contains("late", F.col("place")), "duplicate").otherwise(F.col("fault")).alias("fault")))
    sums = judged.repartition("segment").sortWithinPartitions("segment", "place").mapInArrow(
        _summed, "segment bigint, cost array<bigint>, rank array<bigint>, final string")
    in_row = (parts.join(sums, "segment").join(late, "segment", "left").repartition("key").sortWithinPartitions("key", "segment")
                   .select("key", "segment", "n", "offset", "last", "cost", "rank", "final", "late"))
    states = cut(in_row.mapInArrow(_chained, "segment bigint, n bigint, offset bigint, state int, `to` int, previous string, late array<int>"))
    each = looked_up(numbered.drop("said"), states, "segment", "n", segment, ["key", "place"])
    if states.count() > BROADCAST_ROWS:  # else the rows of a segment still stand together, in order
        each = each.repartition("segment").sortWithinPartitions("segment", "place")
    each = each.select(
        "segment", "key", "conv", "turn", "role", "text", "fault", "offset", "state", "to", "previous", "late")
    kind = rows.schema
    conv, turn = (f"{c} {kind[c].dataType.simpleString()}" for c in ("conv", "turn"))
    return each.mapInArrow(_repaired, f"key string, {conv}, {turn}, role string, text string, pos bigint, fault string, illegal boolean, "
                                      "audit string, cost bigint, repaired_role string, lines array<string>")


def _reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    key, counts, audit, state, turns = None, {}, [], None, [None, None, 0]

    def result():
        low, high, distinct = turns
        gaps = 0 if low is None else high - low + 1 - distinct
        return (key, gaps, *(counts[c] for c in names[2:7]), "".join(audit), state.hexdigest())

    def out(rows):
        kinds = (pa.string(), *[pa.int64()] * 6, pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

    for batch in batches:
        done = []
        for k, turn, fault, illegal, letters, cost, lines in zip(*(batch.column(c).to_pylist() for c in (
                "key", "turn", "fault", "illegal", "audit", "cost", "lines"))):
            if state is None or k != key:
                if state is not None:
                    done.append(result())
                key, counts, audit, state, turns, empty = k, dict.fromkeys(names[2:7], 0), [], hashlib.sha256(), [None, None, 0], True
            if fault:
                counts[fault] += 1
            counts["illegal"] += illegal
            counts["cost"] += cost
            audit.append(letters)
            if turn is not None and turn != turns[1]:  # turns come in order
                turns = [turn if turns[0] is None else turns[0], turn, turns[2] + 1]
            for line in lines:
                state.update(("" if empty else "\n").encode() + line.encode("utf-8", "surrogatepass"))
                empty = False
        if done:
            yield out(done)
    if state is not None:
        yield out([result()])


def report(repaired: DataFrame) -> DataFrame:
    """Per conversation of ``repair_structure``: key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A conversation's turns stream in order through one hash, as its digest
    demands; of its rows only the audit, a few letters each, is held.
    """
    rows = (repaired.select("key", "pos", F.col("turn").cast("bigint").alias("turn"), "fault", "illegal", "audit", "cost", "lines")
                    .repartition("key").sortWithinPartitions("key", "pos"))
    return rows.mapInArrow(_reported, "key string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                                      "cost bigint, audit string, repaired_sha256 string")


def structure_report(convs: DataFrame, turns: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """``report`` of ``turns`` for every conversation of ``convs``; one without turns has zeros, an empty audit and the digest of nothing."""
    key = F.coalesce(F.concat(F.lit("c"), F.col(f"`{conv_col}`").cast("string")), F.lit(""))
    every = convs.select(F.col(f"`{conv_col}`").alias(conv_col), key.alias("key")).distinct()
    found = every.join(report(repair_structure(turns, conv_col)), "key", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(conv_col, *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def damaged(turns: DataFrame, of: int = 20) -> DataFrame:
    """(conv_id, turn, role, text) of ``turns`` with faults by d = crc32("conv_id:turn") % ``of``, a null being one space everywhere.

    0 drops the row, 1 empties its text, 2 takes the ``.!?`` out of it, 3
    repeats the row, 4 makes its role user.
    """
    spaced = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    d = F.col("d")
    return (turns.select("conv_id", "turn", spaced["role"].alias("role"), spaced["text"].alias("text"),
                         (F.crc32(F.concat(spaced["conv_id"], F.lit(":"), spaced["turn"])) % of).alias("d"))
                 .where(d != 0)
                 .select("conv_id", "turn", F.when(d == 4, "user").otherwise(F.col("role")).alias("role"),
                         F.when(d == 1, "").when(d == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                         F.explode(F.when(d == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
                 .drop("copy"))
