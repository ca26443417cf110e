"""Operator 8, chat formatting with minimum-cost role repair.

A conversation is legal if it is [system] (user assistant)*. Each turn is
either emitted, under its own role or a changed one, with an empty turn put
before it where the automaton asks for one, or merged into the turn before it.
Every choice has a cost, and dynamic programming over the automaton's states
finds the cheapest repair; of equally cheap ones the one whose first differing
choice comes first in ``CHOICES`` is taken.

A conversation may hold any number of turns: turns are range-partitioned in
order and cut into segments of bounded length. A segment is summed up by the
least cost from each state to each state (and the order of those paths under
the tie rule); these small tables are chained along the conversation, and each
segment is then repaired on its own between the two states it was assigned.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equitylake.llm.common import cut, whole_groups

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
MERGE_COST, CHANGE_COST, EMPTY_COST = 1, 3, 2
SEGMENT_TURNS = 4096
FAR = 1 << 60
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"

#: (state, emitted role) -> the empty turns put before it; missing: not legal.
_BEFORE = {
    (START, SYSTEM): (), (START, USER): (), (SYSTEM, USER): (), (ASSISTANT, USER): (), (USER, ASSISTANT): (),
    (USER, USER): (ASSISTANT,), (START, ASSISTANT): (USER,), (SYSTEM, ASSISTANT): (USER,), (ASSISTANT, ASSISTANT): (USER,),
}
#: Empty turns after the last one, by the state it left.
_AFTER = {START: (), SYSTEM: (), USER: (ASSISTANT,), ASSISTANT: ()}
END_COST = tuple(EMPTY_COST * len(_AFTER[s]) for s in range(4))


def _choices(state: int, role: int) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(cost, next state, action, empty turns before) of a turn, in the order of the tie rule."""
    found = []
    for new in (role, *(r for r in (SYSTEM, USER, ASSISTANT) if r != role)):
        if (state, new) in _BEFORE:
            before = _BEFORE[state, new]
            found.append((EMPTY_COST * len(before) + CHANGE_COST * (new != role), new, "emit", before))
    if state != START:
        found.append((MERGE_COST + CHANGE_COST * (state != role), state, "merge", ()))
    return found


#: By state and own role (0: any other role); the first of equal cost wins.
CHOICES = [[_choices(s, r) for r in range(4)] for s in range(4)]


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.index(name) if name in ROLES[1:] else 0


def repair(roles: list[int], end: tuple[int, ...] = END_COST, start: int = START) -> tuple[int, list[tuple]]:
    """The least cost of the turns from state ``start``, given the cost ``end`` of each last state, and the choice for each turn."""
    after = list(end)
    best = []
    for role in reversed(roles):
        picks = []
        for s in range(4):
            costs = [c[0] + after[c[1]] for c in CHOICES[s][role]]
            k = min(range(len(costs)), key=costs.__getitem__)
            picks.append((costs[k], CHOICES[s][role][k]))
        after = [min(c, FAR) for c, _ in picks]
        best.append(picks)
    state, chosen = start, []
    for picks in reversed(best):
        choice = picks[state][1]
        chosen.append(choice)
        state = choice[1]
    return after[start], chosen


def summary(roles: list[int]) -> tuple[list[int], list[int]]:
    """Flat 4x4 tables of a segment: least cost from state to state, and the order of those paths under the tie rule."""
    cost = [[0 if s == t else FAR for t in range(4)] for s in range(4)]
    rank = [[0] * 4 for _ in range(4)]
    for role in reversed(roles):
        new_cost, new_rank = [], []
        for s in range(4):
            row, key = [], []
            for t in range(4):
                k, c = min(enumerate(CHOICES[s][role]), key=lambda kc: kc[1][0] + cost[kc[1][1]][t])
                row.append(min(FAR, c[0] + cost[c[1]][t]))
                key.append((k, rank[c[1]][t]))
            order = sorted(set(key))
            new_cost.append(row)
            new_rank.append([order.index(x) for x in key])
        cost, rank = new_cost, new_rank
    return sum(cost, []), sum(rank, [])


def chain(tables: list[tuple[list[int], list[int]]]) -> list[tuple[int, int]]:
    """(state before, state after) of each segment on the best path through all of them."""
    ends = [list(END_COST)]
    for cost, _ in reversed(tables):
        ends.append([min(FAR, min(cost[4 * s + t] + ends[-1][t] for t in range(4))) for s in range(4)])
    ends.reverse()
    state, path = START, []
    for (cost, rank), after in zip(tables, ends[1:]):
        to = min(range(4), key=lambda t: (cost[4 * state + t] + after[t], rank[4 * state + t]))
        path.append((state, to))
        state = to
    return path


# ------------------------------------------------------------------ tasks
def _numbered(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, with the segment each belongs to: (task, number in the task), and its place in it."""
    task, number, conv, size = TaskContext.get().partitionId(), 0, None, 0
    for batch in batches:
        numbers, places = [], []
        for key in batch.column(0).to_pylist():
            if key != conv or size >= segment:
                number, conv, size = number + 1, key, 0
            numbers.append(number)
            places.append(size)
            size += 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([(task << 40) + n for n in numbers]), pa.array(places, pa.int32())],
                                         names=[*batch.schema.names, "segment", "place"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, starts in whole_groups(batches, 1):
        roles = [role_number(r) for r in part.column(1).to_pylist()]
        ends = [*starts[1:].tolist(), part.num_rows]
        found = [summary(roles[s:e]) for s, e in zip(starts.tolist(), ends)]
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(starts)).combine_chunks(), pa.array([e - s for s, e in zip(starts.tolist(), ends)], pa.int64()),
             pa.array([c for c, _ in found], pa.list_(pa.int64())), pa.array([r for _, r in found], pa.list_(pa.int64()))],
            names=["segment", "n", "cost", "rank"])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, starts in whole_groups(batches, 1):
        rows = part.select(["segment", "n", "cost", "rank"]).to_pylist()
        out: dict = {"segment": [], "state": [], "to": [], "offset": [], "last": []}
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), part.num_rows]):
            own, offset = rows[s:e], 0
            for i, (r, (a, b)) in enumerate(zip(own, chain([(r["cost"], r["rank"]) for r in own]))):
                for name, x in zip(out, (r["segment"], a, b, offset, i == len(own) - 1)):
                    out[name].append(x)
                offset += r["n"]
        yield pa.RecordBatch.from_arrays([pa.array(out["segment"], pa.int64()), pa.array(out["state"], pa.int32()), pa.array(out["to"], pa.int32()),
                                          pa.array(out["offset"], pa.int64()), pa.array(out["last"], pa.bool_())], names=list(out))


def _turn(role: int, text: str = "") -> str:
    return f"{OPEN}{ROLES[role]}\n{text}"


def fragments(choices: list[tuple], texts: list[str | None], state: int, last: bool) -> list[str]:
    """The rendering of each turn; joined in order, over all segments, they are the rendered conversation."""
    out = []
    for (_, new, action, before), text in zip(choices, texts):
        body = (text or "").replace("<|", "< |")  # a text cannot open or close a turn
        if action == "merge":
            out.append(f"\n{body}")
        else:
            out.append((CLOSE if state != START else "") + "".join(_turn(r) + CLOSE for r in before) + _turn(new, body))
        state = new
    if last and out:
        out[-1] += CLOSE + "".join(_turn(r) + CLOSE for r in _AFTER[state])
    return out


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, starts in whole_groups(batches, 1):
        roles = [role_number(r) for r in part.column("role").to_pylist()]
        texts, states, to = (part.column(c).to_pylist() for c in ("text", "state", "to"))
        lasts, offsets = part.column("last").to_pylist(), part.column("offset").to_pylist()
        pos, new, action, inserted, cost, rendered = [], [], [], [], [], []
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), part.num_rows]):
            end = tuple(0 if t == to[s] else FAR for t in range(4))
            _, choices = repair(roles[s:e], end, states[s])
            pos += range(offsets[s], offsets[s] + e - s)
            new += [ROLES[c[1]] for c in choices]
            action += [c[2] for c in choices]
            inserted += [len(c[3]) for c in choices]
            cost += [c[0] for c in choices]
            if lasts[s]:
                inserted[-1] += len(_AFTER[to[s]])
                cost[-1] += END_COST[to[s]]
            rendered += fragments(choices, texts[s:e], states[s], lasts[s])
        conv, turn, role = (part.column(c).combine_chunks() for c in ("conv", "turn", "role"))
        yield pa.RecordBatch.from_arrays([conv, pa.array(pos, pa.int64()), turn, role, pa.array(new), pa.array(action), pa.array(inserted, pa.int32()),
                                          pa.array(cost, pa.int64()), pa.array(rendered, pa.string())],
                                         names=["conv", "pos", "turn", "role", "repaired_role", "action", "n_inserted", "cost", "fragment"])


# ------------------------------------------------------------------ operator
def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", segment: int = SEGMENT_TURNS) -> DataFrame:
    """Per turn: conversation, pos (from 0), turn, role, repaired_role, action, n_inserted, cost, fragment.

    Turns go by number (nulls first), ties by role, then the text's hash and
    the text. A null or unknown role is changed into a legal one at the cost
    of a change; a null text is empty; rows of a null conversation are one
    conversation; rows that repeat all stay. ``n_inserted`` counts the empty
    turns put before the turn, and after it if it is the conversation's last.
    A ``<|`` in a text is rendered ``< |``, so that no text opens or closes a turn.
    The fragments of a conversation, in the order of ``pos``, make up its
    rendering. An empty table gives no rows.
    """
    def own(c: str) -> Column:
        return F.col(f"`{c}`")

    rows = turns.select(F.coalesce(F.concat(F.lit("c"), own(conv_col).cast("string")), F.lit("")).alias("key"), own(conv_col).alias("conv"),
                        own(turn_col).alias("turn"), own(role_col).cast("string").alias("role"), own(text_col).cast("string").alias("text"),
                        F.xxhash64(own(text_col)).alias("h"))
    ordered = rows.repartitionByRange("key", "turn", "role", "h").sortWithinPartitions("key", "turn", "role", "h", "text")
    kind = rows.schema
    conv, turn = f"conv {kind['conv'].dataType.simpleString()}", f"turn {kind['turn'].dataType.simpleString()}"
    numbered = cut(ordered.mapInArrow(lambda b: _numbered(b, segment),
                                      f"key string, {conv}, {turn}, role string, text string, h bigint, segment bigint, place int"))
    sums = cut(numbered.select("segment", "role").mapInArrow(_summed, "segment bigint, n bigint, cost array<bigint>, rank array<bigint>"))
    heads = numbered.where("place = 0").select("segment", "key", "turn", "role", "h", "text")
    # Segments of a conversation in the order of their first turns; equal first turns come from one task, in its order.
    in_order = (sums.join(heads, "segment").repartition("key").sortWithinPartitions("key", "turn", "role", "h", "text", "segment")
                    .select("key", "segment", "n", "cost", "rank"))
    states = in_order.mapInArrow(_chained, "segment bigint, state int, to int, offset bigint, last boolean")
    each = (numbered.join(states, "segment").repartition("segment").sortWithinPartitions("segment", "place")
                    .select("segment", "conv", "turn", "role", "text", "state", "to", "offset", "last"))
    out = each.mapInArrow(_repaired, f"{conv}, pos bigint, {turn}, role string, repaired_role string, action string, "
                                     "n_inserted int, cost bigint, fragment string")
    return out.withColumnRenamed("conv", conv_col)
