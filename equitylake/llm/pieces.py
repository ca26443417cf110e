"""Operator 9, SentencePiece encoding and decoding.

The pieces of a public SentencePiece model form an Aho-Corasick automaton.
One pass over a text reports, at each position, every piece that ends there
(the automaton's output links); each relaxes the best score of its end from
the best score of its start, so the last position holds the best total score
and the way back gives the pieces. Of equal scores the longer last piece wins.
A character that is no piece itself may be spelt by byte pieces.

No piece of such a model has a space mark after another character, or a line
end, so a text falls into independent stretches at line ends and before each
space mark that follows another character; stretches met of late are
remembered, up to a bound. A batch of texts is cut into stretches, its distinct
stretches found and their ids put back in place by Arrow kernels; the pass over
the automaton runs for a stretch that is not remembered. Decoding is a gather
of the pieces' bytes and gives back exactly the text encoded.
"""

from __future__ import annotations

import itertools
import re
from array import array
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitylake.llm.common import fresh, only

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
REMEMBERED = 400_000
#: Longer stretches are neither remembered nor found together with others.
REMEMBERED_CHARS = 64
#: Between the stretches of a batch's texts; a text that holds it is encoded by itself.
_CUT = "\x00"
#: Texts are cut by Arrow in lots of at most so many bytes (a longer one alone, in plain Python).
LOT_BYTES = 4 << 20
#: A byte piece costs this much more than the worst piece.
BYTE_COST = 10.0
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>$")


@dataclass(frozen=True)
class PieceModel:
    """Pieces by id, their scores, and what each is: n normal, b byte, x never matched (control, unknown, unused)."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str

    @classmethod
    def load(cls, path: str = MODEL) -> PieceModel:
        """Read a model file with the public library (on the driver; tasks get the pieces)."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(sp.get_piece_size())
        kinds = "".join("b" if sp.is_byte(i) else "x" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "n" for i in ids)
        return cls(tuple(sp.id_to_piece(i) for i in ids), tuple(sp.get_score(i) for i in ids), kinds)

    @cached_property
    def byte_ids(self) -> list[int]:
        found = {int(_BYTE_PIECE.match(p)[1], 16): i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == "b"}
        if len(found) != 256:
            raise ValueError("the model has no full set of byte pieces")
        return [found[b] for b in range(256)]

    @cached_property
    def byte_score(self) -> float:
        return min(s for s, k in zip(self.scores, self.kinds) if k == "n") - BYTE_COST

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, (piece, kind) in enumerate(zip(self.pieces, self.kinds)):
            if kind == "n":
                made.add_word(piece, i)
        made.make_automaton()
        return made

    @cached_property
    def machine(self) -> Machine:
        return Machine([(p, i) for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == "n"])

    @cached_property
    def lengths(self) -> list[int]:
        return [len(p) for p in self.pieces]

    @cached_property
    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and scores by id."""
        return np.array(self.lengths, np.int64), np.array(self.scores, np.float64)

    @cached_property
    def characters(self) -> frozenset[str]:
        """The characters that are pieces themselves."""
        return frozenset(p for p, k in zip(self.pieces, self.kinds) if k == "n" and len(p) == 1)

    @cached_property
    def falls_apart(self) -> bool:
        """Whether no piece spans the cuts between stretches."""
        return not any(MARK in p.lstrip(MARK) or "\n" in p or _CUT in p for p, k in zip(self.pieces, self.kinds) if k == "n")

    @cached_property
    def octets(self) -> list[bytes]:
        """What each id decodes to, marks as spaces; ids that are never matched decode to nothing."""
        return [p.replace(MARK, " ").encode() if k == "n" else bytes([int(_BYTE_PIECE.match(p)[1], 16)]) if k == "b" else b""
                for p, k in zip(self.pieces, self.kinds)]


def best_pieces(model: PieceModel, text: str) -> list[int]:
    """The ids of the best segmentation of a marked text (no mark of its own left in it)."""
    n = len(text)
    lengths, scores = model.lengths, model.scores
    best, back, piece = [0.0] + [float("-inf")] * n, [0] * (n + 1), [-1] * (n + 1)
    spelt = [] if model.characters.issuperset(text) else [k for k, c in enumerate(text) if c not in model.characters]
    at = 0  # of the characters to spell, those before the position reached are done

    def spell(upto: int) -> None:
        nonlocal at
        while at < len(spelt) and spelt[at] < upto:
            k = spelt[at]
            at += 1
            score = best[k] + model.byte_score * len(text[k].encode("utf-8", "surrogatepass"))
            if score > best[k + 1]:
                best[k + 1], back[k + 1], piece[k + 1] = score, k, -1

    for end, i in model.automaton.iter(text):  # by end; of one end the longest first
        start = end + 1 - lengths[i]
        if spelt:
            spell(end)
        total = best[start] + scores[i]
        if total > best[end + 1]:
            best[end + 1], back[end + 1], piece[end + 1] = total, start, i
    spell(n)
    ids: list[int] = []
    while n:
        start, i = back[n], piece[n]
        ids += [i] if i >= 0 else [model.byte_ids[b] for b in reversed(text[start:n].encode("utf-8", "surrogatepass"))]
        n = start
    return ids[::-1]


class Machine:
    """The same automaton as arrays, to run many texts through at once.

    A state is a beginning of a piece, 0 the empty one. ``keys`` and
    ``targets`` are an open hash table of the transitions, (state, character)
    -> state; ``fails`` leads to the longest proper end of a state that is a
    state, ``own`` is the piece a state spells (-1: none) and ``links`` the
    output link, to the longest proper end that is a piece (0: none).
    """

    def __init__(self, pieces: list[tuple[str, int]]):
        letters = sorted({c for p, _ in pieces for c in p})
        self.codes = np.full(0x110000, -1, np.int64)
        self.codes[[ord(c) for c in letters]] = np.arange(len(letters))
        code = {c: k for k, c in enumerate(letters)}
        self.width = len(letters)
        steps: dict[int, int] = {}
        own, parents, by = [-1], [0], [0]
        for piece, i in pieces:
            state = 0
            for c in piece:
                key = state * self.width + code[c]
                state = steps.get(key)
                if state is None:
                    steps[key] = state = len(own)
                    parents.append(key // self.width)
                    by.append(key % self.width)
                    own.append(-1)
            own[state] = i
        depth = [0] * len(own)
        for s in range(1, len(own)):  # a state comes after its parent
            depth[s] = depth[parents[s]] + 1
        fails, links = [0] * len(own), [0] * len(own)
        for s in sorted(range(1, len(own)), key=depth.__getitem__):
            if depth[s] > 1:
                f, c = fails[parents[s]], by[s]
                while f and f * self.width + c not in steps:
                    f = fails[f]
                fails[s] = steps.get(f * self.width + c, 0)
            links[s] = fails[s] if own[fails[s]] >= 0 else links[fails[s]]
        self.own, self.fails, self.links = (np.array(x, np.int64) for x in (own, fails, links))
        self.bits = max(4, (4 * len(steps)).bit_length())
        self.keys, self.targets = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        keys, targets = np.fromiter(steps.keys(), np.int64), np.fromiter(steps.values(), np.int64)
        at = self._slot(keys)
        while len(keys):  # each round the first comer takes a free slot, the others try the next one
            free = np.flatnonzero(self.keys[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            taken = free[first]
            self.keys[at[taken]], self.targets[at[taken]] = keys[taken], targets[taken]
            left = np.ones(len(keys), bool)
            left[taken] = False
            keys, targets, at = keys[left], targets[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The transitions that exist, -1 elsewhere."""
        keys = states * self.width + codes
        at = self._slot(keys)
        held = self.keys[at]
        out = np.where(held == keys, self.targets[at], -1)
        more = np.flatnonzero((held != keys) & (held >= 0))
        while len(more):
            at[more] = (at[more] + 1) & ((1 << self.bits) - 1)
            held = self.keys[at[more]]
            same = held == keys[more]
            out[more[same]] = self.targets[at[more[same]]]
            more = more[~same & (held >= 0)]
        return out

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after one more character each, by failure links where there is no transition."""
        out = self._step(states, codes)
        lost = np.flatnonzero(out < 0)
        while len(lost):
            back = states[lost]
            out[lost[back == 0]] = 0
            lost = lost[back > 0]
            states = states.copy()
            states[lost] = self.fails[states[lost]]
            out[lost] = self._step(states[lost], codes[lost])
            lost = lost[out[lost] < 0]
        return out


def best_many(model: PieceModel, texts: list[str]) -> list[bytes]:
    """``best_pieces`` of many marked texts whose characters are all pieces, packed: the automaton reads them side by side.

    At each place the output links of the states reached give the pieces that
    end there, the longest first, which relax the place's best score.
    """
    machine, (lengths, scores) = model.machine, model.arrays
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    codes = machine.codes[np.frombuffer((_CUT.join(texts) + _CUT).encode("utf-32-le"), np.uint32)]
    best, via = np.zeros(len(codes) + 1), np.full(len(codes) + 1, -1)
    rows = np.argsort(-sizes, kind="stable")  # those that go on are always the first
    sorted_starts, going = starts[rows], np.searchsorted(-sizes[rows], -np.arange(sizes.max(initial=0)), side="left")
    states = np.zeros(len(texts), np.int64)
    for place, n in enumerate(going.tolist()):
        at = sorted_starts[:n] + place
        states[:n] = now = machine.step(states[:n], codes[at])
        ends, out = at + 1, np.where(machine.own[now] >= 0, now, machine.links[now])
        top, by = np.full(n, -np.inf), np.full(n, -1)
        live = np.flatnonzero(out)
        while len(live):
            ids = machine.own[out[live]]
            total = best[ends[live] - lengths[ids]] + scores[ids]
            better = total > top[live]
            top[live[better]], by[live[better]] = total[better], ids[better]
            out[live] = machine.links[out[live]]
            live = live[out[live] > 0]
        best[ends], via[ends] = top, by
    here, left = starts + sizes, np.flatnonzero(sizes)
    texts_of, pieces_of = [], []
    while len(left):
        i = via[here[left]]
        texts_of.append(left)
        pieces_of.append(i)
        here[left] -= lengths[i]
        left = left[here[left] > starts[left]]
    if not texts_of:
        return [b""] * len(texts)
    of, got = np.concatenate(texts_of[::-1]), np.concatenate(pieces_of[::-1])
    order = np.argsort(of, kind="stable")  # the way back, turned round
    packed = got[order].astype(np.int32).tobytes()
    upto = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(texts))))) * 4
    return [packed[a:b] for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]


_STRETCH = re.compile(" *[^ ]+| +", re.S)


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class _Known(dict):
    """Stretch -> packed ids, found out when first asked for.

    Two generations of at most ``bound`` stretches are kept: a full young one
    becomes the old one, from which a stretch that is met again is taken back.
    """

    def __init__(self, model: PieceModel, bound: int):
        super().__init__()
        self.model, self.bound, self.old = model, bound, {}

    def __missing__(self, stretch: str) -> bytes:
        ids = self.old.get(stretch)
        if ids is None:
            ids = _packed(best_pieces(self.model, stretch.replace(" ", MARK)))
        self._keep(stretch, ids)
        return ids

    def _keep(self, stretch: str, ids: bytes) -> None:
        if len(stretch) <= REMEMBERED_CHARS:
            if len(self) >= self.bound:
                self.old = dict(self)
                self.clear()
            self[stretch] = ids

    def all(self, stretches: list[str]) -> list[bytes]:
        """The packed ids of many stretches; those that are not remembered are found together."""
        out = list(map(self.get, stretches))
        new = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            out[k] = ids = self.old.get(stretches[k])
            if ids is None:
                new.append(k)
            else:
                self._keep(stretches[k], ids)
        odd = set().union(*(stretches[k] for k in new)) - self.model.characters - {" "}
        plain = [k for k in new if len(stretches[k]) <= REMEMBERED_CHARS and (not odd or odd.isdisjoint(stretches[k]))]
        for k, ids in zip(plain, best_many(self.model, [stretches[k].replace(" ", MARK) for k in plain])):
            out[k] = ids
            self._keep(stretches[k], ids)
        for k in new:
            if out[k] is None:
                out[k] = self[stretches[k]]
        return out


class Encoder:
    """Encodes texts with a model, remembering stretches met of late."""

    def __init__(self, model: PieceModel, remembered: int = REMEMBERED):
        self.model, self.known = model, _Known(model, remembered)
        self.mark, self.line_end = _packed([model.byte_ids[b] for b in MARK.encode()]), _packed([model.byte_ids[10]])

    def _line(self, line: str) -> bytes:
        """The packed ids of a text in which spaces are the only marks to be."""
        if not self.model.falls_apart:
            return _packed(best_pieces(self.model, line.replace(" ", MARK)))
        stretches = _STRETCH.findall(line) if "  " in line else line.replace(" ", "\n ").split("\n")
        return b"".join(map(self.known.__getitem__, stretches))

    def packed(self, text: str) -> bytes:
        """Ids of a whole text as 32-bit integers; an empty text has none. A space mark in the text itself is spelt by bytes."""
        if not text:
            return b""
        lines = (self.line_end.join(map(self._line, part.split("\n"))) if self.model.falls_apart else self._line(part)
                 for part in (" " + text).split(MARK))
        return self.mark.join(lines)

    def encode(self, text: str) -> list[int]:
        return array("i", self.packed(text)).tolist()

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids in order); a null text has none."""
        counts, flat = np.zeros(len(texts), np.int64), []
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        odd = sizes > LOT_BYTES
        odd |= pc.fill_null(pc.starts_with(texts, " "), False).to_numpy(zero_copy_only=False)
        for sign in (MARK, "  ", _CUT):  # rare: marks, stretches that begin with several spaces
            odd |= pc.fill_null(pc.match_substring(texts, sign), False).to_numpy(zero_copy_only=False)
        if not self.model.falls_apart:
            odd[:] = True
        start = 0
        while start < len(texts):
            if odd[start]:
                packed = np.frombuffer(self.packed(texts[start].as_py() or ""), np.int32)
                counts[start] = len(packed)
                flat.append(packed)
                start += 1
                continue
            end, room = start, LOT_BYTES
            while end < len(texts) and not odd[end] and (end == start or sizes[end] <= room):
                room -= sizes[end]
                end += 1
            counts[start:end], ids = self._lot(texts.slice(start, end - start), sizes[start:end])
            flat.append(ids)
            start = end
        return counts, np.concatenate(flat) if flat else np.empty(0, np.int32)

    def _lot(self, texts: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spaced = pc.binary_join_element_wise(" ", pc.fill_null(texts, ""), "")
        spaced = pc.replace_substring(pc.replace_substring(spaced, "\n", f"{_CUT}\n{_CUT}"), " ", f"{_CUT} ")
        parts = pc.split_pattern(spaced, _CUT)
        words = parts.flatten().dictionary_encode()
        packed = self.known.all(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        lengths = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
        each = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), pa.array(np.frombuffer(b"".join(packed), np.int32)))
        places = words.indices
        upto = np.concatenate(([0], np.cumsum(lengths[places.to_numpy()])))
        ends = upto[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        counts, ids = np.diff(ends), each.take(places).flatten().to_numpy()
        if (sizes == 0).any():  # an empty text has no ids, not those of the space put first
            keep = np.repeat(sizes > 0, counts)
            ids, counts = ids[keep], np.where(sizes > 0, counts, 0)
        return counts, ids

    def decode(self, ids) -> str:
        """The text of ``ids``; the space that encoding puts first is taken off, bytes that are no UTF-8 are replaced."""
        octets = b"".join(map(self.model.octets.__getitem__, ids))
        return octets[octets.startswith(b" "):].decode("utf-8", "replace")

    @cached_property
    def _gather(self) -> pa.Array:
        """The bytes of each id, then those of each id as the first of a text."""
        octets = self.model.octets
        return pa.array([*octets, *(o[o.startswith(b" "):] for o in octets)], pa.large_binary())

    def texts(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """The texts of the lists that ``offsets`` cut ``ids`` into, all valid ids of the model."""
        n = len(self.model.pieces)
        starts = offsets[:-1][offsets[1:] > offsets[:-1]]
        moved = ids.astype(np.int64)
        moved[starts] += n
        if any(not self.model.octets[i] for i in np.unique(ids[starts])):
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.string())
        octets = self._gather.take(pa.array(moved))
        at = np.frombuffer(octets.buffers()[1], np.int64, len(octets) + 1)[offsets]
        found = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(at.astype(np.int64)), octets.buffers()[2])
        try:
            found.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are no UTF-8
            return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.string())
        return found.cast(pa.string())


_ENCODERS: dict = {}


def _encoder(held) -> Encoder:
    """One encoder for each model in a worker, so that tasks share what it remembers."""
    key = id(held.value)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(held.value)
    return _ENCODERS[key]


def encode(docs: DataFrame, model: PieceModel, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """``docs`` with the ids of its whole texts (array<int>; null for a null text). The new column takes a free name."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: pa.Array) -> pa.Array:
        counts, flat = _encoder(held).batch(texts)
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=texts.is_null())

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return docs.withColumn(fresh(docs, ids_col)[0], F.arrow_udf(run, "array<int>")(F.col(f"`{text_col}`")))


def decode(docs: DataFrame, model: PieceModel, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the texts of its ids (null for null; ids that are null or not the model's decode to nothing). The new column takes a free name."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(lists: pa.Array) -> pa.Array:
        n = len(held.value.pieces)
        ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)  # without those of null lists
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        good = (ids >= 0) & (ids < n)
        upto = np.concatenate(([0], np.cumsum(good)))
        offsets = upto[np.concatenate(([0], np.cumsum(sizes)))]
        found = _encoder(held).texts(offsets, ids[good])
        return pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), found)

    run.__annotations__ = {"lists": pa.Array, "return": pa.Array}
    return docs.withColumn(fresh(docs, text_col)[0], F.arrow_udf(run, "string")(F.col(f"`{ids_col}`")))


def encoded(docs: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, piece_ids, round_trip): round_trip tells that decoding gives the text back.

    A null text has null ids and counts as no piece, with a null round_trip.
    Repeated rows and null ids are encoded like any other.
    """
    rows = only(docs, id_col, text_col).toDF("id", "text")
    both = decode(encode(rows, model), model)
    return both.select(F.col("id").alias(id_col), F.coalesce(F.size("piece_ids"), F.lit(0)).alias("n_pieces"), "piece_ids",
                       (F.col("decoded") == F.col("text")).alias("round_trip"))
