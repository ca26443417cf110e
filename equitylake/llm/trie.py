"""Operator 11, conversation prefix trie by vertical bitmaps.

Every distinct sequence of first turns is a node. Conversations are dealt by
id into shards; in a shard an index maps (position, turn) to the bitset of the
conversations that say it there. From the bitset of all, the conversations of
a child are its parent's bitset intersected with a posting; the walk goes
depth first, one intersection for each child, and reports popcounts, members
and the list of conversations that end there. A node's name is a digest of
its turns, under which the shards' findings are added up.

Turns go in blocks of bounded length, each a shard's work of its own, entered
under the digest of all blocks before it, so a conversation of any length is
spread over tasks.

Sums over subtrees need no walk of the merged trie. The nodes whose smallest
member is conversation m are the end of m's path; let X(m) be the bytes above
them. Summed over the members of a node v, max(0, X(m) - bytes above v) is
each member's bytes at v and below wherever it is not the smallest member,
which is the sum of (members - 1) times bytes over the subtree; and a leaf is
counted at its smallest member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equitylake.llm.common import cut, looked_up
from equitylake.llm.turns import SEGMENT_TURNS, in_order, long_ones

#: Conversations in a shard, bits in its sets.
SHARD = 4096
BLOCK_TURNS = 1024
ROOT = bytes(16)
_EMPTY_SHA = hashlib.sha256().hexdigest()
_FOUND = ("path binary, parent binary, depth bigint, n_bytes bigint, upto bigint, conv bigint, n bigint, "
          "members array<bigint>, ends array<bigint>")


# ------------------------------------------------------------------ tasks
def _child(path: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(path + turn, digest_size=16).digest()


def _bits(bitset: int) -> Iterator[int]:
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def _through(entry: bytes, turns: list[bytes]) -> bytes:
    """The path at the end of a full block, by which the next one is entered: found without walking the block."""
    return _child(entry, hashlib.sha256("".join(t.hex() for t in turns).upper().encode()).digest())


def grow(said: list[list[bytes]], sizes: list[list[int]], ended: list[bool], entries: list[tuple[bytes, int]], depth: int, block: int):
    """The nodes of a shard: (path, parent, depth, bytes of the last turn, bytes of all, members, those that end here).

    ``said`` and ``sizes`` are each conversation's turns of this block, which
    starts after ``depth`` turns; ``entries`` the path and bytes it comes with;
    ``ended`` tells that no later block follows. The entry of the first block
    is a node too. Members and ends are bitsets.
    """
    postings: list[dict[bytes, int]] = [{} for _ in range(max(map(len, said), default=0))]
    stops: dict[int, int] = {}
    entered: dict[tuple[bytes, int], int] = {}
    for i, turns in enumerate(said):
        bit = 1 << i
        for at, turn in zip(postings, turns):
            at[turn] = at.get(turn, 0) | bit
        if ended[i]:
            stops[len(turns)] = stops.get(len(turns), 0) | bit
        entered[entries[i]] = entered.get(entries[i], 0) | bit
    open_nodes = []
    for (path, upto), members in entered.items():
        if not depth:
            yield path, None, 0, 0, 0, members, members & stops.get(0, 0)
        open_nodes.append((path, upto, 0, members, path))
    while open_nodes:
        path, upto, p, members, entry = open_nodes.pop()
        rest = members
        while rest:
            i = (rest & -rest).bit_length() - 1
            if p >= len(said[i]):
                rest ^= 1 << i
                continue
            turn = said[i][p]
            child = members & postings[p][turn]
            rest &= ~child
            name = _child(path, turn) if p + 1 < block else _through(entry, said[i])
            total = upto + sizes[i][p]
            yield name, path, depth + p + 1, sizes[i][p], total, child, child & stops.get(p + 1, 0)
            open_nodes.append((name, total, p + 1, child, entry))


def _shards(batches: Iterator[pa.RecordBatch], size: int, block: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def flush():
        nodes = list(grow([r[3] for r in held], [r[4] for r in held], [r[5] for r in held], [(r[2], r[6]) for r in held],
                          held[0][0] * block, block))
        ids = [r[1] for r in held]
        members = [[ids[i] for i in _bits(n[5])] for n in nodes]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n[0] for n in nodes], pa.binary()), pa.array([n[1] for n in nodes], pa.binary()),
             *(pa.array([n[k] for n in nodes], pa.int64()) for k in (2, 3, 4)),
             pa.array([m[0] for m in members], pa.int64()), pa.array([len(m) for m in members], pa.int64()),
             pa.array(members, pa.list_(pa.int64())), pa.array([[ids[i] for i in _bits(n[6])] for n in nodes], pa.list_(pa.int64()))],
            names=["path", "parent", "depth", "n_bytes", "upto", "conv", "n", "members", "ends"])
        held.clear()

    for batch in batches:
        for blk, conv, entry, said, ended, upto in zip(*(batch.column(c).to_pylist() for c in ("blk", "conv", "entry", "said", "ended", "upto"))):
            if held and (held[0][0] != blk or len(held) >= size):
                yield from flush()
            held.append((blk, conv, entry, [s["turn"] for s in said if s["depth"]], [s["n_bytes"] for s in said if s["depth"]], ended, upto))
    if held:
        yield from flush()


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, blk, entry, upto) from the digests and bytes of blocks, sorted by conversation and block."""
    conv, entry, upto = None, ROOT, 0
    for batch in batches:
        ids, digests, sizes = (batch.column(c).to_pylist() for c in ("conv", "digest", "n_bytes"))
        entries, uptos = [], []
        for c, d, n in zip(ids, digests, sizes):
            if c != conv:
                conv, entry, upto = c, ROOT, 0
            entries.append(entry)
            uptos.append(upto)
            entry, upto = _child(entry, d), upto + n
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("blk"), pa.array(entries, pa.binary()), pa.array(uptos, pa.int64())],
                                         names=["conv", "blk", "entry", "upto"])


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, ends_sha256) from lists of ids, sorted by path and first id; a path's ids stream through one hash."""
    path, state, first = None, None, True

    def out(paths, shas):
        return pa.RecordBatch.from_arrays([pa.array(paths, pa.binary()), pa.array(shas, pa.string())], names=["path", "ends_sha256"])

    for batch in batches:
        paths, shas = [], []
        for p, ends in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist()):
            if p != path:
                if state is not None:
                    paths.append(path)
                    shas.append(state.hexdigest())
                path, state, first = p, hashlib.sha256(), True
            state.update((("" if first else ",") + ",".join(map(str, ends))).encode())
            first = False
        if paths:
            yield out(paths, shas)
    if state is not None:
        yield out([path], [state.hexdigest()])


# ------------------------------------------------------------------ operator
def spoken(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           segment: int = SEGMENT_TURNS) -> DataFrame:
    """(conv, pos from 0, turn, n_bytes): each conversation's turns in order, a turn as the digest of its role and text.

    Turns go by number, nulls first, ties by role, then digest. A null role
    or text is empty. Rows without a conversation take no part; rows that
    repeat all stay. The result is written to the checkpoint folder.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = (turns.where(F.col(f"`{conv_col}`").isNotNull())
                 .select(F.col(f"`{conv_col}`").cast("bigint").alias("conv"), F.col(f"`{turn_col}`").alias("at"), role.alias("role"),
                         F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("said"),
                         F.octet_length(text).cast("bigint").alias("n_bytes")))
    numbered = cut(in_order(rows, ["at", "role", "said"], "said", segment).select("conv", "segment", "place", "said", "n_bytes"))
    offsets = cut(long_ones(numbered).select("segment", "n", "offset"))
    placed = looked_up(numbered, offsets, "segment", "n", segment, ["conv", "place"])
    return placed.select("conv", (F.coalesce("offset", F.lit(0)) + F.col("place")).alias("pos"), F.col("said").alias("turn"), "n_bytes")


def _blocks(rows: DataFrame, convs: DataFrame, block: int) -> DataFrame:
    """(blk, conv, entry, upto, said, ended): each conversation's turns by block, turnless ones too."""
    every = rows.select("conv", "depth", "turn", "n_bytes").unionByName(
        convs.select("conv", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("bigint").alias("n_bytes")))
    blk = F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / block).cast("bigint")
    blocks = (every.withColumn("blk", blk).groupBy("conv", "blk")
                   .agg(F.sort_array(F.collect_list(F.struct("depth", "turn", "n_bytes"))).alias("said")))
    blocks = cut(blocks)
    several = blocks.where("blk = 1").select("conv")  # the conversations of more than one block
    own = F.filter("said", lambda s: s["depth"] > 0)
    digest = F.unhex(F.sha2(F.concat_ws("", F.transform(own, lambda s: F.hex(s["turn"]))), 256))
    narrow = (blocks.join(several, "conv", "left_semi")
                    .select("conv", "blk", digest.alias("digest"), F.aggregate(own, F.lit(0).cast("bigint"), lambda a, s: a + s["n_bytes"]).alias("n_bytes")))
    entries = (narrow.repartition("conv").sortWithinPartitions("conv", "blk")
                     .mapInArrow(_entries, "conv bigint, blk bigint, entry binary, upto bigint"))
    entries = cut(entries.join(narrow.groupBy("conv").agg(F.max("blk").alias("top")), "conv").withColumn("one", F.lit(1)))
    entries = entries.select(F.struct("conv", "blk").alias("id"), "entry", "upto", "top", "one")
    met = looked_up(blocks.withColumn("id", F.struct("conv", "blk")), entries, "id", "one", 0, ["conv"])
    return met.select("blk", "conv", F.coalesce("entry", F.lit(ROOT)).alias("entry"), F.coalesce("upto", F.lit(0)).cast("bigint").alias("upto"), "said",
                      (F.col("blk") == F.coalesce("top", F.lit(0))).alias("ended"))


def prefix_trie(rows: DataFrame, convs: DataFrame, shard: int = SHARD, block: int = BLOCK_TURNS) -> DataFrame:
    """The nodes of the trie of ``rows`` (conv, depth from 1, turn, n_bytes) and ``convs`` (conv, each once, turnless ones too).

    Per node: conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256, path (the
    node's digest). Without a conversation there is no node.
    """
    dealt = _blocks(rows, convs, block).repartitionByRange("blk", "conv").sortWithinPartitions("blk", "conv")
    found = cut(dealt.mapInArrow(lambda b: _shards(b, shard, block), _FOUND))
    merged = (found.groupBy("path", "parent", "depth", "n_bytes", "upto")  # the path decides the others
                   .agg(F.min("conv").alias("conv_id"), F.sum("n").alias("n_convs")))
    merged = cut(merged)
    kids = merged.where("parent is not null").groupBy(F.col("parent").alias("path")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(merged.join(kids, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    before = F.col("upto") - F.col("n_bytes")

    tops = nodes.groupBy(F.col("conv_id").alias("m")).agg(F.min(before).alias("x"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    ends = found.where(F.size("ends") > 0)
    members = cut(ends.select(F.explode("ends").alias("m"), "upto", (F.col("depth") + 1).alias("weight")).join(tops, "m", "left")
                      .select("m", F.coalesce("x", "upto").alias("x"), F.coalesce("leaf", F.lit(0)).alias("leaf"), "weight"))
    total = members.agg(F.sum("weight")).first()[0] or 0
    shared = nodes.where("n_convs > 1").select("path")  # a node of one conversation is a leaf's path, with nothing saved
    pairs = (found.join(shared, "path", "left_semi").select("path", before.alias("before"), F.explode("members").alias("m")))
    sums = (looked_up(pairs, members, "m", "weight", total, ["path"])
            .groupBy("path").agg(F.sum(F.greatest(F.col("x") - F.col("before"), F.lit(0))).alias("saved"), F.sum("leaf").alias("leaves")))
    shas = (ends.select("path", "ends").repartition("path").sortWithinPartitions("path", F.col("ends")[0])
                .mapInArrow(_end_digests, "path binary, ends_sha256 string"))
    parents = nodes.where("n_children > 0").select(F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    out = looked_up(nodes.join(sums, "path", "left").join(shas, "path", "left"), cut(parents), "parent", "n_children", nodes.count(), ["path"])
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.coalesce("leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
                      F.coalesce("saved", F.lit(0)).cast("bigint").alias("saved_tokens"),
                      F.coalesce("ends_sha256", F.lit(_EMPTY_SHA)).alias("ends_sha256"), F.lower(F.hex("path")).alias("path"))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", shard: int = SHARD, block: int = BLOCK_TURNS) -> DataFrame:
    """``prefix_trie`` of a table of turns; see ``spoken`` for nulls, ties and repeated rows."""
    said = spoken(turns, conv_col, turn_col, role_col, text_col)
    return prefix_trie(said.withColumn("depth", F.col("pos") + 1), said.where("pos = 0").select("conv"), shard, block)


def spliced(said: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """(rows, convs) for ``prefix_trie``: each conversation c of ``spoken`` rows begins with the first turns of another.

    Its first h = crc32(decimal c) % ``most`` turns are those of conversation
    c - c % ``every`` (all if it has fewer, none if it is absent); its own
    turns after its first h follow.
    """
    h = (F.crc32(F.col("conv").cast("string")) % most).cast("bigint")
    lengths = said.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
    donors = lengths.select(F.col("conv").alias("donor"), F.col("n").alias("has"))
    plan = cut(lengths.select("conv", "n", h.alias("h"), (F.col("conv") - F.col("conv") % every).alias("donor"))
                      .join(donors, "donor", "left").withColumn("lent", F.least("h", F.coalesce("has", F.lit(0)))))
    first = said.where(F.col("pos") < most - 1).select(F.col("conv").alias("donor"), "pos", "turn", "n_bytes")
    lent = (plan.select("conv", "donor", "lent").join(first, "donor").where("pos < lent")
                .select("conv", (F.col("pos") + 1).alias("depth"), "turn", "n_bytes"))
    total = plan.agg(F.sum("n")).first()[0] or 0
    own = looked_up(said.where(F.col("pos") >= h), plan.select("conv", "n", "h", "lent"), "conv", "n", total, ["pos"])
    own = own.select("conv", (F.col("lent") + F.col("pos") - F.col("h") + 1).alias("depth"), "turn", "n_bytes")
    return lent.unionByName(own), plan.select("conv")
