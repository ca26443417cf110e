"""The prefix trie against a plain walk over all prefixes."""

import hashlib
import math
import random
import zlib

import corpora

from equitylake.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def in_order(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found.setdefault(conv, []).append((turn is not None, turn or 0, role, tie, text))
    return {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in found.items()}


def spliced(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = convs.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]  # as in SQL, the remainder has the sign of c
    return out


def brute(convs):
    """The result rows, from every prefix of every conversation."""
    members = {}
    for c, said in convs.items():
        for d in range(len(said) + 1):
            members.setdefault(tuple(said[:d]), []).append(c)
    rows = set()
    for node, who in members.items():
        below = [x for x in members if x[:len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:len(x)] == x and len(y) > len(x) for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in who if len(convs[c]) == len(node))))
        rows.add((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children), len(leaves), saved,
                  hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def as_rows(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def chats(seed, n=60, longest=6):
    pick = random.Random(seed)
    says = ["hi", "hé llo", "", None, "one two", "x" * 30]
    rows = []
    for c in range(n):
        for t in range(pick.randint(1, longest)):
            rows.append((c * pick.choice([1, 1, 3]), pick.choice([t, t, None]), pick.choice(["user", "assistant", None]), pick.choice(says[:pick.choice([1, 2, 6])])))
    return rows


def test_small_shards_and_blocks_give_the_plain_trie(spark):
    rows = chats(0, n=100)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert as_rows(trie.conversation_trie(df, shard=7, block=2)) == brute(in_order(rows))


def test_query_splices_and_matches(spark, scratch):
    rows = chats(7, n=150) + [(None, 0, "user", "nobody"), (3, 1, "user", "hi"), (3, 1, "user", "hi"), (-7, 0, "user", "hi")]
    corpora.write(spark.createDataFrame(rows, SCHEMA), scratch, "conversations")
    found = as_rows(queries.QUERIES["op11_trie"](spark, scratch))
    convs = in_order(rows)
    assert found == brute(spliced(convs))


def test_turnless_conversations_are_members_of_the_root(spark):
    # Conversation 1 keeps its turns after the first h; its donor 0 is absent, so with few turns it has none left.
    h = zlib.crc32(b"1") % 9
    assert h > 0
    said = trie.spoken(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA))
    rows, convs = trie.spliced(said)
    assert as_rows(trie.prefix_trie(rows, convs)) == {(1, 0, None, 1, 0, 1, 0, hashlib.sha256(b"1").hexdigest())}


def test_one_long_conversation_crosses_segments_and_blocks(spark):
    rows = [(1, t, "user", f"t{t % 7}") for t in range(700)] + [(2, t, "user", f"t{t % 7}") for t in range(650)] + [(3, 0, "user", "t0")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    said = trie.spoken(df, segment=64)
    found = as_rows(trie.prefix_trie(said.selectExpr("conv", "pos + 1 as depth", "turn", "n_bytes"), said.where("pos = 0").select("conv"), block=100))
    deep = {(r[0], r[1]): r for r in found}
    assert len(found) == 701
    assert deep[1, 650][3:6] == (2, 1, 1) and deep[1, 700][4:6] == (0, 1)
    assert deep[1, 0][3:7] == (3, 1, 1, 2 + 2 * 649 + 2)


def test_hot_first_turn_and_many_copies(spark):
    rows = [(c, 0, "system", "same") for c in range(400)] + [(c, 1, "user", str(c % 3)) for c in range(0, 400, 2)]
    assert as_rows(trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), shard=32)) == brute(in_order(rows))


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", conv bigint, path string")
    assert trie.conversation_trie(empty).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "a", 9, "p"), (1, 0, "user", "a", 9, "p")], SCHEMA + ", conv bigint, path string")
    assert as_rows(trie.conversation_trie(rows)) == brute({1: [("user", "a")] * 2})
