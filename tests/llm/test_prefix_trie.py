import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from starmill.llm import prefix_trie

COLUMNS = prefix_trie.NODES


def brute(rows, group=None, heads=6):
    """Nodes from rows ``(conv_id, turn, role, text)``; ``group`` rebuilds the conversations."""

    def tie(r):
        role, text = r[2] or "", r[3] or ""
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()

    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, tie(r))):
        own[r[0]].append((r[2] or "", r[3] or ""))
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % heads if group else 0
        base = c - int(abs(c) % group * (1 if c >= 0 else -1)) if group else None
        convs[c] = tuple(own.get(base, [])[:h] + turns[h:]) if group else tuple(turns)
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    sums = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        leaves = sum(sums[c][0] for c in children[p]) or 1
        sums[p] = (leaves, own + sum(sums[c][1] for c in children[p]))
    return sorted(
        (
            min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *sums[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    )


def frame(spark, rows):
    wide = [(*r, "x", b"y", 1) for r in rows]
    return spark.createDataFrame(wide, "conv_id long, turn long, role string, text string, key string, path binary, depth long").repartition(3)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def trie(spark, rows, group=None):
    turns = prefix_trie.conversation_turns(frame(spark, rows))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns, group) if group else turns)


@pytest.fixture(scope="module")
def conversations():
    """Few distinct turns, so prefixes meet; copies, deep ones, gaps, nulls and repeated turn numbers."""
    r = random.Random(11)
    rows = []
    for c in range(-40, 260):
        for t in range(r.choice([1, 1, 2, 3, 5, 7])):
            rows.append((c, t * r.choice([1, 1, 2]), r.choice(["user", "assistant", None]), r.choice(["a", "bé", "", None, "日本"])))
    rows += [(c, t, "user", "same") for c in range(500, 620) for t in range(3)]
    rows += [(c, t, "user", f"deep {t % 7}") for c in (700, 705, 811) for t in range(60 + c % 9)]
    rows += [(900, None, "user", "first"), (900, 0, "user", "then"), (900, 0, "a", "tie"), (900, 0, "a", "tie"), (None, 0, "user", "nobody")]
    rows += [(901, 0, "ab", "c"), (902, 0, "a", "bc"), (903, 0, "", "z" * 300_000)]
    return rows


@pytest.mark.parametrize("group", [None, 100])
def test_against_brute_force(spark, conversations, group):
    assert got(trie(spark, conversations, group)) == brute(conversations, group)


@pytest.mark.parametrize("group", [None, 100])
def test_many_ranges_give_the_same_nodes(spark, conversations, group, monkeypatch):
    """Each range a few rows, so nodes are open over many ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "53")
    try:
        assert got(trie(spark, conversations, group)) == brute(conversations, group)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_one_conversation_in_very_many_copies(spark):
    rows = [(c, t, "user", "hello") for c in range(4000) for t in range(2)] + [(9000 + c, 0, "user", "hello") for c in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(trie(spark, rows)) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_conversations_left_without_turns_stay_members_of_the_root(spark):
    rows = [(c, 0, "user", "only") for c in (101, 102, 103, 104, 105, 106)]
    assert got(trie(spark, rows, 100)) == brute(rows, 100)


def test_empty_table(spark):
    assert got(trie(spark, [])) == [] and got(trie(spark, [(None, 1, "user", "x")])) == []


def test_last_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "bot", "b"), (2, 0, "user", "a"), (2, 1, "bot", None)]
    df = frame(spark, rows)
    done = prefix_trie.with_last_turns(prefix_trie.prefix_trie(prefix_trie.conversation_turns(df)), df)
    assert sorted((r.conv_id, r.depth, r.role, r.text) for r in done.collect()) == [
        (1, 0, None, None), (1, 1, "user", "a"), (1, 2, "bot", "b"), (2, 2, "bot", "")
    ]
