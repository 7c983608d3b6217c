"""Conversation prefixes as a trie, by truncation peeling.

Conversations become paths: one 128-bit hash per turn. Sorted by path, the members of a node
lie next to each other, so ranges of paths are tries of their own. Each task peels its range from the
deepest level up: nodes left from the level below and conversations that end here are regrouped
by their prefix, get their aggregates, and lose their last turn. Only the nodes on the
first and the last path of a range can go on in another range; their parts are added up afterwards and
peeled once more. So a node with a third of all members is the work of many tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.rows import table
from starmill.operators.joins import checked_broadcast
from starmill.sources.staging import stage

HASH = 16
TURNS = "turns"
CLOSED, OPEN, ENDS = 0, 1, 2
#: What a range knows: finished nodes, its parts of open ones, and ids of conversations that end at open ones.
PEELED = (
    "kind int, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, size long, key binary, parent_key binary, ends binary"
)
NODES = "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
NOBODY = np.iinfo(np.int64).max
CHUNK = 50_000


def _turn_hash(role: Column, text: Column) -> Column:
    """128 bits of a turn; the role's length in front tells role and text apart."""
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * HASH))


def conversation_turns(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id`` and ``turns``, its turns in order as (hash, code points).

    Order is by turn, null first; turns of one number go by their hash. Null role or text is empty. Rows
    without a conversation id take no part. Texts are hashed where they are read; only hashes move. A conversation's hashes
    (24 bytes a turn) must fit in memory, its texts need not.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"), _turn_hash(role, text).alias("h"), F.length(text).alias("size")
        ).alias("t"),
    )
    ordered = F.sort_array(F.collect_list("t"))
    turns = F.transform(ordered, lambda t: F.struct(t["h"].alias("h"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(turns.alias(TURNS))


def with_shared_heads(turns: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Every conversation ``c`` with its first ``h`` turns taken from conversation ``c - c % group`` and
    its own after its first ``h``; ``h`` is the checksum of ``c`` modulo ``heads``."""
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    own = turns.select("conv_id", TURNS, h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    lead = turns.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice(TURNS, 1, heads).alias("lead")
    )
    none = F.slice(TURNS, 1, 0)
    first = F.slice(F.coalesce("lead", none), F.lit(1), F.col("h"))
    rest = F.slice(TURNS, F.col("h") + 1, F.greatest(F.size(TURNS), F.lit(0)))
    return own.join(lead, "base", "left").select("conv_id", F.concat(first, rest).alias(TURNS))


def _as_paths(batches):
    for batch in batches:
        lists = batch.column(TURNS)
        flat = lists.flatten()
        hashes = b"".join(flat.field("h").to_pylist())
        counts = lists.value_lengths().to_numpy()
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        paths = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(lists), [None, pa.py_buffer(ends * HASH), pa.py_buffer(hashes)]
        )
        sizes = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat.field("size").cast(pa.int32()))
        yield table(conv_id=batch.column("conv_id"), path=paths.cast(pa.binary()), sizes=sizes)


def _shared_with_previous(units: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of leading turns that each path shares with the one before; -1 for the first."""
    size = np.diff(ends)
    least = np.minimum(size[1:], size[:-1])
    begin = np.concatenate([[0], np.cumsum(least)])
    k = np.arange(begin[-1]) - np.repeat(begin[:-1], least)
    same = (units[np.repeat(ends[:-2], least) + k] == units[np.repeat(ends[1:-1], least) + k]).all(axis=1)
    shared = least.copy()
    some = least > 0
    if some.any():
        miss = np.where(same, NOBODY, k)
        shared[some] = np.minimum(shared[some], np.minimum.reduceat(miss, begin[:-1][some]))
    return np.concatenate([[-1], shared])


def _chain(units: np.ndarray) -> list[bytes]:
    """A key for every prefix of one path."""
    keys = [bytes(HASH)]
    for unit in units:
        keys.append(hashlib.sha256(keys[-1] + unit.tobytes()).digest()[:HASH])
    return keys


def _node_rows(kind: int, n: int, **given) -> pa.RecordBatch:
    kinds = dict(zip(("key", "parent_key", "ends"), [pa.binary()] * 3))
    names = [f.split()[0] for f in PEELED.split(", ")]
    columns = {}
    for name in names:
        value = given.get(name)
        if name == "kind":
            columns[name] = pa.array(np.full(n, kind, np.int32))
        elif value is None:
            columns[name] = pa.nulls(n, kinds.get(name, pa.int64()))
        else:
            columns[name] = pa.array(value, kinds.get(name, pa.int64()))
    return pa.RecordBatch.from_pydict(columns)


def _peel_range(conv: np.ndarray, units: np.ndarray, ends: np.ndarray, sizes: np.ndarray):
    """The nodes of one range of paths in order of path and conversation."""
    length = np.diff(ends)
    shared = _shared_with_previous(units, ends)
    last = len(conv) - 1
    left, right = _chain(units[: length[0]]), _chain(units[ends[last] :])
    by_length = np.argsort(length, kind="stable")
    cuts = np.searchsorted(length[by_length], np.arange(length.max() + 2))

    none = np.zeros(0, np.int64)
    # The nodes of the level below: first row, members, smallest member, leaves, saved, open
    below = {c: none for c in ("start", "n", "conv", "children", "leaves", "saved")} | {"open": np.zeros(0, bool)}
    for depth in range(int(length.max()), -1, -1):
        ended = by_length[cuts[depth] : cuts[depth + 1]]
        counts = ~below["open"]  # an open node of the level below is added when all its parts are known
        start = np.concatenate([below["start"], ended])
        many = np.concatenate([np.where(counts, below["n"], 0), np.ones(len(ended), np.int64)])
        least = np.concatenate([np.where(counts, below["conv"], NOBODY), conv[ended]])
        child = np.concatenate([counts.astype(np.int64), np.zeros(len(ended), np.int64)])
        leaves = np.concatenate([np.where(counts, below["leaves"], 0), np.zeros(len(ended), np.int64)])
        saved = np.concatenate([np.where(counts, below["saved"], 0), np.zeros(len(ended), np.int64)])
        by = np.argsort(start, kind="stable")
        new = shared[start[by]] < depth
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        node = {
            "start": start[by][first],
            "n": np.add.reduceat(many[by], first),
            "conv": np.minimum.reduceat(least[by], first),
            "children": np.add.reduceat(child[by], first),
            "leaves": np.add.reduceat(leaves[by], first),
            "saved": np.add.reduceat(saved[by], first),
        }
        node["open"] = node["start"] == 0
        if length[last] >= depth:
            node["open"][-1] = True
        own = sizes[ends[node["start"]] + depth - 1] if depth else np.zeros(len(first), np.int64)
        closed = ~node["open"]
        node["leaves"] = np.where(closed & (node["children"] == 0), 1, node["leaves"])
        node["saved"] = np.where(closed, node["saved"] + (node["n"] - 1) * own, node["saved"])

        # Ids of the conversations that end at each node; they follow one another in the order of rows.
        at = np.empty(len(by), np.int64)
        at[by] = group
        at_node = at[len(below["start"]) :]
        texts: dict[int, bytes] = {}
        runs = np.flatnonzero(np.diff(at_node, prepend=-1, append=-1))
        for a, b in zip(runs[:-1].tolist(), runs[1:].tolist()):
            g = int(at_node[a])
            if closed[g]:
                texts[g] = hashlib.sha256(",".join(map(str, conv[ended[a:b]].tolist())).encode()).hexdigest().encode()
            else:
                key = left[depth] if node["start"][g] == 0 else right[depth]
                for k in range(a, b, CHUNK):
                    ids = conv[ended[k : min(b, k + CHUNK)]]
                    yield _node_rows(ENDS, 1, key=[key], conv_id=ids[:1], ends=[",".join(map(str, ids.tolist())).encode()])

        # The level below now knows its parents.
        parent = at[: len(below["start"])]
        if len(parent):
            yield from _finished(below, depth + 1, node["conv"][parent], node["open"][parent], node["start"][parent], left, right)
        node["ends"] = np.array([texts.get(g) for g in range(len(first))], object)
        node["size"] = own
        below = node
    yield from _finished(below, 0, below["conv"], np.zeros(1, bool), below["start"], left, right)


def _finished(node: dict, depth: int, parent_conv, parent_open, parent_start, left: list[bytes], right: list[bytes]):
    """Rows of the nodes of one level, once their parents are known."""
    closed = np.flatnonzero(~node["open"])
    if len(closed):
        up = parent_open[closed]
        keys = [(left if s == 0 else right)[depth - 1] if o else None for o, s in zip(up, parent_start[closed])]
        yield _node_rows(
            CLOSED, len(closed), depth=np.full(len(closed), depth), conv_id=node["conv"][closed],
            parent_conv_id=pa.array(parent_conv[closed], mask=up), n_convs=node["n"][closed],
            n_children=node["children"][closed], n_leaves=node["leaves"][closed], saved_tokens=node["saved"][closed],
            parent_key=keys, ends=[e or hashlib.sha256(b"").hexdigest().encode() for e in node["ends"][closed]],
        )
    opened = np.flatnonzero(node["open"])
    if len(opened):
        chains = [left if node["start"][g] == 0 else right for g in opened]
        yield _node_rows(
            OPEN, len(opened), depth=np.full(len(opened), depth),
            conv_id=pa.array(node["conv"][opened], mask=node["conv"][opened] == NOBODY), n_convs=node["n"][opened],
            n_children=node["children"][opened], n_leaves=node["leaves"][opened], saved_tokens=node["saved"][opened],
            size=node["size"][opened], key=[c[depth] for c in chains],
            parent_key=[c[depth - 1] if depth else None for c in chains],
        )


def _peeled(batches):
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    conv = rows.column("conv_id").to_numpy()
    path = rows.column("path").combine_chunks().cast(pa.large_binary())
    lists = rows.column("sizes").combine_chunks()
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(), dtype=np.int64)])
    offsets = np.frombuffer(path.buffers()[1], np.int64)[path.offset : path.offset + len(path) + 1]
    raw = path.buffers()[2]
    units = np.frombuffer(raw, np.uint64)[offsets[0] // 8 : offsets[-1] // 8] if raw is not None and raw.size else np.zeros(0, np.uint64)
    yield from _peel_range(conv, units.reshape(-1, 2), ends, lists.flatten().to_numpy().astype(np.int64))


def _merged(batches):
    """The open nodes, their parts added up, peeled from the deepest level."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    rows = pa.Table.from_batches(parts)
    depth, size, n, children, leaves, saved = (
        rows.column(c).to_numpy().copy() for c in ("depth", "size", "n_convs", "n_children", "n_leaves", "saved_tokens")
    )
    conv = rows.column("conv_id").fill_null(NOBODY).to_numpy().copy()
    keys, parents = rows.column("key").to_pylist(), rows.column("parent_key").to_pylist()
    place = {k: i for i, k in enumerate(keys)}
    up = np.array([place[p] if p is not None else -1 for p in parents], np.int64)
    by = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[by], np.arange(depth.max() + 2))
    for d in range(int(depth.max()), -1, -1):
        here = by[cuts[d] : cuts[d + 1]]
        leaves[here] = np.where(children[here] == 0, 1, leaves[here])
        saved[here] += (n[here] - 1) * size[here]
        if d:
            to = up[here]
            for total, own in ((n, n[here]), (children, np.ones(len(here), np.int64)), (leaves, leaves[here]), (saved, saved[here])):
                np.add.at(total, to, own)
            np.minimum.at(conv, to, conv[here])
    above = np.where(up >= 0, conv[up], 0)
    yield pa.RecordBatch.from_pydict(dict(
        key=rows.column("key").combine_chunks(), conv_id=conv, depth=depth, parent_conv_id=pa.array(above, mask=up < 0),
        n_convs=n, n_children=children, n_leaves=leaves, saved_tokens=saved,
    ))


def _hashed_ends(batches):
    """Chunks in order of key and conversation, hashed as they come, so no list of members is ever held."""
    key, state = None, None
    for batch in batches:
        for own, chunk in zip(batch.column("key").to_pylist(), batch.column("ends")):
            if own != key:
                if state is not None:
                    yield table(key=pa.array([key], pa.binary()), ends_sha256=[state.hexdigest()])
                key, state = own, hashlib.sha256()
            else:
                state.update(b",")
            state.update(chunk.as_py())
    if state is not None:
        yield table(key=pa.array([key], pa.binary()), ends_sha256=[state.hexdigest()])


def prefix_trie(turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations of ``turns`` (see ``conversation_turns``).

    ``conv_id``, its smallest member; ``depth``; ``parent_conv_id`` (the root: null); ``n_convs``, its members;
    ``n_children``; ``n_leaves``, nodes without children below it or itself; ``saved_tokens``, what storing each turn of
    its subtree once saves, in code points; ``ends_sha256`` of the comma-joined ids that end at it, ascending.

    Prefixes are compared by 128-bit hashes. The root holds every conversation, also those without turns; an
    empty table has no nodes. Conversation ids must be distinct. Memory follows one range of paths, which
    range partitioning by path and id keeps even, also where one conversation has very many copies. The open
    nodes that one last task adds up are at most two paths per range.
    """
    paths = stage(
        turns.select("conv_id", TURNS).mapInArrow(_as_paths, "conv_id long, path binary, sizes array<int>"), "paths"
    )
    ordered = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    peeled = stage(ordered.mapInArrow(_peeled, PEELED), "peeled")
    total = {c: F.sum(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    opened = peeled.filter(F.col("kind") == OPEN).groupBy("key", "parent_key", "depth", "size").agg(
        F.min("conv_id").alias("conv_id"), *[f.alias(c) for c, f in total.items()]
    )
    merged = stage(
        opened.repartition(1).mapInArrow(
            _merged,
            "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
            " saved_tokens long",
        ),
        "open-nodes",
    )
    chunks = peeled.filter(F.col("kind") == ENDS).select("key", "conv_id", "ends")
    hashed = chunks.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(
        _hashed_ends, "key binary, ends_sha256 string"
    )
    nobody = hashlib.sha256(b"").hexdigest()
    of_open = merged.join(hashed, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nobody)))
    closed = peeled.filter(F.col("kind") == CLOSED).withColumn("ends_sha256", F.col("ends").cast("string"))
    inner = closed.filter("parent_key IS NULL").select(*NODES)
    parents = checked_broadcast(merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above")))
    outer = closed.filter("parent_key IS NOT NULL").join(parents, "parent_key")
    outer = outer.withColumn("parent_conv_id", F.col("above")).select(*NODES)
    return inner.unionByName(outer).unionByName(of_open.select(*NODES))


def with_last_turns(nodes: DataFrame, conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The nodes with ``role`` and ``text`` of the last turn of their prefix; the root has none.

    For nodes of the conversations as they are, in the order of ``conversation_turns``.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text")
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), _turn_hash(F.col("role"), F.col("text"))))
    placed = rows.withColumn("depth", place.cast("long")).select("conv_id", "depth", "role", "text")
    return nodes.join(placed, ["conv_id", "depth"], "left")
