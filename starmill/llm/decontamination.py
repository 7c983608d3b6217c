"""Benchmark decontamination as a prefix-filtered containment join."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.hashing import lower_table, shingles, words
from starmill.llm.rows import identified, joined_bytes, pieces, released, send, table
from starmill.sources.staging import stage

#: Bytes outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` once A-Z are lower-cased.
SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
MARKER_BITS = 20


def text_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts and, for each text, where its words begin.

    Texts are hashed one run after another; a word never spans two texts because the
    run is cut there.
    """
    spaced = np.zeros(len(raw) + len(offsets) - 1, np.uint8)
    at = np.arange(len(raw)) + np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    spaced[at] = raw
    begins, _, hashes = words(spaced, lower_table(SEPARATORS))
    return hashes, np.searchsorted(begins, offsets + np.arange(len(offsets)))


def _windows(size: int, shingle: int):
    """Distinct word windows of the items: hashes of the words as bytes, and their item."""

    def run(batches):
        for batch in batches:
            raw, offsets = joined_bytes(batch.column("body"))
            h, first = text_words(raw, offsets)
            item, window = [], []
            for k, name in enumerate(batch.column("item").to_pylist()):
                own = h[first[k] : first[k + 1]]
                if not len(own):
                    continue
                n = min(size, len(own))
                for j in range(len(own) - n + 1):
                    item.append(name)
                    window.append(own[j : j + n].tobytes())
            yield table(item=pa.array(item, pa.string()), window=pa.array(window, pa.binary()))

    return run


class Block:
    """A bounded block of item windows, indexed by one necessary shingle of each.

    A window is contained whole or not at all, so of its shingles ordered by rarity the
    prefix that must be shared is the first one. ``counts`` gives the order.
    """

    def __init__(self, windows: list[bytes], names: list[int], shingle: int):
        self.names, self.shingle = np.array(names, np.int64), shingle
        self.words = [np.frombuffer(w, np.uint64) for w in windows]
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.width = np.minimum(self.length, shingle)
        self.sizes = sorted(set(self.width.tolist()))
        self.all_keys = {
            s: np.unique(np.concatenate([shingles(w, s) for w, n in zip(self.words, self.width) if n == s]))
            for s in self.sizes
        }

    def index(self, counts: dict[int, np.ndarray]) -> None:
        """Choose the rarest shingle of each window (ties to the smaller hash)."""
        most = int(self.length.max())
        self.matrix = np.zeros((len(self.words), most), np.uint64)
        key, self.offset = np.zeros(len(self.words), np.uint64), np.zeros(len(self.words), np.int64)
        for k, w in enumerate(self.words):
            self.matrix[k, : len(w)] = w
            s = int(self.width[k])
            own = shingles(w, s)
            rarity = counts[s][np.searchsorted(self.all_keys[s], own)]
            j = int(np.lexsort((own, rarity))[0])
            key[k], self.offset[k] = own[j], j
        self.by_size = {}
        for s in self.sizes:
            at = np.flatnonzero(self.width == s)
            at = at[np.argsort(key[at], kind="stable")]
            keys, begin = np.unique(key[at], return_index=True)
            self.by_size[s] = (keys, np.append(begin, len(at)), at)

    def hits(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, first word and window of every occurrence in the texts whose words are ``h``."""
        found = []
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for s, (keys, begin, order) in self.by_size.items():
            own = shingles(h, s)
            at = np.flatnonzero(marked(own, markers(keys)))
            place = np.searchsorted(keys, own[at])
            place[place == len(keys)] = 0
            true = keys[place] == own[at]
            at, place = at[true], place[true]
            for a in range(0, len(at), 1 << 16):  # bounded memory where many windows share a shingle
                pos, group = at[a : a + (1 << 16)], place[a : a + (1 << 16)]
                many = begin[group + 1] - begin[group]
                pos = np.repeat(pos, many)
                inner = np.arange(len(pos)) - np.repeat(np.cumsum(many) - many, many)
                window = order[np.repeat(begin[group], many) + inner]
                text = text_of[pos]
                start = pos - self.offset[window]
                inside = (start >= first[text]) & (start + self.length[window] <= first[text + 1])
                start, window, text = start[inside], window[inside], text[inside]
                same = np.ones(len(start), bool)
                for j in range(self.matrix.shape[1]):
                    live = np.flatnonzero(same & (j < self.length[window]))
                    same[live] = h[start[live] + j] == self.matrix[window[live], j]
                found.append((text[same], start[same], window[same]))
        if not found:
            none = np.zeros(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*found))


def markers(keys: np.ndarray) -> np.ndarray:
    """A bit per low hash value, so most shingles are told apart without a search."""
    bits = np.zeros(1 << MARKER_BITS, bool)
    bits[(keys & np.uint64((1 << MARKER_BITS) - 1)).astype(np.int64)] = True
    return bits


def marked(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return bits[(h & np.uint64((1 << MARKER_BITS) - 1)).astype(np.int64)]


def _shingle_counts(shared):
    def run(batches):
        block = shared()
        totals = {s: np.zeros(len(k), np.int64) for s, k in block.all_keys.items()}
        bits = {s: markers(k) for s, k in block.all_keys.items()}
        for batch in batches:
            for part in pieces(batch):
                h, _ = text_words(*joined_bytes(part.column("body")))
                for s, keys in block.all_keys.items():
                    own = shingles(h, s)
                    own = own[marked(own, bits[s])]
                    place = np.searchsorted(keys, own)
                    place[place == len(keys)] = 0
                    place = place[keys[place] == own]
                    totals[s] += np.bincount(place, minlength=len(keys))
        for s, total in totals.items():
            k = np.flatnonzero(total)
            yield table(size=np.full(len(k), s, np.int32), key=k, n=total[k])

    return run


def _occurrences(shared):
    def run(batches):
        block = shared()
        for batch in batches:
            for part in pieces(batch):
                h, first = text_words(*joined_bytes(part.column("body")))
                text, start, window = block.hits(h, first)
                by = np.lexsort((start, text))
                text, start, window = text[by], start[by], window[by]
                spans, names = [], []
                edge = np.searchsorted(text, np.arange(part.num_rows + 1))
                for k in range(part.num_rows):
                    own = slice(edge[k], edge[k + 1])
                    begin = start[own] - first[k]
                    spans.append(merged(begin, begin + block.length[window[own]]))
                    names.append(np.sort(block.names[np.unique(window[own])]))
                yield table(
                    rid=part.column("rid"), doc_id=part.column("doc_id"), n_words=pa.array(np.diff(first), pa.int64()),
                    spans=pa.array(spans, pa.list_(pa.int32())), windows=pa.array(names, pa.list_(pa.int64())),
                )

    return run


def merged(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Union of intervals as flat ``begin, end, begin, end …``."""
    if not len(begin):
        return np.zeros(0, np.int32)
    by = np.argsort(begin, kind="stable")
    begin, reach = begin[by], np.maximum.accumulate(end[by])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
    return np.stack([begin[new], reach[last]], 1).ravel().astype(np.int32)


def contamination(
    docs: DataFrame, items: DataFrame, item_id: str = "item_id", item_text: str = "text",
    size: int = 10, shingle: int = 3, block_windows: int = 200_000,
) -> DataFrame:
    """``rid``, ``doc_id``, ``n_words``, ``spans`` (hit word ranges, flat, end exclusive) and
    ``items`` (sorted ids of the items with an occurring window), one row per row of ``docs``.

    ``docs`` comes from ``rows.identified``. The items' windows are taken in blocks of
    ``block_windows`` distinct windows; each block is sent to the executors (at most about
    ``block_windows * size * 8`` bytes) and the documents are read once per block, so the
    benchmark may be of any size. Which items hold a window stays in a table and is joined, so a
    passage that very many items share is one window here. Very long texts are scanned in pieces of rows, one text at a time. Words are compared by 64-bit hash, each word of a window.
    Null or empty texts and items have no words; an item with a null id hits words but is
    not listed; items that share an id are one.
    """
    spark = docs.sparkSession
    named = items.select(
        F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{item_text}`").cast("binary").alias("body")
    )
    held = stage(named.mapInArrow(released(_windows(size, shingle)), "item string, window binary").distinct(), "item-windows")
    # Written once, so a window keeps its name.
    windows = stage(
        held.select("window").distinct().withColumn("name", F.monotonically_increasing_id()), "windows"
    )
    items_of = held.filter("item IS NOT NULL").join(windows, "window").select("name", "item")
    blocks = max(1, -(-windows.count() // block_windows))
    results = []
    for k in range(blocks):
        own = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()
        if not own and k:
            continue
        results.append(_against(docs, [bytes(r.window) for r in own], [r["name"] for r in own], shingle))
    hits = results[0]
    for more in results[1:]:
        hits = hits.unionByName(more)
    if len(results) > 1:
        hits = hits.groupBy("rid").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.flatten(F.collect_list("windows"))).alias("windows"),
        )
    hits = stage(hits, "window-hits")
    # Documents with the same windows have the same items, which are looked up once for all of them.
    sets = hits.filter(F.size("windows") > 0).select("windows").distinct()
    each = sets.select("windows", F.explode("windows").alias("name")).join(items_of, "name")
    listed = each.groupBy("windows").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    return hits.join(listed, "windows", "left").select(
        "rid", "doc_id", "n_words", "spans", F.coalesce("items", none).alias("items")
    )


def _against(docs: DataFrame, windows: list[bytes], names: list[int], shingle: int) -> DataFrame:
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"rid long, doc_id {kind}, n_words long, spans array<int>, windows array<long>"
    block = Block(windows, names, shingle)
    if windows:
        counted = docs.select("body").mapInArrow(released(_shingle_counts(send(spark, block))), "size int, key long, n long")
        counts = {s: np.zeros(len(k), np.int64) for s, k in block.all_keys.items()}
        for r in counted.groupBy("size", "key").agg(F.sum("n").alias("n")).collect():  # keys of this block only
            counts[r["size"]][r["key"]] = r["n"]
        block.index(counts)
    else:
        block.by_size, block.length = {}, np.zeros(0, np.int64)
    return docs.select("rid", "doc_id", "body").mapInArrow(released(_occurrences(send(spark, block))), schema)


def _verdicts(batches):
    for batch in batches:
        hit, n_items, digest = [], [], []
        for spans, items in zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist()):
            flat = np.array(spans, np.int64).reshape(-1, 2)
            flat = merged(flat[:, 0], flat[:, 1]).reshape(-1, 2)
            hit.append(int((flat[:, 1] - flat[:, 0]).sum()))
            n_items.append(len(items))
            digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
        yield table(
            doc_id=batch.column("doc_id"), n_words=batch.column("n_words"), n_hit=pa.array(hit, pa.int64()),
            n_items=pa.array(n_items, pa.int64()), items_sha256=pa.array(digest, pa.string()),
            contaminated=pa.array([h > 0 for h in hit], pa.bool_()),
        )


def contamination_digests(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``."""
    base = identified(docs, id_col, text_col)
    kind = dict(base.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return contamination(base, items, **how).select("doc_id", "n_words", "spans", "items").mapInArrow(released(_verdicts), schema)



def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without an item window; all columns stay."""
    base = identified(docs, id_col, text_col, whole=True)
    verdict = contamination(base.drop("row"), items, **how).select("rid", F.size("spans").alias("n"))
    clean = verdict.filter("n = 0").select("rid")
    return base.join(clean, "rid").select("row.*")
