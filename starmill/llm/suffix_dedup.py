"""Removal of repeated byte strings, by a sampled cover of all suffixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.hashing import odd, sliding_min, spread, window_hashes
from starmill.llm.repeats import ROWS, buckets_for, judged, local_rows
from starmill.llm.rows import identified, joined_bytes, pieces, table
from starmill.sources.staging import stage

LENGTH = 200
#: Bytes by which sampled suffixes are named first.
GRAM = 32
#: Suffixes that are named together in the second round.
CELL = 32
CORE, HULL = LENGTH - CELL + 1, LENGTH + CELL - 1
BLOCK = 1 << 18
PLACE = np.uint64((1 << 20) - 1)


def cover(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The sampled suffixes of each text and the suffixes each stands for.

    A suffix with ``LENGTH`` bytes after it is represented by the start, among its first
    positions, whose ``GRAM`` bytes have the smallest hash (the leftmost of equals). The
    choice depends on those ``LENGTH`` bytes alone, so equal strings choose alike; that is
    what a difference cover gives for fixed positions, at a tenth of the sample.

    Returns ``text``, ``at`` (sample), ``low`` and ``high`` (the suffixes it stands for, a
    run), all relative to the text, and ``gram`` (hash at the sample).
    """
    width = LENGTH - GRAM + 1
    limit = np.repeat(offsets[1:], np.diff(offsets))  # end of the text of each byte
    starts, chosen, grams = [], [], []
    for s in range(0, max(len(raw) - LENGTH + 1, 0), BLOCK):
        part = raw[s : s + BLOCK + LENGTH - 1]
        g = window_hashes(part, [GRAM])[GRAM]
        key = (g & ~PLACE) | np.arange(len(g), dtype=np.uint64)
        best = (sliding_min(key, width) & PLACE).astype(np.int64)
        i = np.arange(s, s + len(best))
        whole = i + LENGTH <= limit[s : s + len(best)]
        i, best = i[whole], best[whole]
        new = np.ones(len(i), bool)
        new[1:] = (best[1:] != best[:-1]) | (i[1:] != i[:-1] + 1)
        lead = np.flatnonzero(new)
        last = np.append(lead[1:], len(i)) - 1
        starts.append(np.stack([i[lead], i[last]], 1) if len(i) else np.zeros((0, 2), np.int64))
        chosen.append(best[lead] + s)
        grams.append(g[best[lead]])
    if not starts:
        none = np.zeros(0, np.int64)
        return dict(text=none, at=none, low=none, high=none, gram=np.zeros(0, np.uint64))
    low, high = np.concatenate(starts).T
    at, gram = np.concatenate(chosen), np.concatenate(grams)
    text = np.searchsorted(offsets, low, side="right") - 1
    base = offsets[text]
    return dict(text=text, at=at - base, low=low - base, high=high - base, gram=gram)


def _samples(buckets: int):
    """Round 1: each sampled suffix by its first bytes."""

    def run(batches):
        for batch in batches:
            key, rid, at = [], [], []
            for part in pieces(batch):
                own = part.column("rid").to_numpy()
                found = cover(*joined_bytes(part.column("body")))
                key.append(found["gram"])
                rid.append(own[found["text"]])
                at.append(found["at"])
            key = np.concatenate([np.zeros(0, np.uint64), *key])
            if len(key):
                yield local_rows(key, np.zeros(len(key), np.uint64), np.concatenate(rid), np.concatenate(at), buckets)

    return run


def _packed(batches):
    pack = zstandard.ZstdCompressor(level=6)
    for batch in batches:
        body = [pack.compress(b or b"") for b in batch.column("body").to_pylist()]
        yield table(rid=batch.column("rid"), packed=pa.array(body, pa.binary()))


def _opened(batches):
    """``rid``, text and marks of each row, one text at a time."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rids, marks = batch.column("rid").to_pylist(), batch.column("marks")
        for k, packed in enumerate(batch.column("packed")):
            body = unpack.decompress(packed.as_py())
            yield rids[k], np.frombuffer(body, np.uint8), np.sort(marks[k].values.to_numpy())


class _Out:
    """Rows of several texts, given to the shuffle some hundred thousand at a time."""

    def __init__(self, buckets: int):
        self.parts, self.n, self.buckets = [], 0, buckets

    def add(self, rid, key, check, at):
        self.parts.append((key, check, np.full(len(key), rid, np.int64), at))
        self.n += len(key)

    def rows(self, least: int):
        if self.n > least:
            cols = [np.concatenate(c) for c in zip(*self.parts)]
            self.parts, self.n = [], 0
            key, check, rid, at = cols
            yield local_rows(key, check, rid, at, self.buckets)


def _cells(raw: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the marked samples: ``at * 8 + q`` stands for the suffixes that begin
    ``CELL * q`` to ``CELL * q + CELL - 1`` bytes before the sample ``at``; and the sample's run."""
    found = cover(raw, np.array([0, len(raw)]))
    live = np.isin(found["at"], marks)
    at, low, high = found["at"][live], found["low"][live], found["high"][live]
    begin, end = (at - high) // CELL, (at - low) // CELL
    many = end - begin + 1
    q = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(begin, many)
    return np.unique(np.repeat(at, many) * 8 + q), np.stack([at, low, high], 1)


def _cell_names(buckets: int):
    """Round 2: the bytes that all suffixes of a cell have in common, and those that any of them has.

    The first is the key, so that cells which share it can be found, the second its check.
    """

    def run(batches):
        out = _Out(buckets)
        for rid, raw, marks in _opened(batches):
            cells, _ = _cells(raw, marks)
            h = window_hashes(raw, [CORE, HULL])
            at, q = cells >> 3, cells & 7
            begin = at - CELL * q
            core = h[CORE][begin] ^ _tags()[q]
            wide = (begin - CELL + 1 >= 0) & (begin + LENGTH <= len(raw))
            # A cell at the edge of its text has a hull of its own.
            hull = _alone(rid, cells)
            if wide.any():
                hull[wide] = h[HULL][begin[wide] - CELL + 1]
            out.add(rid, core, hull, cells)
            yield from out.rows(400_000)
        yield from out.rows(0)

    return run


def _tags() -> np.ndarray:
    return np.array([odd(200 + k) for k in range(8)], np.uint64)


def _alone(rid: int, cells: np.ndarray) -> np.ndarray:
    return spread(cells.astype(np.uint64) ^ spread(np.array([rid], np.int64).view(np.uint64)))


def _suffix_names(buckets: int):
    """Round 3: every remaining suffix by its ``LENGTH`` bytes. ``marks``: cell * 4 + kind."""

    def run(batches):
        out = _Out(buckets)
        for rid, raw, marks in _opened(batches):
            cells = marks >> 2
            own, runs = _cells(raw, np.unique(cells >> 3))
            h, check = window_hashes(raw, [LENGTH]), window_hashes(raw, [LENGTH], seed=1)
            starts = []
            by_sample = {}
            for at, low, high in runs.tolist():
                by_sample.setdefault(at, []).append((low, high))
            for cell in cells.tolist():
                first = (cell >> 3) - CELL * (cell & 7)
                for low, high in by_sample.get(cell >> 3, ()):
                    starts.append(np.arange(max(low, first - CELL + 1), min(high, first) + 1))
            p = np.unique(np.concatenate(starts)) if starts else np.zeros(0, np.int64)
            out.add(rid, h[LENGTH][p], check[LENGTH][p], p)
            yield from out.rows(400_000)
        yield from out.rows(0)

    return run


def spans(n: int, marks: np.ndarray) -> np.ndarray:
    """Removed byte ranges, flat, from marks: ``2 * cell`` (settled) or ``2 * start + 1``."""
    cell = marks[marks % 2 == 0] >> 1
    first = (cell >> 3) - CELL * (cell & 7)
    begin = np.concatenate([first - CELL + 1, marks[marks % 2 == 1] >> 1])
    end = np.concatenate([first + LENGTH, (marks[marks % 2 == 1] >> 1) + LENGTH])
    by = np.argsort(begin, kind="stable")
    begin, reach = begin[by], np.maximum.accumulate(end[by])
    if not len(begin):
        return np.zeros((0, 2), np.int64)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(begin) - 1)
    return np.stack([begin[new], reach[last]], 1)


def _removed(batches):
    for rid, raw, marks in _opened(batches):
        cut = spans(len(raw), marks)
        keep = np.ones(len(raw) + 1, np.int32)
        edge = np.zeros(len(raw) + 1, np.int32)
        np.add.at(edge, cut[:, 0], 1)
        np.add.at(edge, cut[:, 1], -1)
        keep = np.cumsum(edge)[: len(raw)] == 0
        yield table(
            rid=[rid], n_removed=[int((cut[:, 1] - cut[:, 0]).sum())], n_spans=[len(cut)],
            kept_sha256=[hashlib.sha256(raw[keep].tobytes()).hexdigest()],
            spans=pa.array([cut.ravel()], pa.list_(pa.int64())),
        )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``rid``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (byte ranges, flat, end
    exclusive) of every document that loses a byte.

    ``docs`` comes from ``rows.identified``. A byte goes when a string of ``LENGTH`` bytes over it
    also starts anywhere else, in this or another document; texts are judged as they came in.

    1. Samples (see ``cover``) are named by their first bytes and sorted; a suffix can be
       repeated only if its sample is.
    2. The suffixes of repeated samples are named in cells of ``CELL``. Where all bytes that a
       cell touches are repeated, all its suffixes are; where the bytes common to them are
       alone, none is.
    3. What is left, at the edges of repeated passages, is named suffix by suffix, together
       with one settled cell of each passage that it may repeat.

    Names are 64-bit hashes where they only exclude; a cell is settled by 64 bits for what it
    has in common and 64 for all of it, a suffix by 128. In each round a name sends one
    occurrence per batch to the shuffle, so a common passage fills no task.
    """
    buckets = buckets_for(docs)
    samples = judged(docs.select("rid", "body").mapInArrow(_samples(buckets), ROWS)).filter("several")
    marks = samples.groupBy("rid").agg(F.collect_list("at").alias("marks"))
    texts = docs.select("rid", "body").mapInArrow(_packed, "rid long, packed binary")
    texts = stage(texts.join(marks, "rid"), "suffix-texts")

    # kind 0: settled, 1: settled and the first of its cell's name, 2: alone
    judged_cells = judged(texts.mapInArrow(_cell_names(buckets), ROWS))
    kind = F.when(F.col("several"), F.col("first").cast("long")).otherwise(2)
    cells = stage(
        judged_cells.select(F.when(kind > 0, F.col("key")).alias("core"), "rid", "at", kind.alias("kind")), "cells"
    )
    open_cells = cells.filter("kind > 0")
    mixed = open_cells.groupBy("core").agg(F.count("*").alias("n"), F.max("kind").alias("most")).filter("n > 1 AND most = 2")
    needed = open_cells.join(mixed.select("core"), "core").select("rid", (F.col("at") * 4 + F.col("kind")).alias("mark"))
    left = needed.groupBy("rid").agg(F.collect_list("mark").alias("marks"))
    rest = texts.select("rid", "packed").join(left, "rid").mapInArrow(_suffix_names(buckets), ROWS)
    suffixes = judged(rest).filter("several").select("rid", (F.col("at") * 2 + 1).alias("mark"))

    settled = cells.filter("kind < 2").select("rid", (F.col("at") * 2).alias("mark"))
    found = settled.unionByName(suffixes).groupBy("rid").agg(F.collect_list("mark").alias("marks"))
    schema = "rid long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    return texts.select("rid", "packed").join(found, "rid").mapInArrow(_removed, schema)


def _whole(batches):
    for batch in batches:
        bodies = batch.column("body").to_pylist()
        yield table(
            rid=batch.column("rid"), doc_id=batch.column("doc_id"),
            n_bytes=pa.array([len(b or b"") for b in bodies], pa.int64()),
            sha=pa.array([hashlib.sha256(b or b"").hexdigest() for b in bodies], pa.string()),
        )


def suffix_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Null text is empty; rows that share an id are documents of their own, so equal rows repeat
    each other.
    """
    base = identified(docs, id_col, text_col)
    kind = dict(base.dtypes)["doc_id"]
    whole = base.select("rid", "doc_id", "body").mapInArrow(_whole, f"rid long, doc_id {kind}, n_bytes long, sha string")
    found = whole.join(repeated_spans(base).drop("spans"), "rid", "left")
    zero = F.lit(0).cast("long")
    return found.select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
