"""Spelling variants: words one edit apart, found by products of letter-count blocks.

One edit changes a word's letter counts by a squared distance of 1 (a letter more or less) or 2
(one letter for another) and its length by at most 1. All such pairs are found by matrix
products within blocks of words, and only pairs so found are compared letter by letter.

A block holds the words with the same counts of all letters of three out of five letter classes:
an edit touches two letters at most, so near words agree on three classes or more and
meet in at least one of the ten blocks that each is in. No pair is lost, and a block is small.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.hashing import GOLDEN, codes, signed, spread
from starmill.llm.rows import table
from starmill.operators.joins import checked_broadcast
from starmill.sources.staging import stage

#: The letters, all within the first 256 code points, so a word is one byte per letter.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
CLASSES = 5
COMBOS = list(combinations(range(CLASSES), CLASSES - 2))
PIECE = 1 << 20
#: Words that a task counts before it passes them on.
COUNTED = 300_000
#: Rows of one product; a block with more rows is cut into tiles and every pair of tiles multiplied.
TILE = 2048
STACK = 256


def _cut(text: bytes, breaks: re.Pattern):
    """The text in pieces of about 1 MB that end between runs."""
    at = 0
    while at < len(text):
        end = breaks.search(text, at + PIECE)
        upto = end.end() if end else len(text)
        yield text[at:upto]
        at = upto


def _counted(every: int):
    def run(batches):
        # Compiled per task. Letters beyond the first 256 code points become '?', which is no letter here.
        runs, breaks = re.compile(rb"[a-z\xc0-\xff]+"), re.compile(rb"[^a-z\xc0-\xff]")
        totals: Counter = Counter()

        def flush():
            words = pa.array([w.decode("latin-1") for w in totals], pa.string())
            out = table(word=words, n=pa.array(list(totals.values()), pa.int64()))
            totals.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = (text.as_py() or "").encode("latin-1", "replace").lower()
                start = zlib.crc32(f"{key}:".encode())
                for piece in _cut(text, breaks):
                    for word, n in Counter(runs.findall(piece)).items():
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % every == 0:
                            k = h % len(word)
                            word = word[:k] + word[k + 1 :]
                        totals[word] += n
                if len(totals) > COUNTED:
                    yield flush()
        if totals:
            yield flush()

    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 97) -> DataFrame:
    """``word`` and ``n``: the runs of letters of all whole texts, A-Z lower-cased, counted.

    A run whose checksum with its document's id is divisible by ``every`` loses one letter first (the
    injected misspellings). A null id counts as empty text, a null text has no words. Counts are
    added up within the tasks, so a word sends one row per task however common it is.
    """
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id")
    rows = docs.select(key, F.col(f"`{text_col}`").cast("string").alias("text"))
    found = rows.mapInArrow(_counted(every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(w) for w in raw], dtype=np.int64)])


def _letter_totals(batches):
    total = np.zeros(256, np.int64)
    for batch in batches:
        total += np.bincount(_bytes_of(batch.column("word"))[0], minlength=256)
    yield table(letter=pa.array(LETTERS, pa.int32()), n=total[LETTERS])


def letter_classes(words: DataFrame) -> np.ndarray:
    """A class for each byte, so that the classes share the frequent letters out evenly; others have -1."""
    totals = words.select("word").mapInArrow(_letter_totals, "letter int, n long").groupBy("letter").agg(F.sum("n").alias("n"))
    ranked = sorted((-r["n"], r["letter"]) for r in totals.collect())  # one row per letter of the alphabet
    out = np.full(256, -1, np.int64)
    for place, (_, letter) in enumerate(ranked):
        turn, k = divmod(place, CLASSES)
        out[letter] = k if turn % 2 == 0 else CLASSES - 1 - k
    return out


def _keys(classes: np.ndarray):
    def run(batches):
        code = codes(13)
        for batch in batches:
            raw, ends = _bytes_of(batch.column("word"))
            sums = []
            for c in range(CLASSES):
                run_ = np.concatenate([[np.uint64(0)], np.cumsum(np.where(classes[raw] == c, code[raw], np.uint64(0)))])
                sums.append(spread((run_[ends[1:]] - run_[ends[:-1]]) * GOLDEN + np.uint64(c)))
            for k, combo in enumerate(COMBOS):
                key = np.full(batch.num_rows, k, np.uint64)
                for c in combo:
                    key = spread(key ^ sums[c]) * GOLDEN
                yield table(
                    key=signed(key), combo=np.full(batch.num_rows, k, np.int32), word=batch.column("word"), n=batch.column("n")
                )

    return run


def _products(counts: np.ndarray, rows: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ``rows`` and ``others`` whose squared distance is at most two."""
    a, b = counts[rows], counts[others]
    squares_a, squares_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
    near = squares_a[:, None] + squares_b[None, :] - 2 * (a @ b.T) <= 2
    i, j = np.nonzero(near)
    return rows[i], others[j]


def _candidates(counts: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the groups, shorter word first, by products of adjacent length blocks.

    Rows come sorted by group and length. Small groups are stacked and share a product.
    """
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    left, right = [], []
    g = 0
    while g < len(edges) - 1:
        upto = max(g + 1, int(np.searchsorted(edges, edges[g] + STACK, side="right")) - 1)
        rows = np.arange(edges[g], edges[upto])
        if upto > g + 1:
            blocks = [(rows, rows)]
        else:
            lengths = size[rows]
            blocks = []
            for n in np.unique(lengths):
                own = rows[lengths == n]
                blocks.append((own, np.concatenate([own, rows[lengths == n + 1]])))
        for own, others in blocks:
            if len(others) > 1:
                i, j = _products(counts, own, others)
                keep = (i < j) & (group[i] == group[j]) & (size[j] - size[i] <= 1)
                left.append(i[keep])
                right.append(j[keep])
        g = upto
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _one_edit(raw: np.ndarray, ends: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the words ``i`` and ``j`` (as long, or longer by one) differ by exactly one edit."""
    size = np.diff(ends)
    out = np.zeros(len(i), bool)
    for n in np.unique(size[i]):
        at = np.flatnonzero(size[i] == n)
        step = max(1, (8 << 20) // int(n))
        for at in (at[k : k + step] for k in range(0, len(at), step)):
            a = raw[ends[i[at]][:, None] + np.arange(n)]
            longer = size[j[at]] > n
            b = raw[ends[j[at]][:, None] + np.arange(n)]
            same = a == b
            out[at] = (~same).sum(axis=1) == 1
            if longer.any():
                front = np.logical_and.accumulate(same[longer], axis=1).sum(axis=1)
                shifted = a[longer] == raw[ends[j[at][longer]][:, None] + np.arange(1, n + 1)]
                back = np.logical_and.accumulate(shifted[:, ::-1], axis=1).sum(axis=1)
                out[at[longer]] = front + back >= n
    return out


def _near_pairs(classes: np.ndarray):
    slot = np.full(256, -1, np.int64)
    slot[LETTERS] = np.arange(len(LETTERS))

    def pairs(rows: pa.Table) -> pa.RecordBatch | None:
        columns = ("key", "a", "b", "combo", "tile")
        key, a, b, combo, tile = (rows.column(c).to_numpy() for c in columns)
        raw, ends = _bytes_of(rows.column("word"))
        size = np.diff(ends)
        changed = (np.diff(key) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
        group = np.concatenate([[0], np.cumsum(changed)])
        counts = np.bincount(
            np.repeat(np.arange(len(size)), size) * len(LETTERS) + slot[raw], minlength=len(size) * len(LETTERS)
        ).reshape(len(size), -1)
        exact = np.float32 if (counts.astype(np.int64) ** 2).sum(axis=1).max() < 1 << 22 else np.float64
        counts = counts.astype(exact)
        i, j = _candidates(counts, size, group)
        across = (a[i] == b[i]) | (tile[i] != tile[j])  # a pair of two tiles meets once
        i, j = i[across], j[across]
        near = _one_edit(raw, ends, i, j)
        i, j = i[near], j[near]
        if not len(i):
            return None
        # Of the blocks that hold both, the first one speaks for the pair.
        member = np.zeros((len(LETTERS), CLASSES), exact)
        member[np.arange(len(LETTERS)), classes[LETTERS]] = 1
        agree = (np.abs(counts[i] - counts[j]) @ member) == 0
        first = np.argmax([agree[:, list(c)].all(axis=1) for c in COMBOS], axis=0)
        own = first == combo[i]
        i, j = i[own], j[own]
        word, n = rows.column("word"), rows.column("n").to_numpy()
        left, right = np.concatenate([i, j]), np.concatenate([j, i])
        return table(
            word=word.take(pa.array(left)).combine_chunks(), near=word.take(pa.array(right)).combine_chunks(), near_n=n[right]
        )

    def run(batches):
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            key, a, b = (held.column(c).to_numpy() for c in ("key", "a", "b"))
            open_ = np.flatnonzero((key != key[-1]) | (a != a[-1]) | (b != b[-1]))
            if len(open_):  # the last group may go on in the next batch
                done = pairs(held.slice(0, int(open_[-1]) + 1).combine_chunks())
                held = held.slice(int(open_[-1]) + 1).combine_chunks()
                if done is not None:
                    yield done
        if held is not None:
            done = pairs(held.combine_chunks())
            if done is not None:
                yield done

    return run


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """``word``, ``near`` and ``near_n`` for every two words that differ by one inserted, deleted or
    replaced letter, in both directions. ``words`` has distinct ``word`` (of a-z and U+00C0 to U+00FF) and ``n``.

    Each word goes to ten blocks. A block with over ``tile`` words is dealt to tiles by a hash of the word
    and each pair of tiles is a task row group of its own, so no task holds more than two tiles of one block.
    """
    classes = letter_classes(words)
    keyed = words.select("word", "n").mapInArrow(_keys(classes), "key long, combo int, word string, n long")
    big = stage(keyed.groupBy("key").agg(F.count("*").alias("size")).filter(F.col("size") > tile), "big-blocks")
    dealt = keyed.join(checked_broadcast(big), "key", "left")
    tiles = F.coalesce(F.ceil(F.col("size") / tile), F.lit(1)).cast("int")
    dealt = dealt.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    placed = dealt.select("key", "combo", "word", "n", "tile", other.alias("o")).select(
        "key", F.least("tile", "o").alias("a"), F.greatest("tile", "o").alias("b"), "tile", "combo", "word", "n"
    )
    ordered = placed.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", F.length("word"))
    return ordered.mapInArrow(_near_pairs(classes), "word string, near string, near_n long")


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and the ``root`` that its chain of forms ends in.

    Counts double along a chain, so it has fewer than 64 links and six rounds of pointer jumping do.
    """
    step = forms
    for turn in range(6):
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = step.join(on, "root", "left")
        step = stage(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), f"roots-{turn}")
        if step.filter("moved").isEmpty():
            break
        step = step.select("word", "root")
    return step.select("word", "root")


def spelling_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3, every: int = 97
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of at least ``min_chars``
    letters with at least ``min_count`` occurrences.

    ``form`` is the near word of largest count (ties: smallest word) if that is twice the word's own
    at least, ``root`` the end of the chain of forms. Whole texts count, very long ones in pieces; other columns
    and their names do not matter; repeated rows and rows that share an id, or have none, all count. An
    empty table has no words.
    """
    counted = word_counts(docs, id_col, text_col, every)
    words = stage(counted.filter((F.length("word") >= min_chars) & (F.col("n") >= min_count)), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), "near"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    leads = -F.col("best.rank") >= 2 * F.col("n")
    judged = stage(
        joined.select(
            "word", F.when(leads, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(leads, -F.col("best.rank")).alias("form_n"),
        ),
        "spelling",
    )
    roots = _roots(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
