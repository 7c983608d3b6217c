"""Token ids as Parquet files that can be read in part: by document, by token range, or without the ids.

A folder holds ``tokens`` (one row per document, in ascending order of the ids, file after
file) and ``parts`` (one row per file with the number of tokens before it). Within a file a
row knows its own place, so no second pass over the ids is needed to number them.
"""

from __future__ import annotations

import os
import re
import string
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from starmill.llm.rows import joined_bytes, per_worker, pieces, table
from starmill.llm.sentencepiece_codec import model_bytes
from starmill.operators.joins import checked_broadcast

#: Words whose ids a task remembers.
REMEMBERED = 500_000
#: Bytes of text that are encoded at a time, unless one text is longer.
PIECE = 8 << 20
#: Words that one call encodes as one text.
JOINED = 200
#: Punctuation that a tokenizer keeps apart from the word before it.
CLOSING = ".,;:!?"
ALNUM = np.zeros(256, bool)
ALNUM[[ord(c) for c in string.ascii_letters + string.digits]] = True
#: First bytes of characters beyond ASCII and U+00C0 to U+00FF, which have one form each.
OTHER = np.arange(256) > 0xC3
OTHER[0xC2] = True


@dataclass(frozen=True)
class Layout:
    """How the files are laid out.

    ``ids``: ``dictionary`` (one dictionary per row group, then packed indices) or ``delta``
    (differences of neighbours, packed). The other columns are rising numbers and always
    delta-encoded. ``row_group`` and ``page`` are bytes, ``page_rows`` caps the documents of a page, so
    the page index, which is always written, can tell single documents apart.
    """

    ids: str = "dictionary"
    row_group: int = 16 << 20
    page: int = 256 << 10
    page_rows: int = 512
    codec: str = "zstd"

    def options(self) -> dict[str, str]:
        if self.ids not in ("dictionary", "delta"):
            raise ValueError("ids must be 'dictionary' or 'delta'")
        return {
            "compression": self.codec,
            "parquet.writer.version": "PARQUET_2_0",
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": str(self.ids == "dictionary").lower(),
            "parquet.dictionary.page.size": str(4 << 20),
            "parquet.block.size": str(self.row_group),
            "parquet.page.size": str(self.page),
            "parquet.page.row.count.limit": str(self.page_rows),
        }


class WordCoder:
    """Ids of whole texts from the ids of their words.

    The tokenizer splits at white space before it merges, so the words between ASCII blanks can
    be encoded apart, and so can closing punctuation after a letter or digit. Each distinct word is
    encoded once. Plain lower-case words are joined for the call, skip the normaliser and the pattern that would leave
    them as they are, and are told apart by their closing ids.
    """

    def __init__(self, model: bytes, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a task per core
        self.tokenizer = Tokenizer.from_buffer(model)
        self.joiner = Tokenizer.from_buffer(model)
        self.joiner.normalizer = normalizers.Sequence([])
        self.joiner.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix = self.tokenizer.model.end_of_word_suffix
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closing = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.closing[[i for w, i in vocabulary.items() if w.endswith(suffix)]] = True
        self.plain = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
        # Words of letters keep their ids without normaliser and pattern; else no word counts as plain.
        probe = [["zebra crossing"], ["\u00e9t\u00e9 ma\u00f1ana"], ["s t re"]]
        both = [[t.encode(x[0], add_special_tokens=False).ids for x in probe] for t in (self.tokenizer, self.joiner)]
        if not suffix or both[0] != both[1]:
            self.plain = re.compile("(?!)")
        normalizer = self.tokenizer.normalizer
        #: Whether the case of letters makes no difference.
        upper = string.ascii_uppercase + "\u00c0\u00c9\u00d1\u00d8\u00de"
        self.lowers = normalizer is not None and normalizer.normalize_str(upper) == upper.lower()
        self.end_id = end_id
        self.forget()

    def forget(self) -> None:
        """Places 0 and 1 are no word and the end of a text."""
        self.known: dict[str, int] = {}
        self.flat = np.array([self.end_id], np.int32)
        self.ends = np.array([0, 0, 1], np.int32)

    @staticmethod
    def _ids(tokenizer: Tokenizer, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """The ids of distinct new words."""
        fits = self.plain.fullmatch
        plain, others = [], []
        for w in words:
            (plain if fits(w) else others).append(w)
        order, found, sizes = [], [self.flat], [np.zeros(0, np.int64)]
        joined = [plain[k : k + JOINED] for k in range(0, len(plain), JOINED)]
        for part, ids in zip(joined, self._ids(self.joiner, [" ".join(part) for part in joined])):
            ends = np.flatnonzero(self.closing[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                order += part
                found.append(ids)
                sizes.append(np.diff(ends, prepend=0))
            else:
                others += part
        for k in range(0, len(others), 10 * JOINED):
            part = others[k : k + 10 * JOINED]
            ids = self._ids(self.tokenizer, part)
            order += part
            found += ids
            sizes.append(np.array([len(x) for x in ids], np.int64))
        first = len(self.ends) - 1
        self.known.update(zip(order, range(first, first + len(order))))
        self.flat = np.concatenate(found)
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes)).astype(np.int32)])

    def _parts(self, words: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Distinct words without their closing punctuation, in lower case where that is the tokenizer's own,
        and the number of bytes of that punctuation."""
        body = pc.ascii_rtrim(words, characters=CLOSING)
        raw, ends = joined_bytes(body)
        whole = pc.binary_length(words).to_numpy()
        size = np.diff(ends)
        # A boundary only after a letter or digit; other signs run on into punctuation.
        ends_in = raw[np.maximum(ends[1:] - 1, 0)] if len(raw) else np.zeros(len(size), np.uint8)
        before = raw[np.maximum(ends[1:] - 2, 0)] if len(raw) else ends_in
        letter = ALNUM[ends_in] | ((before == 0xC3) & (ends_in != 0x97) & (ends_in != 0xB7) & (size > 1))  # U+00C0 to U+00FF
        cut = (size > 0) & (size < whole) & letter
        if self.lowers:  # special tokens are found before the case is changed; other letters may compose with their marks
            text, at = joined_bytes(words)
            other = np.concatenate([[0], np.cumsum(OTHER[text])])
            simple = pc.and_(pa.array(other[at[1:]] == other[at[:-1]]), pc.invert(pc.match_substring(words, "<|")))
            words, body = pc.if_else(simple, pc.utf8_lower(words), words), pc.if_else(simple, pc.utf8_lower(body), body)
        return pc.if_else(pa.array(cut), body, words), np.where(cut, whole - size, 0)

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the ids of each distinct word lie."""
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.forget()
            new = words
        if new:
            self._learn(new)
        return np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text and the end id; null is the empty text."""
        split = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        body, closing = self._parts(words)
        bodies = body.dictionary_encode()
        raw, ends = joined_bytes(words)
        tails: list[str] = []
        tail = np.full(len(words), -1, np.int64)
        for n in np.unique(closing[closing > 0]).tolist():
            at = np.flatnonzero(closing == n)
            marks, which = np.unique(raw[ends[at + 1][:, None] - n + np.arange(n)].reshape(-1, n), axis=0, return_inverse=True)
            tail[at] = which.ravel() + len(tails)
            tails += [m.tobytes().decode() for m in marks]
        distinct = bodies.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = set(distinct)
        places = self._places(distinct + [t for t in tails if t not in known])
        of_tail = np.array([self.known[t] for t in tails] + [0], np.int32)[tail]
        of_word = np.stack([places[: len(distinct)][bodies.indices.to_numpy()], of_tail], axis=1)

        cuts = np.cumsum(pc.list_value_length(split).to_numpy(), dtype=np.int64)
        place = np.insert(of_word[coded.indices.to_numpy()].ravel(), 2 * cuts, 1)
        ids = pa.ListArray.from_arrays(pa.array(self.ends), pa.array(self.flat)).take(pa.array(place)).flatten()
        size = np.cumsum(np.diff(self.ends)[place], dtype=np.int64)
        ends = size[2 * cuts + np.arange(len(cuts))]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), ids)


def _rows(shared, end_id: int):
    """Rows of one range in order; ``place`` counts the tokens of the range before each."""

    def run(batches):
        coder = per_worker("tokenizers", shared.value + str(end_id).encode(), lambda: WordCoder(shared.value, end_id))
        place = 0
        for batch in batches:
            for part in pieces(batch, PIECE, "text"):
                ids = coder.encode(part.column("text"))
                n = np.diff(ids.offsets.to_numpy()).astype(np.int64)
                yield table(
                    doc_id=part.column("doc_id"), part=part.column("part"),
                    place=place + np.cumsum(n) - n, n_tokens=n, ids=ids,
                )
                place += int(n.sum())
        coder.forget()
        pa.default_memory_pool().release_unused()

    return run


def write_tokens(
    docs: DataFrame,
    model: str,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    layout: Layout = Layout(),
) -> None:
    """Encode every whole text, end it with ``end_id``, and write the ids below ``path``.

    ``model`` is the path of a ``tokenizers`` file whose words end at white space. Rows go by
    id, nulls last, then by a hash of the text; rows alike in both keep the order in which they
    were read, which also splits a very frequent id into several files. Null and empty texts have the end id only.
    A text is encoded as a whole in memory, in pieces of 8 MB of rows otherwise, so one very long
    text needs about ten times its size in its task. Other columns are left out, whatever their names.
    An empty table gives an empty folder of the same schema.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model_bytes(spark, model))
    key, text = F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    rows = docs.select(key, text, F.monotonically_increasing_id().alias("n"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("n")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["doc_id"].dataType.simpleString()
    coded = ordered.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(
        _rows(shared, end_id), f"doc_id {kind}, part int, place long, n_tokens long, ids array<int>"
    )
    coded.write.options(**layout.options()).parquet(f"{path}/tokens")
    written = spark.read.schema(coded.schema).parquet(f"{path}/tokens")
    sizes = written.groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).orderBy("part")
    parts, base = [], 0
    for row in sizes.collect():  # one row per file
        parts.append((row["part"], base, row["n_docs"], row["n_tokens"]))
        base += row["n_tokens"]
    frame = spark.createDataFrame(parts, "part int, base long, n_docs long, n_tokens long")
    frame.coalesce(1).write.parquet(f"{path}/parts")


def read_tokens(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before), ``n_tokens`` and ``ids``, or some of these.

    Without ``ids`` only the pages of the small columns are read. Filters on ``doc_id`` reach
    the row-group and page statistics.
    """
    tokens = spark.read.parquet(f"{path}/tokens")
    parts = spark.read.parquet(f"{path}/parts").select("part", "base")
    wide = tokens.join(checked_broadcast(parts), "part").withColumn("start", F.col("base") + F.col("place"))
    return wide.select(*(columns or ["doc_id", "start", "n_tokens", "ids"]))


def read_token_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """``start`` and ``ids`` of the tokens ``first`` to ``last`` (exclusive) of the whole sequence, in pieces per document.

    The parts that the range meets come from ``parts``; within them the range becomes a filter on
    ``part`` and ``place``, so files, row groups and pages beside it are not read.
    """
    tokens = spark.read.parquet(f"{path}/tokens")
    parts = spark.read.parquet(f"{path}/parts").filter((F.col("base") < last) & (F.col("base") + F.col("n_tokens") > first))
    met = parts.agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.min("base").alias("base")).first()
    if met["lo"] is None or first >= last:
        return tokens.limit(0).select(F.col("place").alias("start"), "ids")
    rows = tokens.filter(F.col("part").between(met["lo"], met["hi"]))
    if met["lo"] == met["hi"]:
        rows = rows.filter(F.col("place") < last - met["base"])
    wide = rows.join(checked_broadcast(parts.select("part", "base")), "part").withColumn("start", F.col("base") + F.col("place"))
    wide = wide.filter((F.col("start") < last) & (F.col("start") + F.col("n_tokens") > first))
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0)).cast("int")
    upto = F.least(F.lit(last) - F.col("start"), F.col("n_tokens")).cast("int")
    return wide.select((F.col("start") + skip).alias("start"), F.slice("ids", skip + 1, upto - skip).alias("ids"))


def _checks(batches):
    for batch in batches:
        ids = batch.column("ids")
        raw = memoryview(ids.flatten().to_numpy()).cast("B")  # little-endian on every platform that Arrow supports
        cuts = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(), dtype=np.int64)]) * 4
        crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        yield table(
            doc_id=batch.column("doc_id"), start=batch.column("start"), n_tokens=batch.column("n_tokens"),
            ids_crc32=pa.array(crc, pa.int64()),
        )


def token_checks(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""
    rows = read_tokens(spark, path)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_checks, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
