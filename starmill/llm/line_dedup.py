"""Line deduplication by first occurrence, as compressed keep bitmaps per document."""

from __future__ import annotations

import hashlib
import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.hashing import GOLDEN, signed, spread
from starmill.llm.rows import identified, released, table
from starmill.sources.staging import stage

BLANKS = b" \t\n\x0b\x0c\r"
OCCURRENCES = "hi long, lo long, rid long, known boolean, lines array<int>"


def _long_enough(key: bytes, least: int) -> bool:
    """At least ``least`` code points; a code point has four bytes at most."""
    return len(key) >= 4 * least or len(key) >= least and len(key.decode("utf-8", "replace")) >= least


def _grouped(values: np.ndarray, first: np.ndarray) -> pa.Array:
    offsets = np.append(np.flatnonzero(first), len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _occurrences(least: int):
    """Per batch and key only the smallest document goes on to the shuffle; the lines of the
    others are already known to go. So a key sends one row per batch, however common it is."""

    def run(batches):
        for batch in batches:
            # A few dozen bytes a line: no list of all texts, and no object for a line.
            keys, rid, line = bytearray(), array("q"), array("q")
            for r, body in zip(batch.column("rid").to_pylist(), batch.column("body")):
                for k, text in enumerate((body.as_py() or b"").split(b"\n")):
                    key = text.strip(BLANKS).lower()
                    if _long_enough(key, least):
                        keys += xxhash.xxh3_128_digest(key)
                        rid.append(r)
                        line.append(k)
            if not keys:
                continue
            h = np.frombuffer(keys, ">i8").astype(np.int64).reshape(-1, 2)
            rid, line = np.frombuffer(rid, np.int64), np.frombuffer(line, np.int64)
            by = np.lexsort((line, rid, h[:, 1], h[:, 0]))
            hi, lo, rid, line = h[by, 0], h[by, 1], rid[by], line[by]
            new = np.ones(len(hi), bool)
            new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            lead = rid[np.flatnonzero(new)][np.cumsum(new) - 1]
            kept = rid == lead
            first = new[kept]
            yield table(
                hi=hi[kept][first], lo=lo[kept][first], rid=rid[kept][first],
                known=np.zeros(int(first.sum()), bool), lines=_grouped(line[kept], first),
            )
            if not kept.all():
                r, n = rid[~kept], line[~kept]
                by = np.lexsort((n, r))
                r, n = r[by], n[by]
                first = np.ones(len(r), bool)
                first[1:] = r[1:] != r[:-1]
                anywhere = signed(spread(r[first].view(np.uint64) * GOLDEN))
                yield table(
                    hi=anywhere, lo=anywhere, rid=r[first], known=np.ones(len(anywhere), bool), lines=_grouped(n, first)
                )

    return run


def _after_first(batches):
    """Rows in order of key and document: all but the first document of a key lose these lines."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo, rid = (batch.column(c).to_numpy() for c in ("hi", "lo", "rid"))
        known = batch.column("known").to_numpy(zero_copy_only=False)
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        lead = rid[np.flatnonzero(new)][np.cumsum(new) - 1]
        if last is not None and (hi[0], lo[0]) == last[:2]:
            lead = np.where(np.cumsum(new) == 1, last[2], lead)
        drop = known | (rid != lead)
        last = (hi[-1], lo[-1], lead[-1])
        yield table(rid=rid[drop], lines=batch.column("lines").filter(pa.array(drop)))


def line_drops(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``rid`` and the sorted line numbers it loses; documents that keep all lines have no row."""
    found = stage(
        docs.select("rid", "body").mapInArrow(released(_occurrences(min_chars)), OCCURRENCES), "line-keys"
    )
    ordered = found.repartitionByRange("hi", "lo").sortWithinPartitions("hi", "lo", "rid")
    lost = ordered.mapInArrow(released(_after_first), "rid long, lines array<int>")
    return lost.groupBy("rid").agg(F.array_sort(F.flatten(F.collect_list("lines"))).alias("lines"))


def _bitmaps(batches):
    for batch in batches:
        maps, dropped = [], []
        for lines in batch.column("lines").to_pylist():
            keep = np.ones((lines[-1] // 8 + 1) * 8, bool)
            keep[lines] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 6))
            dropped.append(len(lines))
        yield table(rid=batch.column("rid"), n_dropped=pa.array(dropped, pa.int64()), keep=pa.array(maps, pa.binary()))


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``rid``, ``n_dropped`` and ``keep``: a deflated bit per line up to the last dropped one,
    most significant bit first, 0 for a line that goes. Lines beyond the map stay.

    ``docs`` comes from ``rows.identified``. A line's key is the line without blanks at its
    ends, A-Z lower-cased; keys of at least ``min_chars`` code points that several documents
    hold stay only in the one with the smallest id (all its lines of that key). Keys are
    compared by 128-bit hash. Documents without a loss have no row. Null text is one empty
    line; rows that share an id, or have none, are documents of their own in id order.
    """
    return line_drops(docs, min_chars).mapInArrow(released(_bitmaps), "rid long, n_dropped long, keep binary")


def kept_lines(body: bytes | None, keep: bytes | None) -> tuple[list[bytes], int]:
    """The lines that stay, and the number of lines before."""
    lines = (body or b"").split(b"\n")
    if keep is None:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)].tolist()
    bits += [1] * (len(lines) - len(bits))
    return [line for line, bit in zip(lines, bits) if bit], len(lines)


def with_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Every row of ``docs`` with its ``n_dropped`` and ``keep`` (null: all lines stay)."""
    return docs.join(keep_bitmaps(docs, min_chars), "rid", "left")


def _digests(batches):
    for batch in batches:
        n, sha = [], []
        for body, keep in zip(batch.column("body").to_pylist(), batch.column("keep").to_pylist()):
            lines, before = kept_lines(body, keep)
            n.append(before)
            sha.append(hashlib.sha256(b"\n".join(lines)).hexdigest())
        yield table(
            doc_id=batch.column("doc_id"), n_lines=pa.array(n, pa.int64()),
            n_dropped=batch.column("n_dropped").fill_null(0), kept_sha256=sha,
        )


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_dropped``, ``kept_sha256``."""
    base = identified(docs, id_col, text_col)
    kind = dict(base.dtypes)["doc_id"]
    return with_bitmaps(base, min_chars).select("doc_id", "body", "n_dropped", "keep").mapInArrow(
        released(_digests), f"doc_id {kind}, n_lines long, n_dropped long, kept_sha256 string"
    )


def _rewritten(batches):
    for batch in batches:
        out = []
        for body, keep in zip(batch.column("body"), batch.column("keep").to_pylist()):
            out.append(b"\n".join(kept_lines(body.as_py(), keep)[0]).decode("utf-8", "replace") if keep is not None else None)
        yield table(row=batch.column("row"), kept=pa.array(out, pa.string()))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated lines taken out of the text."""
    base = with_bitmaps(identified(docs, id_col, text_col, whole=True), min_chars)
    row = base.schema["row"].dataType.simpleString()
    body = F.col(f"row.`{text_col}`").cast("binary").alias("body")  # the text moves once, within its row
    done = base.select("row", body, "keep").mapInArrow(released(_rewritten), f"row {row}, kept string")
    fields = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != text_col]
    text = F.coalesce("kept", F.col(f"row.`{text_col}`")).alias(text_col)
    return done.select(*fields, text).select(*[F.col(f"`{c}`") for c in docs.columns])
