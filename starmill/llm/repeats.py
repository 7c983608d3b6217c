"""Which occurrences of a key are not alone, with packed shuffle rows.

Occurrences travel as one blob per batch and bucket of keys, so the shuffle moves few rows and
about a dozen bytes per occurrence. A key that a batch holds twice is settled there: one of its
occurrences stands for it and the others are spread over all buckets, so that a common key
sends one occurrence per batch to its bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from starmill.llm.hashing import spread
from starmill.llm.rows import released

ROWS = "bucket int, blob binary"
JUDGED = "key long, rid long, at long, first boolean, several boolean"
#: Documents per bucket at least; a bucket is judged in memory.
PER_BUCKET = 256


def buckets_for(docs: DataFrame) -> int:
    """A power of two that grows with the documents."""
    return 1 << max(8, int(docs.count() // PER_BUCKET).bit_length())


def _put(values: np.ndarray) -> bytes:
    """Little-endian bytes, all first bytes first, so that small numbers shrink."""
    wide = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return wide.T.tobytes()


def _get(data: bytes, at: int, n: int, kind) -> tuple[np.ndarray, int]:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T
    return np.ascontiguousarray(flat).view(kind).ravel(), at + n * size


def _blob(pack, key, check, rid, at, known) -> bytes:
    by = np.argsort(key, kind="stable")
    key, check, rid, at, known = key[by], check[by], rid[by], at[by], known[by]
    names, index = np.unique(rid, return_inverse=True)
    step = np.diff(key, prepend=np.uint64(0))
    parts = [
        np.array([len(key), len(names)], np.int64).tobytes(), _put(step), _put(check), _put(at), _put(known),
        _put(index.astype(np.uint32)), _put(names),
    ]
    return pack.compress(b"".join(parts))


def _open(data: bytes) -> tuple[np.ndarray, ...]:
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    step, at_ = _get(data, 16, n, np.uint64)
    check, at_ = _get(data, at_, n, np.uint64)
    at, at_ = _get(data, at_, n, np.int64)
    known, at_ = _get(data, at_, n, np.int8)
    index, at_ = _get(data, at_, n, np.uint32)
    names, _ = _get(data, at_, m, np.int64)
    return np.cumsum(step, dtype=np.uint64), check, names[index], at, known


def local_rows(key: np.ndarray, check: np.ndarray, rid: np.ndarray, at: np.ndarray, buckets: int) -> pa.RecordBatch:
    """The occurrences of one batch, packed. ``known``: 0 to be judged, 1 repeated here and speaking
    for its key, 2 repeated here and done."""
    by = np.lexsort((check, key))
    key, check, rid, at = key[by], check[by], rid[by], at[by]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(key)))
    known = np.full(len(key), 2, np.int8)
    known[begin] = size > 1
    bits = np.uint64(64 - (buckets - 1).bit_length())
    home = np.where(new, spread(key ^ spread(check)), spread(at.view(np.uint64) ^ spread(rid.view(np.uint64)))) >> bits
    by = np.argsort(home, kind="stable")
    home = home[by].astype(np.int64)
    key, check, rid, at, known = key[by], check[by], rid[by], at[by], known[by]
    edge = np.flatnonzero(np.diff(home, prepend=-1))
    pack = zstandard.ZstdCompressor(level=1)
    blobs = []
    for a, b in zip(edge.tolist(), np.append(edge[1:], len(home)).tolist()):
        blobs.append(_blob(pack, key[a:b], check[a:b], rid[a:b], at[a:b], known[a:b]))
    return pa.RecordBatch.from_pydict({"bucket": pa.array(home[edge], pa.int32()), "blob": pa.array(blobs, pa.binary())})


def _judge(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    key, check, rid, at, known = (np.concatenate(c) for c in zip(*parts))
    own = known < 2  # the others only pass through
    order = np.lexsort((check, key, ~own))
    key, check, rid, at, known = key[order], check[order], rid[order], at[order], known[order]
    own = known < 2
    same = (key[1:] == key[:-1]) & (check[1:] == check[:-1]) & own[1:] & own[:-1]
    first = own.copy()
    first[1:] &= ~same
    several = known > 0
    several[1:] |= same
    several[:-1] |= same
    # One that speaks for its key settles the rest of the key wherever it stands among them.
    return pa.RecordBatch.from_pydict(dict(key=key.view(np.int64), rid=rid, at=at, first=first, several=several))


def _judged(batches):
    unpack = zstandard.ZstdDecompressor()
    bucket, parts = None, []
    for batch in batches:
        for b, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob")):
            if b != bucket and parts:
                yield _judge(parts)
                parts = []
            bucket = b
            parts.append(_open(unpack.decompress(blob.as_py())))
    if parts:
        yield _judge(parts)


def judged(rows: DataFrame) -> DataFrame:
    """Every occurrence with ``several`` (its key is not alone) and ``first`` (one per key)."""
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(released(_judged), JUDGED)
