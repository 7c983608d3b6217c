"""Row keys and Arrow helpers that the operators share."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.staging import stage

INTEGERS = ("tinyint", "smallint", "int", "bigint")


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> DataFrame:
    """``rid`` (unique long, in the order of the ids), ``doc_id``, ``body`` (UTF-8 bytes)
    and, on request, ``row`` (all columns as one struct, so names cannot clash).

    Where the ids are unique integers they are the keys. Otherwise (repeated or null
    ids, other types) the rows are sorted by id once, numbered and written, nulls last;
    each row then counts as a document of its own. Only ids are shuffled to tell.
    """
    key, body = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("binary")
    picked = [key.alias("doc_id"), body.alias("body")] + ([F.struct("*").alias("row")] if whole else [])
    wide = docs.select(*picked)
    if dict(wide.dtypes)["doc_id"] in INTEGERS:
        repeated = docs.select(key.alias("id")).groupBy("id").count().filter("count > 1 OR id IS NULL")
        if repeated.isEmpty():
            return wide.withColumn("rid", F.col("doc_id").cast("long"))
    ordered = wide.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("body"))
    return stage(ordered.withColumn("rid", F.monotonically_increasing_id()), "numbered")


def joined_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column one after another, and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null(b"") if column.null_count else column
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]] if len(offsets) else raw[:0], offsets - (offsets[0] if len(offsets) else 0)


def pieces(batch: pa.RecordBatch, limit: int = 1 << 20, column: str = "body"):
    """The batch cut into runs of rows with about ``limit`` bytes of text each; a longer text stands alone."""
    sizes = batch.column(column)
    ends = joined_bytes(sizes)[1]
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1
        upto = min(batch.num_rows, max(at + 1, upto))
        yield batch.slice(at, upto - at)
        at = upto


def table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def give_back() -> None:
    """Return what Arrow, numpy and the tokenizers no longer use to the system (the C heap with glibc only)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def released(run: Callable, keeps: str = "") -> Callable:
    """``run``, before which its worker drops what ``per_worker`` holds under other names than ``keeps``,
    and after which it gives back what the task held.

    Workers live on from task to task, stage to stage and query to query; without this each of them
    keeps the most that any task before took.
    """

    def wrapped(batches):
        state = _worker_state()
        for name in [n for n in state if not n.startswith("__") and n != keeps]:
            del state[name]
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def _worker_state() -> dict:
    return vars(sys.modules.setdefault("starmill_worker_state", types.ModuleType("starmill_worker_state")))


def per_worker(name: str, key: bytes, make: Callable):
    """What ``make`` builds, kept by the Python worker for its next tasks as long as the key is the same.

    Functions come to a worker by value, so a module of this package cannot hold it.
    """
    state = _worker_state()
    known = state.get(name)
    if known is None or known[0] != key:
        known = (key, make())
        state[name] = known
    return known[1]


def send(spark: SparkSession, value) -> Callable:
    """Broadcast an object of this package; the function returned gives it to a task.

    A broadcast alone names the classes of what it holds by module, and a worker need not have this
    package. Packed first, they travel by value like the functions that use them.
    """
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(packed.value)
