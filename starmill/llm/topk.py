"""Exact top-k inner-product search in the MaxScore manner."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.rows import table
from starmill.sources.staging import stage

#: Whole numbers up to here, and sums of them, are exact in double arithmetic.
EXACT = float(1 << 53)
RESULT = "query long, query_id long, vec_id long, score long"


def quantised(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their components as whole numbers ``floor(scale * x)``, padded with 0."""
    keep, rows = [], []
    for k, x in enumerate(column.to_pylist()):
        if x is None or any(v is None for v in x):
            continue
        v = np.array(x, np.float64)
        if np.isfinite(v).all():
            keep.append(k)
            rows.append(np.floor(scale * v))
    width = max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    return np.array(keep, np.int64), out


def _fit(x: np.ndarray, width: int) -> np.ndarray:
    return x[:, :width] if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of whole numbers: in doubles where every sum fits, else in Python integers."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < EXACT:
        return np.rint(a @ b.T).astype(np.int64)
    exact = np.array([[int(v) for v in r] for r in a], object) @ np.array([[int(v) for v in r] for r in b], object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Best:
    """The k best of each query so far, ties to the smaller id; ``floor`` is what a newcomer must reach."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries

    def floor(self, q: int) -> int | None:
        return int(self.score[q][-1]) if len(self.score[q]) == self.k else None

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[q], score]), np.concatenate([self.ids[q], ids])
        by = np.lexsort((ids, -score.astype(object) if (score == np.iinfo(np.int64).min).any() else -score))[: self.k]
        self.score[q], self.ids[q] = score[by], ids[by]


class Postings:
    """One shard of vectors by component: for each term the rows that have it and their values.

    A term that most rows have is kept as a plain column, others as row numbers with values. ``high``
    and ``low`` bound what a term can be in this shard, 0 included where a row lacks it.
    """

    def __init__(self, vectors: np.ndarray):
        self.rows, self.width = vectors.shape
        self.largest = float(np.abs(vectors).max()) if vectors.size else 0.0
        self.columns = np.ascontiguousarray(vectors.T)
        self.high, self.low = self.columns.max(axis=1, initial=-np.inf), self.columns.min(axis=1, initial=np.inf)
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for term in np.flatnonzero((self.columns != 0).sum(axis=1) * 2 < self.rows).tolist():
            at = np.flatnonzero(self.columns[term])
            self.lists[term] = (at, self.columns[term, at])

    def scored(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """What the given terms add up to for every row."""
        dense = np.array([t for t in terms.tolist() if t not in self.lists], np.int64)
        out = weight[dense] @ self.columns[dense] if len(dense) else np.zeros(self.rows)
        for t in terms.tolist():
            if t in self.lists:
                at, value = self.lists[t]
                out[at] += weight[t] * value
        return out

    def probe(self, rows: np.ndarray, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The same for some rows only."""
        return weight[terms] @ self.columns[np.ix_(terms, rows)]


def _search(queries: np.ndarray, own_keys: np.ndarray, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray, best: Best) -> None:
    """MaxScore over one shard of vectors; a query's own vector, known by its key, is left out.

    The terms of a query are its components. A term's bound is the most it can add in this
    shard, above what every vector gets from it. Terms are non-essential from the small end as
    long as all their bounds together cannot lift a vector over the floor by themselves; the postings of
    the essential terms are traversed, and only vectors that can still reach the floor are probed on the others.
    """
    width = max(queries.shape[1], vectors.shape[1])
    queries, vectors = _fit(queries, width), _fit(vectors, width)
    if not len(vectors):
        return
    postings = Postings(vectors)
    exact = not width or np.abs(queries).max() * postings.largest * width < EXACT
    for q in range(len(queries)):
        own = queries[q]
        most = np.maximum(own * postings.high, own * postings.low)
        base = np.minimum(own * postings.high, own * postings.low)
        floor = best.floor(q)
        order = np.argsort(-(most - base), kind="stable")
        if floor is None or not exact:
            live, score = np.arange(len(ids)), _dot(own[None], vectors)[0]
        else:
            rest = np.cumsum((most - base)[order][::-1])[::-1]  # what the terms from here on can still move
            slack = floor - base.sum()
            # Without the essential terms no vector reaches the floor.
            essential = order[: max(1, int((rest >= slack).sum()))]
            others = order[len(essential) :]
            part = postings.scored(essential, own)
            live = np.flatnonzero(part + most[others].sum() >= floor)
            score = np.rint(part[live] + postings.probe(live, others, own)).astype(np.int64)
        known = own_keys[q] != keys[live]
        best.add(q, score[known], ids[live][known])


def _shards(shared, k: int, rows: int = 4096):
    """The best of each query over the vectors of a task; ``rows`` vectors make a shard."""

    def run(batches):
        query, own_keys, names, queries = shared.value
        best = Best(len(names), k)
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                part = batch.slice(a, rows)
                _search(queries, own_keys, part.column("key").to_numpy(), part.column("id").to_numpy(), _matrix(part.column("numbers")), best)
        many = np.array([len(s) for s in best.score], np.int64)
        if many.sum():
            yield table(
                query=np.repeat(query, many), query_id=np.repeat(names, many), vec_id=np.concatenate(best.ids),
                score=np.concatenate(best.score),
            )

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of whole numbers as rows, padded with 0."""
    size = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max(initial=0))
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = flat
    return out


def _whole_numbers(scale: int):
    def run(batches):
        for batch in batches:
            keep, numbers = quantised(batch.column("vector"), scale)
            size = batch.column("vector").take(pa.array(keep)).value_lengths().to_numpy()
            flat = numbers[np.arange(numbers.shape[1]) < size[:, None]]
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat, pa.float64()))
            yield table(
                key=batch.column("key").take(pa.array(keep)), id=batch.column("id").take(pa.array(keep)),
                asks=batch.column("asks").take(pa.array(keep)), numbers=lists,
            )

    return run


def top_k(vectors: DataFrame, queries: DataFrame | Column, k: int = 5, scale: int = 256, block: int = 4096) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: for each query the ``k`` other vectors
    with the highest whole-number inner product, ties to the smaller id.

    ``vectors`` has ``id`` (long) and ``vector`` (array). ``queries`` is a condition on them: each row that meets it is a
    query of its own and every other row a candidate, also rows that share its id. Or it is a frame of the same
    columns: then vectors of a query's id are its own, and of query rows with one id the smallest vector counts.

    The whole numbers are made and written once. Queries are taken in blocks of ``block``, each sent to all executors
    (``block`` vectors at most), so there may be any number; only the best ``k`` of each task and query move.
    Components missing at the end of a shorter vector count as 0. Vectors that are null or hold
    a null or non-finite component, and rows without an id, take no part. A score
    beyond the range of a long takes its nearest end. An empty table has no result.
    """
    spark = vectors.sparkSession
    asks = queries if isinstance(queries, Column) else F.lit(False)
    rows = vectors.select(
        F.monotonically_increasing_id().alias("key"), F.col("id").cast("long").alias("id"), "vector",
        F.coalesce(asks, F.lit(False)).alias("asks"),
    ).dropna(subset=["id"])
    schema = "key long, id long, asks boolean, numbers array<double>"
    whole = stage(rows.mapInArrow(_whole_numbers(scale), schema), "whole-numbers")
    if isinstance(queries, Column):
        wanted, key = whole.filter("asks").select(F.col("key").alias("query"), "id", "key", "numbers"), "key"
    else:
        own = queries.select(F.col("id").cast("long").alias("id"), "vector").dropna()
        own = own.groupBy("id").agg(F.min("vector").alias("vector")).select(F.col("id").alias("key"), "id", "vector", F.lit(True).alias("asks"))
        wanted = stage(own.mapInArrow(_whole_numbers(scale), schema), "queries")
        wanted, key = wanted.select(F.col("id").alias("query"), "id", "key", "numbers"), "id"
    candidates = whole.select(F.col(key).alias("key"), "id", "numbers")
    blocks = max(1, -(-wanted.count() // block))
    found = None
    for b in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == b).toArrow()
        arrays = [part.column(c).combine_chunks().to_numpy() for c in ("query", "key", "id")]
        shared = spark.sparkContext.broadcast((*arrays, _matrix(part.column("numbers").combine_chunks())))
        best = candidates.mapInArrow(_shards(shared, k), RESULT)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
