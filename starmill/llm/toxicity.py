"""Toxic passages as maximum-scoring segments of token log-odds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.hashing import GOLDEN, codes, lower_table, spread, words
from starmill.llm.rows import give_back, identified, joined_bytes, pieces, released, send, table
from starmill.sources.staging import stage

#: ASCII characters that are not letters separate tokens; every other character belongs to one.
SEPARATORS = bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
STEM_BYTES = 4
#: Bytes of text made into tokens at a time; an array of a number per byte is eight times as long.
PIECE = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``bits``: 2**bits hashed features, the bound of the model. ``sample``: labelled rows that
    train it at most, those with the smallest hash of their id. ``prior``: weight of the
    Dirichlet prior in tokens. ``shrink``: standard errors taken off a log-odds ratio.
    ``drift``: score of a token that says nothing. ``cap``: most that one token can say. ``significance``: expected number of
    clean segments as good, up to which a segment is a toxic passage."""

    bits: int = 20
    sample: int = 131_072
    prior: float = 2000.0
    shrink: float = 2.0
    drift: float = -0.5
    cap: float = 8.0
    significance: float = 0.02


@dataclass(frozen=True)
class Model:
    settings: Settings
    weights: np.ndarray
    rate: float  # extreme values: the best segment of n clean tokens exceeds s with
    scale: float  # probability 1 - exp(-scale * n * exp(-rate * s))
    slope: float
    intercept: float


def tokens(raw: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word and stem (first four bytes) of each token, and where each text's tokens begin."""
    texts = len(offsets) - 1
    spaced = np.zeros(len(raw) + texts, np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(texts), np.diff(offsets))] = raw
    lower = lower_table(SEPARATORS)
    begin, end, h = words(spaced, lower, seed=11)
    stem = np.zeros(len(begin), np.uint64)
    code = codes(12)
    for j in range(STEM_BYTES):
        live = begin + j < end
        byte = lower[spaced[np.minimum(begin + j, max(len(spaced) - 1, 0))]]
        stem = np.where(live, (stem ^ code[byte]) * GOLDEN, stem)
    mask = np.uint64((1 << bits) - 1)
    return (h & mask).astype(np.int64), (spread(stem) & mask).astype(np.int64), np.searchsorted(begin, offsets + np.arange(texts + 1))


def _counts(bits: int):
    """Texts per hashed feature and class, summed over the task before the shuffle. A text counts
    once for a feature, so one text that repeats a word does not make it typical."""

    def run(batches):
        totals = np.zeros((2, 2, 1 << bits), np.int32)
        for batch in batches:
            label = batch.column("label").to_numpy()
            for part, own in zip(pieces(batch, PIECE), _cut(batch, label)):
                word, stem, first = tokens(*joined_bytes(part.column("body")), bits)
                text = np.repeat(np.arange(len(own)), np.diff(first))
                for kind, feature in enumerate((word, stem)):
                    once = np.unique((text << bits) | feature)
                    label_of = own[once >> bits]
                    for y in (0, 1):
                        at, n = np.unique(once[label_of == y] & ((1 << bits) - 1), return_counts=True)
                        totals[kind, y, at] += n.astype(np.int32)
        for kind in (0, 1):
            at = np.flatnonzero(totals[kind].any(axis=0))
            yield table(
                kind=np.full(len(at), kind, np.int32), feature=at.astype(np.int32),
                clean=totals[kind, 0, at].astype(np.int64), toxic=totals[kind, 1, at].astype(np.int64),
            )

    return run


def _cut(batch: pa.RecordBatch, values: np.ndarray):
    at = 0
    for part in pieces(batch, PIECE):
        yield values[at : at + part.num_rows]
        at += part.num_rows


def log_odds(summed: DataFrame, how: Settings) -> DataFrame:
    """``kind``, ``feature``, ``weight``: log-odds ratio of each feature under a Dirichlet prior in
    proportion to its overall use, moved towards zero by ``shrink`` standard errors. Features
    that end at zero have no row, so little reaches the driver."""
    totals = summed.groupBy("kind").agg(
        F.sum("clean").alias("all_clean"), F.sum("toxic").alias("all_toxic"), F.count("*").alias("features")
    )
    prior = how.prior * (F.col("clean") + F.col("toxic")) / (F.col("all_clean") + F.col("all_toxic")) + 0.05
    rows = summed.join(F.broadcast(totals), "kind")  # one row per kind
    rows = rows.withColumn("t", F.col("toxic") + prior).withColumn("c", F.col("clean") + prior)
    whole = how.prior + 0.05 * F.col("features")
    ratio = F.log(F.col("t") / (F.col("all_toxic") + whole - F.col("t"))) - F.log(
        F.col("c") / (F.col("all_clean") + whole - F.col("c"))
    )
    error = how.shrink * F.sqrt(1 / F.col("t") + 1 / F.col("c"))
    weight = F.signum(ratio) * F.greatest(F.lit(0.0), F.abs(ratio) - error)
    return rows.select("kind", "feature", weight.alias("weight")).filter("weight <> 0")


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(begin, end, sum)`` in linear time.

    Tokens below zero are passed in one step: only runs of positive tokens are visited.
    Each run joins the earlier candidates it can extend, as in the all-maximal-segments scan.
    """
    positive = score > 0
    if not positive.any():
        return []
    edge = np.diff(np.concatenate([[0], positive.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([[0.0], np.cumsum(score)])
    found: list[tuple[int, int, float, float, int]] = []  # begin, end, left sum, right sum, nearest lower to the left
    for b, e in zip(begin.tolist(), end.tolist()):
        left, right = float(sums[b]), float(sums[e])
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0 or found[j][3] >= right:
                found.append((b, e, left, right, j))
                break
            b, left = found[j][0], found[j][2]
            del found[j:]
    return [(b, e, right - left) for b, e, left, right, _ in found]


def token_scores(word: np.ndarray, stem: np.ndarray, weights: np.ndarray, how: Settings) -> np.ndarray:
    """A token counts by its stronger feature; the drift makes a neutral text score below zero."""
    w, s = weights[0][word], weights[1][stem]
    best = np.where(np.abs(w) >= np.abs(s), w, s)
    return np.clip(best, -how.cap, how.cap) + how.drift


def _scan(part: pa.RecordBatch, weights: np.ndarray, how: Settings):
    word, stem, first = tokens(*joined_bytes(part.column("body")), how.bits)
    score = token_scores(word, stem, weights, how)
    for k in range(part.num_rows):
        own = slice(first[k], first[k + 1])
        yield segments(score[own]), int(first[k + 1] - first[k])


def evidence(found: list[tuple[int, int, float]]) -> float:
    """Sum of all segments from the best down, each next one at half the weight of the one before."""
    best = np.sort(np.array([s for _, _, s in found], np.float64))[::-1]
    return float((best * np.exp2(-np.arange(len(best), dtype=np.float64))).sum())


def _best_segments(shared, how: Settings):
    def run(batches):
        weights = shared.value
        for batch in batches:
            label = batch.column("label").to_numpy()
            for part, own in zip(pieces(batch, PIECE), _cut(batch, label)):
                best, n = [], []
                for found, size in _scan(part, weights, how):
                    best.append(evidence(found))
                    n.append(size)
                yield table(label=own.astype(np.int32), best=np.array(best, np.float64), n=np.array(n, np.int64))

    return run


def train(docs: DataFrame, labels: DataFrame, how: Settings = Settings()) -> Model:
    """Fit on the labelled rows given, at most ``how.sample`` of them. ``docs``: ``doc_id``, ``body``; ``labels``: ``doc_id``, ``label``.

    Counts are sums over all training rows; the driver sees the features with a weight, at most
    2**bits by kind.
    The extreme-value law is fitted by moments to the best segments of clean rows; the last
    step maps log significance to a probability with a logistic curve over binned rows.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).dropna().dropDuplicates(["doc_id"])
    wanted = known.orderBy(F.xxhash64("doc_id")).limit(how.sample)  # ids and labels only, so small enough to send
    rows = docs.join(F.broadcast(wanted), "doc_id").select("body", "label")
    weights = np.zeros((2, 1 << how.bits))
    counted = rows.mapInArrow(released(_counts(how.bits)), "kind int, feature int, clean long, toxic long")
    summed = counted.groupBy("kind", "feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = log_odds(stage(summed, "feature-counts"), how).toPandas()
    weights[found["kind"].to_numpy(np.int64), found["feature"].to_numpy(np.int64)] = found["weight"].to_numpy(float)
    weights = weights.astype(np.float32)
    best = rows.mapInArrow(released(_best_segments(spark.sparkContext.broadcast(weights), how)), "label int, best double, n long")
    # A table bounded by its bins: score in tenths up to a cap, length in powers of two.
    binned = best.groupBy(
        "label", F.round(F.least("best", F.lit(100.0)), 1).alias("s"), F.floor(F.log2(F.col("n") + 1.0)).alias("size")
    ).agg(F.count("*").alias("rows"), F.avg("n").alias("n")).toPandas()
    rate, scale = _extreme_values(binned[binned["label"] == 0])
    x = _significance(binned["s"].to_numpy(), binned["n"].to_numpy(), rate, scale)
    slope, intercept = _logistic(x, binned["label"].to_numpy(float), binned["rows"].to_numpy(float))
    return Model(how, weights, rate, scale, slope, intercept)


def _extreme_values(clean) -> tuple[float, float]:
    """Rate and scale of the law of best clean segments, from mean and spread of ``s - log(n)/rate``."""
    if not len(clean) or clean["rows"].sum() < 2:
        return 1.0, 0.01
    s, n, w = clean["s"].to_numpy(), np.maximum(clean["n"].to_numpy(), 1), clean["rows"].to_numpy(float)
    rate = 1.0
    for _ in range(20):
        x = s - np.log(n) / rate
        mean = np.average(x, weights=w)
        spread_ = np.sqrt(max(np.average((x - mean) ** 2, weights=w), 1e-4))
        rate = float(np.clip(np.pi / np.sqrt(6) / spread_, 0.05, 5.0))
    return rate, float(np.exp(np.clip(rate * mean - 0.5772, -20, 20)))


def _significance(s: np.ndarray, n: np.ndarray, rate: float, scale: float) -> np.ndarray:
    """Minus the log of the expected number of clean segments this good in a text of this length."""
    return np.clip(rate * np.asarray(s, float) - np.log(scale) - np.log(np.maximum(n, 1.0)), -30, 30)


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic curve by Newton steps; a slope below zero is not allowed."""
    if not len(x) or not (w * y).sum() or not (w * (1 - y)).sum():
        return 1.0, -4.0
    a, b = 0.5, -1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        v = w * p * (1 - p) + 1e-9
        ga, gb = (w * (y - p) * x).sum() - 0.01 * a, (w * (y - p)).sum()
        haa, hab, hbb = (v * x * x).sum() + 0.01, (v * x).sum(), v.sum()
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 2.0 / max(abs(da), abs(db), 1e-12))
        a, b = a + step * da, b + step * db
        if abs(da) + abs(db) < 1e-8:
            break
    return float(max(a, 0.01)), float(b)


def _judged(part: pa.RecordBatch, model: Model) -> tuple[list[float], list[list[int]], list[int]]:
    """Score, significant passages and number of tokens of each text."""
    how = model.settings
    score, spans, total = [], [], []
    for found, n in _scan(part, model.weights, how):
        best = evidence(found)
        x = _significance(np.array([s for _, _, s in found]), n, model.rate, model.scale)
        real = [(b, e) for (b, e, _), v in zip(found, x) if v >= -np.log(how.significance)]
        top = float(_significance(np.array([best]), n, model.rate, model.scale)[0])
        score.append(1 / (1 + np.exp(-np.clip(model.slope * top + model.intercept, -30, 30))))
        spans.append([p for span in real for p in span])
        total.append(n)
    return score, spans, total


def _scored(shared):
    def run(batches):
        model = shared()
        for batch in batches:
            for part in pieces(batch, PIECE):
                score, spans, total = _judged(part, model)
                yield table(
                    rid=part.column("rid"), doc_id=part.column("doc_id"), score=np.array(score, np.float64),
                    n_tokens=np.array(total, np.int64), passages=pa.array(spans, pa.list_(pa.int32())),
                )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``rid``, ``doc_id``, ``score`` (0 to 1), ``n_tokens`` and ``passages`` (token ranges of the
    significant segments, flat, end exclusive), one row per row of ``docs`` from ``rows.identified``.

    Null and empty texts have no token and get the score of a text without a segment.
    """
    kind = dict(docs.dtypes)["doc_id"]
    shared = send(docs.sparkSession, model)
    schema = f"rid long, doc_id {kind}, score double, n_tokens long, passages array<int>"
    return docs.select("rid", "doc_id", "body").mapInArrow(released(_scored(shared)), schema)


def fold(id_col: str = "doc_id"):
    """Remainder by 3 of the CRC of the id as text; 1 is held out. A null id falls to 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(3)), F.lit(0))


def train_labelled(base: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", how: Settings = Settings()) -> Model:
    """A model from the labelled rows that are not held out."""
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
    return train(base, known.filter(fold() != 1), how)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, and the number of significant passages.

    Rows without a label, or with a null one, train nothing; a document labelled twice counts
    once per label table row kept by its id. Every row of ``docs`` is scored, very long texts as a whole: the scan
    keeps only open segments.
    """
    base = identified(docs, id_col, text_col)
    model = train_labelled(base, labels, "toxic", id_col)
    return score(base, model).select(
        "doc_id", (fold() == 1).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        (F.size("passages") / 2).cast("long").alias("n_passages"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns. Only texts go to Python and one
    bit each comes back, so a worker holds no other column and no text twice."""
    body = F.col(f"`{text_col}`").cast("binary")
    model = train_labelled(docs.select(F.col(f"`{id_col}`").alias("doc_id"), body.alias("body")), labels, "toxic", id_col)
    return docs.filter(_below(send(docs.sparkSession, model), threshold)(body))


def _below(shared, threshold: float):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared()
        for body in texts:
            score = [np.array(_judged(part, model)[0], np.float64) for part in pieces(table(body=body), PIECE)]
            yield pa.array(np.concatenate([np.zeros(0), *score]) < threshold)
        give_back()

    return F.arrow_udf(run, "boolean")
