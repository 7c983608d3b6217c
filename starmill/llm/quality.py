"""Quality classifier: hashed word n-grams, logistic regression, FTRL-proximal updates."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.hashing import odd, shingles, spread, words
from starmill.llm.rows import identified, joined_bytes, pieces, table
from starmill.llm.toxicity import fold

BLANKS = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    """``bits``: 2**bits weights, the bound of the model. ``sample``: labelled rows that train it
    at most, those with the smallest hash of their id. ``shards``: learners that each see a part
    of them and are averaged. The rest are the usual FTRL settings."""

    bits: int = 18
    sample: int = 16_384
    shards: int = 8
    epochs: int = 6
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 1.0


def kinds() -> np.ndarray:
    """Byte classes of a word's shape: lower, upper, digit, other letter bytes, and each mark by itself."""
    table_ = np.arange(256, dtype=np.uint8)
    table_[ord("a") : ord("z") + 1] = 1
    table_[ord("A") : ord("Z") + 1] = 2
    table_[ord("0") : ord("9") + 1] = 3
    table_[0x80:] = 4
    return table_


def features(part: pa.RecordBatch, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of each text and their values, of length one together.

    Features are word n-grams (one and two words) and the same of word shapes: the shape of a
    word is its byte classes without repeats, so that marks and case show apart from the word.
    """
    raw, offsets = joined_bytes(part.column("body"))
    texts = len(offsets) - 1
    spaced = np.full(len(raw) + texts, BLANKS[0], np.uint8)
    spaced[np.arange(len(raw)) + np.repeat(np.arange(texts), np.diff(offsets))] = raw
    as_is = np.arange(256, dtype=np.uint8)
    as_is[np.frombuffer(BLANKS, np.uint8)] = 0
    begin, end, h = words(spaced, as_is, seed=21)
    shape = kinds()
    shape[np.frombuffer(BLANKS, np.uint8)] = 0
    classes = shape[spaced]
    fresh = np.ones(len(classes), bool)
    fresh[1:] = classes[1:] != classes[:-1]
    short = classes[fresh]
    _, _, s = words(short, as_is_shape(), seed=22)
    first = np.searchsorted(begin, offsets + np.arange(texts + 1))
    grams = [h, shingles(h, 2), spread(s * odd(31)), spread(shingles(s, 2) * odd(32))]
    mask = np.uint64((1 << bits) - 1)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        index, value = [], []
        for k, g in enumerate(grams):
            own = g[a : max(a, b - k % 2)] & mask
            at, n = np.unique(own, return_counts=True)
            v = np.log1p(n)
            norm = np.sqrt((v * v).sum())
            index.append(at.astype(np.int64))
            value.append(v / norm if norm else v)
        out.append((np.concatenate(index), np.concatenate(value) / 2))
    return out


def as_is_shape() -> np.ndarray:
    """Shape classes are separated by class 0 alone."""
    return np.arange(256, dtype=np.uint8)


class Ftrl:
    """Follow-the-regularised-leader over a fixed number of weights and a bias."""

    def __init__(self, how: Settings):
        self.how = how
        self.z, self.n = np.zeros((1 << how.bits) + 1), np.zeros((1 << how.bits) + 1)

    def weights(self, at) -> np.ndarray:
        how, z, n = self.how, self.z[at], self.n[at]
        w = -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2)
        return np.where(np.abs(z) <= how.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, y: float, weight: float) -> None:
        at, x = np.append(at, len(self.z) - 1), np.append(x, 1.0)
        at, back = np.unique(at, return_inverse=True)
        x = np.bincount(back, x, len(at))
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y) * x * weight
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.how.alpha * w
        self.n[at] += g * g


def _learners(how: Settings, rates: dict[int, float]):
    def run(tab):
        rows, order = [], []
        for batch in tab.select(["doc_id", "body", "label", "place"]).to_batches():
            for part in pieces(batch):
                rows += zip(features(part, how.bits), part.column("label").to_pylist())
                order += part.column("place").to_pylist()
        order = np.argsort(np.array(order, np.int64), kind="stable")
        learner = Ftrl(how)
        for _ in range(how.epochs):
            for k in order.tolist():
                (at, x), y = rows[k]
                learner.learn(at, x, float(y), rates[int(y)])
        w = learner.weights(np.arange(len(learner.z)))
        at = np.flatnonzero(w)
        return pa.table({"feature": at.astype(np.int32), "weight": w[at]})

    return run


def train(base: DataFrame, labels: DataFrame, how: Settings = Settings()) -> np.ndarray:
    """Weights (the bias last) from the labelled rows given, at most ``how.sample`` of them.

    ``labels`` has ``doc_id`` and ``label`` (0 or 1, nulls are left out). The sample goes to
    ``how.shards`` learners of at most a few thousand rows each; their weights are averaged.
    The rarer label weighs more, up to five times.
    """
    place = F.xxhash64("doc_id")
    known = labels.select("doc_id", F.col("label").cast("int").alias("label")).dropna().dropDuplicates(["doc_id"])
    some = known.withColumn("place", place).orderBy("place").limit(how.sample)
    some = some.withColumn("shard", F.pmod(F.xxhash64("place"), F.lit(how.shards)))
    counts = {r["label"]: r["n"] for r in some.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = np.zeros((1 << how.bits) + 1)
    if not counts:
        return total
    rates = {y: min(5.0, sum(counts.values()) / (2 * n)) for y, n in counts.items()}
    rows = base.select("doc_id", "body").join(F.broadcast(some), "doc_id").select("doc_id", "body", "label", "place", "shard")
    learnt = rows.groupBy("shard").applyInArrow(_learners(how, rates), "feature int, weight double")
    mean = learnt.groupBy("feature").agg((F.sum("weight") / how.shards).alias("weight")).toPandas()
    total[mean["feature"].to_numpy(np.int64)] = mean["weight"].to_numpy()
    return total


def _scored(shared, bits: int):
    def run(batches):
        weights = shared.value
        for batch in batches:
            for part in pieces(batch):
                raw = [weights[at] @ x + weights[-1] for at, x in features(part, bits)]
                p = 1 / (1 + np.exp(-np.clip(np.array(raw, np.float64), -30, 30)))
                yield table(doc_id=part.column("doc_id"), score=p)

    return run


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    threshold: float = 0.5, how: Settings = Settings(),
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every document.

    Null and empty texts have no feature and get the score of the bias. Without any label all
    scores are one half. Rows that share an id are scored each; one label counts per id.
    """
    base = identified(docs, id_col, text_col)
    kind = dict(base.dtypes)["doc_id"]
    known = labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").alias("label"))
    weights = train(base, known.filter(fold() != 1), how)
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    scored = base.select("doc_id", "body").mapInArrow(_scored(shared, how.bits), f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", (fold() == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
