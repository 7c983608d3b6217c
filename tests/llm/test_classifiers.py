import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starmill.llm import quality, toxicity

FOLDER = "/root/testdata/sf0.1"


def brute_segments(score):
    """All maximal scoring segments by their recursive definition: take the best, then go left and right."""
    best = None
    for a in range(len(score)):
        for b in range(a + 1, len(score) + 1):
            s = sum(score[a:b])
            if s > 0 and (best is None or s > best[2] or s == best[2] and b - a < best[1] - best[0]):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    return brute_segments(score[:a]) + [best] + [(b + x, b + y, z) for x, y, z in brute_segments(score[b:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-6, 6).filter(bool), max_size=14))
def test_segments(score):
    """Compared without ties between segments: whole numbers plus a small number of its own per token."""
    unique = [v + 0.001 * 2**-k for k, v in enumerate(score)]
    got = toxicity.segments(np.array(unique))
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute_segments(unique)]


def auc(score, y):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    n = y.sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("name, run", [("toxic", toxicity.toxicity_scores), ("quality", quality.quality_scores)])
def test_held_out_ranking(spark, name, run):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    pdf = run(docs, labels).join(labels, "doc_id").toPandas()
    held = pdf[pdf["held_out"]]
    assert auc(held["score"].to_numpy(), held[name].to_numpy()) > 0.95
    assert ((held["predicted"] == held[name]).mean()) > 0.95


@pytest.mark.parametrize("run", [toxicity.toxicity_scores, quality.quality_scores])
def test_folds_and_odd_rows(spark, frame, odd_corpus, run):
    labels = spark.createDataFrame(
        [(i, i % 2, (i + 1) % 2) for i in range(30)] + [(3, 0, 0), (None, 1, 1), (4, None, None)], "doc_id long, quality int, toxic int"
    )
    rows = run(frame(odd_corpus), labels).collect()
    assert len(rows) == len(odd_corpus) and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert run(frame([]), labels).count() == 0
    assert run(frame(odd_corpus), labels.limit(0)).count() == len(odd_corpus)


def test_held_out_labels_change_nothing(spark, frame, corpus):
    base = [(i, i % 2, i % 2) for i in range(40)]
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in base]
    score = lambda rows: sorted(
        (r.doc_id, r.score)
        for r in quality.quality_scores(frame(corpus), spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()
    )
    assert np.allclose([s for _, s in score(base)], [s for _, s in score(other)])


def test_toxic_rows_go(spark):
    docs, labels = spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = toxicity.drop_toxic(docs, labels)
    assert out.columns == docs.columns
    kept = toxicity.toxicity_scores(docs, labels).filter("predicted = 0").count()
    assert out.count() == kept


def test_filter_sends_python_the_text_alone(frame, corpus, odd_corpus, spark):
    """The rows that stay are those the scores let stay, and no row goes through a Python worker."""
    toxic = [(900 + k, f"vile rotten filth you vile rotten filth and worse {k} " * 5) for k in range(30)]
    for pairs in (corpus + toxic, odd_corpus + toxic):
        docs = frame(pairs)
        labels = spark.createDataFrame([(i, int(i is not None and i >= 900)) for i, _ in pairs], "doc_id long, toxic int")
        scored = toxicity.toxicity_scores(docs, labels).collect()
        out = toxicity.drop_toxic(docs, labels)
        assert out.columns == docs.columns
        left = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
        assert left == sorted(r.doc_id for r in scored if r.score < 0.7 and r.doc_id is not None)
        assert out.filter("doc_id IS NULL").count() == sum(r.score < 0.7 for r in scored if r.doc_id is None)
        assert pairs[20] != corpus[20] or len(scored) > out.count()
        assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
