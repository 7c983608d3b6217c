import math

import numpy as np
import pytest

from starmill.llm import topk


def brute(rows, queries, k, scale=256):
    ok = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in [x for x in ok if x[0] in queries]:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 3])
def test_against_brute_force(spark, block):
    r = np.random.default_rng(2)
    rows = [(i, (r.normal(size=16) / 4).tolist()) for i in range(600)]
    rows += [(700 + i, rows[5 * i][1]) for i in range(20)]  # ties
    rows += [(800, None), (801, [0.1, None]), (802, [float("nan")] * 16), (803, [float("inf")] * 16), (804, []), (805, [0.5, 0.25]), (None, [1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    got = topk.top_k(df, df.filter("id % 50 = 0"), k=5, block=block)
    assert sorted(tuple(x) for x in got.collect()) == brute(rows, set(range(0, 900, 50)), 5)


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**21, 1.0]), (1, [2.0**20, 3.0]), (2, [2.0**20, 2.0 + 2**-8]), (3, [-1.0, 2.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    got = topk.top_k(df, df.filter("id = 0"))
    assert sorted(tuple(x) for x in got.collect()) == brute(rows, {0}, 5)


def test_fewer_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "id long, vector array<float>")
    assert [tuple(x) for x in topk.top_k(df, df.filter("id = 0")).collect()] == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    """Each query row is one query, and all other rows are its candidates, also those of its id."""
    rows = [(0, [1.0, 0.0]), (0, [0.5, 0.5]), (7, [0.25, 0.0]), (7, [2.0, 0.0]), (9, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, vector array<double>").repartition(2)
    got = sorted(tuple(x) for x in topk.top_k(df, topk.F.col("id") % 50 == 0, k=9).collect())
    want = []
    for k, (q, v) in enumerate(rows):
        if q % 50 == 0:
            others = [(-sum(int(256 * a) * int(256 * b) for a, b in zip(v, w)), i) for j, (i, w) in enumerate(rows) if j != k]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(others))]
    assert got == sorted(want) and len(got) == 8


@pytest.mark.parametrize("block", [4096, 3])
def test_condition_against_brute_force(spark, block):
    """Many zeros, so terms have short lists; unequal lengths and rows that take no part."""
    r = np.random.default_rng(3)
    rows = [(i, np.where(r.random(12) < 0.7, 0, r.normal(size=12)).tolist()[: r.integers(8, 13)]) for i in range(700)]
    rows += [(750, None), (800, [0.1, None]), (850, [float("inf")]), (None, [1.0]), (900, [])]
    df = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    got = topk.top_k(df, topk.F.col("id") % 50 == 0, k=5, block=block)
    assert sorted(tuple(x) for x in got.collect()) == brute(rows, set(range(0, 950, 50)), 5)
    assert topk.top_k(df.limit(0), topk.F.col("id") % 50 == 0).count() == 0
