import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starmill.operators import dims, facts, generate, mutate, profile, quality, relational
from starmill.operators import joins
from starmill.operators.keys import dense_key, ensure_unknown_member, member_key, next_key
from starmill.operators.quality import ConstraintError

D = dt.date


# --- keys ---


def test_dense_key_matches_row_number(spark):
    rng = random.Random(1)
    values = list({(rng.choice("abcXYZé"), rng.randrange(5000)) for _ in range(6000)}) + [(None, 1), ("a", None)]
    df = spark.createDataFrame(values, "s string, n int").repartition(7)
    got = [tuple(r) for r in dense_key(df, ["s", "n"], "sk").orderBy("sk").collect()]
    assert [g[0] for g in got] == list(range(1, len(values) + 1))
    last = (1, b"")
    want = sorted(values, key=lambda v: (last if v[0] is None else (0, v[0].encode()), v[1] is None, v[1] or 0))
    assert [g[1:] for g in got] == want


def test_dense_key_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 10000, 1, 6).select((F.col("id") * 7919 % 10007).alias("v"))
        keyed = dense_key(df, [F.desc("v")], "sk", start=0)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = [tuple(r) for r in keyed.orderBy("sk").collect()]
    assert got == list(enumerate(sorted((r.v for r in df.collect()), reverse=True)))


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.createDataFrame([], "v int"), ["v"], "sk").collect() == []


def test_unknown_member(spark, rows):
    dim = spark.createDataFrame([(1, "a"), (4, "b")], "k long, label string")
    out = ensure_unknown_member(dim, "k", "label", "?")
    assert rows(out) == [(1, "a"), (4, "b"), (5, "?")]
    assert rows(ensure_unknown_member(out, "k", "label", "?")) == rows(out)
    empty = ensure_unknown_member(dim.limit(0), "k", "label", "?")
    assert rows(empty) == [(1, "?")]
    assert spark.range(1).select(member_key(out, "k", "label", "?").alias("x")).first().x == 5
    assert spark.range(1).select(next_key(out, "k").alias("x")).first().x == 6
    assert spark.range(1).select(next_key(dim.limit(0), "k").alias("x")).first().x == 1


# --- joins ---


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join_ways_agree(spark, rows, how):
    """A third of the rows share one key, another part has no key at all."""
    fact = spark.range(3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 500).alias("k"),
    )
    dim = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = rows(fact.join(dim, "k", how), "id", "k", "v")
    assert rows(joins.lookup_join(fact, dim, "k", how), "id", "k", "v") == plain
    shuffled = joins.lookup_join(fact, dim, "k", how, max_bytes=0)
    salted = joins.lookup_join(fact, dim, "k", how, max_bytes=0, hot_rows=50)
    assert rows(shuffled, "id", "k", "v") == plain
    assert rows(salted, "id", "k", "v") == plain
    assert set(salted.columns) == {"id", "k", "v"}


def test_salting_spreads_the_hot_key(spark):
    fact = spark.range(4000).select("id", F.lit(1).cast("long").alias("k"))
    hot = {r.k: r["_salts"] for r in joins.hot_keys(fact, ["k"], hot_rows=500).collect()}
    assert hot == {1: 8}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.createDataFrame([(1, "x")], "k long, v string")
        out = joins.lookup_join(fact, dim, "k", max_bytes=0, hot_rows=500)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 4000 and max(sizes) < 3000


def test_broadcast_is_measured(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 100, "s string")
    assert joins.fits_broadcast(df, 200_000)
    assert not joins.fits_broadcast(df, 50_000)
    assert joins.fits_broadcast(df.limit(0), 0)


# --- picks ---


def test_mode(spark, rows):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "a"), (1, "b"), (1, None), (1, None), (1, None), (2, "z"), (3, None)],
        "k int, v string",
    )
    assert rows(relational.mode_by(df, ["k"], "v")) == [(1, "a"), (2, "z")]
    weighted = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (1, "a", 2)], "k int, v string, n int")
    assert rows(relational.mode_by(weighted, ["k"], "v", "n")) == [(1, "a")]


def test_latest_by_takes_smallest_on_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, 9, D(2024, 1, 2)), (1, 3, D(2024, 1, 2)), (1, 1, D(2024, 1, 1)), (2, 5, D(1960, 1, 1))],
        "filmeid int, produtoraid int, datapagto date",
    )
    assert rows(facts.latest_payer(df)) == [(1, 3), (2, 5)]


@pytest.mark.parametrize("k", [1, 3, 1500])
def test_top_k(spark, rows, k):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("g"))
    out = relational.top_k_per_group(df, ["g"], [F.desc("id")], k, rank="r")
    got = rows(out, "g", "r", "id")
    want = [("cold", i + 1, 4999 - i) for i in range(min(k, 1000))] + [("hot", i + 1, 3999 - i) for i in range(k)]
    assert got == sorted(want, key=repr)


def test_distinct_on_and_min(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (2, "c", 1)], "k int, s string, n int")
    assert rows(relational.distinct_on(df, ["k"], [F.asc("n"), F.asc("s")])) == [(1, "a", 2), (2, "c", 1)]
    assert rows(relational.min_by_key(df, ["k"], "s")) == [(1, "a"), (2, "c")]


# --- dimensions ---


def test_bridge_label(spark, rows):
    films = spark.createDataFrame([(1,), (2,)], "filmeid int")
    genres = spark.createDataFrame([(1, "b"), (1, "a"), (9, "x")], "filmeid int, g string")
    assert rows(dims.with_bridge(films, genres, "filmeid", "g")) == [(1, "a"), (2, "Gênero Desconhecido")]


def test_calendar_bounds(spark):
    a = spark.createDataFrame([(D(2024, 2, 28),)], "d date")
    none = a.limit(0)
    span = lambda cal: [(r.calendariosk, r.datacompleta) for r in cal.orderBy("calendariosk").collect()]
    assert span(dims.calendar([(none, "d"), (none, "d")], "2024-03-01")) == [(1, D(2024, 3, 1))]
    assert span(dims.calendar([(a, "d"), (none, "d")], "2024-03-01")) == [
        (1, D(2024, 2, 28)), (2, D(2024, 2, 29)), (3, D(2024, 3, 1)),
    ]
    both = dims.calendar([(a, "d"), (a, "d")], "2030-01-01")
    assert span(both) == [(1, D(2024, 2, 28))]
    again = dims.ensure_day(both, "2024-12-25", "padded")
    last = again.orderBy(F.desc("calendariosk")).first()
    assert (last.calendariosk, last.diasemana, last.trimestre) == (2, "Wednesday", 4)
    assert dims.ensure_day(again, "2024-12-25").count() == 2
    assert dims.ensure_day(both.limit(0), "2024-12-25").first().calendariosk == 1


# --- update, delete, roll-up ---


def test_update_from(spark, rows):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 30), (3, None)], "k int, v int")
    source = spark.createDataFrame([(1, None), (3, 7), (None, 99)], "id int, w int")
    out = mutate.update_from(target, source, {"k": "id"}, {"v": "w"})
    assert rows(out) == sorted([(1, None), (2, 20), (None, 30), (3, 7)], key=repr)
    added = mutate.update_from(target, source, {"k": "id"}, {"x": "w"})
    assert added.columns == ["k", "v", "x"]
    assert rows(added, "k", "x") == sorted([(1, None), (2, None), (None, None), (3, 7)], key=repr)
    with pytest.raises(ConstraintError):
        mutate.update_from(target, source.union(source), {"k": "id"}, {"v": "w"})


def test_update_from_two_keys(spark, rows):
    target = spark.createDataFrame([(1, "a", 10), (1, None, 20), (2, "b", 30)], "k int, g string, v int")
    source = spark.createDataFrame([(1, "a", 5), (1, None, 6), (2, "x", 7)], "k int, g string, v int")
    out = mutate.update_from(target, source, {"k": "k", "g": "g"}, {"v": "v"})
    assert rows(out) == sorted([(1, "a", 5), (1, None, 20), (2, "b", 30)], key=repr)


def test_delete_using(spark, rows):
    t = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "k int, g string")
    kept = mutate.group_representative(t, "g", "k")
    out = mutate.delete_using(t, kept, ["g"], lambda a, b: a["k"] != b["_s_keep"])
    assert rows(out) == sorted([(1, "a"), (3, "b"), (4, None)], key=repr)
    assert rows(mutate.delete_using(t, t.filter("k = 1"), ["g"])) == sorted([(3, "b"), (4, None)], key=repr)


def test_rollup_and_shrink(spark, rows):
    dim = spark.createDataFrame([(4, "x"), (2, "x"), (7, "y"), (8, None), (9, None)], "k long, g string")
    assert rows(mutate.rollup_map(dim.filter("g is not null"), "g", "k")) == [(2, "x", 2), (4, "x", 2), (7, "y", 7)]
    shrunk = mutate.shrink_dimension(dim, "g", "k")
    assert rows(shrunk) == sorted([(2, "x"), (7, "y"), (8, None), (9, None)], key=repr)
    assert rows(mutate.shrink_dimension(shrunk, "g", "k")) == rows(shrunk)


# --- quality and profile ---


def test_checks(spark, rows):
    t = spark.createDataFrame([(1, "aa", "7"), (1, None, "x"), (2, "b", None)], "k int, s string, n string")
    assert rows(quality.check_unique(t, ["k"])) == [(1, 2)]
    assert rows(quality.check_not_null(t, ["k", "s"])) == [("k", 0), ("s", 1)]
    assert rows(quality.check_length(t, {"s": 1})) == [("s", 1)]
    assert rows(quality.check_coercion(t, ["n"])) == [("n", 1)]
    child = spark.createDataFrame([(1,), (5,), (5,), (None,)], "k int")
    assert rows(quality.check_fk(child, "k", t)) == [(5, 2)]


def test_exact_quantiles_match_interpolation(spark):
    rng = random.Random(5)
    values = [rng.choice([rng.gauss(0, 1), 3.0]) for _ in range(1001)]
    df = spark.createDataFrame([(v, float(i % 4)) for i, v in enumerate(values)] + [(None, float("nan"))], "a double, b double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.column_name: r for r in profile.describe_exact(df, ["a", "b"]).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ordered = sorted(values)
    assert got["a"]["count"] == 1001 and got["b"]["count"] == 1001
    assert [got["a"][q] for q in ("q25", "q50", "q75")] == pytest.approx([ordered[250], ordered[500], ordered[750]])
    even = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "a double")
    row = profile.describe_exact(even, ["a"]).first()
    assert (row.q25, row.q50, row.q75) == pytest.approx((1.75, 6.0, 12.5))


def test_profile_of_empty_column(spark):
    row = profile.describe_exact(spark.createDataFrame([], "a double"), ["a"]).first()
    assert row["count"] == 0 and row.q50 is None


# --- fixtures ---


@pytest.mark.parametrize("n", [0, 1, 37, 600, 1000])
def test_pairs_are_distinct(spark, n):
    left = spark.range(30).withColumnRenamed("id", "l")
    right = spark.range(100, 120).withColumnRenamed("id", "r")
    got = [tuple(r) for r in generate.sample_pairs(left, right, "l", "r", n, seed=11).collect()]
    assert len(got) == min(n, 600) == len({g[1:] for g in got})
    assert sorted(g[0] for g in got) == list(range(min(n, 600)))
    if n >= 37:
        assert len({g[1] for g in got}) >= 15


def test_subset_and_uniform(spark):
    df = spark.range(1000)
    picked = generate.pick_subset(df, "id", 100, seed=2)
    assert picked.distinct().count() == 100
    assert sorted(r.id for r in picked.collect()) == sorted(r.id for r in generate.pick_subset(df.repartition(5), "id", 100, seed=2).collect())
    made = df.select(
        generate.uniform_int("id", 1, 5).alias("i"), generate.pick_key("id", 7).alias("k"),
        generate.uniform_date("id", "2024-01-01", "2024-01-03").alias("d"), generate.uniform_amount("id", 1, 2).alias("a"),
    ).collect()
    assert {r.i for r in made} == set(range(1, 6)) and {r.k for r in made} == set(range(1, 8))
    assert {r.d for r in made} == {D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 3)}
    assert all(1 <= r.a <= 2 for r in made)


def test_top_k_beyond_the_early_limit_keeps_null_groups(spark):
    df = spark.range(6000).select((F.col("id") % 3).alias("g"), "id").withColumn("g", F.nullif("g", F.lit(2)))
    for k in (3, 1500):
        top = relational.top_k_per_group(df, ["g"], [F.desc("id")], k, rank="n")
        assert {r.g: r["count"] for r in top.groupBy("g").count().collect()} == {0: k, 1: k, None: k}
        assert {r.n for r in top.collect()} == set(range(1, k + 1))


def test_any_seed_gives_all_pairs(spark):
    left, right = spark.range(7).withColumnRenamed("id", "a"), spark.range(9).withColumnRenamed("id", "b")
    for seed in (-5, 0, 10**20):
        pairs = generate.sample_pairs(left, right, "a", "b", 50, seed=seed)
        assert pairs.count() == pairs.distinct().count() == 50


def test_nested_lookups_are_not_broadcast_by_guess(spark):
    df = spark.range(10).select("id", F.array(F.lit(1.0)).alias("v"), F.struct("id").alias("s"))
    assert not joins.fits_broadcast(df) and joins.fits_broadcast(df.select("id"))
    assert joins.lookup_join(spark.range(20), df, "id").count() == 10


def test_many_hot_keys_are_all_split(spark):
    fact = spark.range(30_000).select((F.col("id") % 1500).alias("k"), "id")
    assert joins.hot_keys(fact, ["k"], hot_rows=10).count() == 1500
    lookup = spark.range(1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    joined = joins.lookup_join(fact, lookup, "k", max_bytes=0, hot_rows=10)
    assert joined.count() == 30_000 and joined.filter("w <> 2 * k").isEmpty()


def test_latest_by_takes_timestamps(spark):
    df = spark.sql(
        "SELECT 1 k, 'a' v, TIMESTAMP'2024-01-01 10:00' t UNION ALL SELECT 1, 'b', TIMESTAMP'2024-01-01 11:00'"
        " UNION ALL SELECT 1, 'c', NULL UNION ALL SELECT 2, 'd', NULL"
    )
    assert {r.k: r.v for r in relational.latest_by(df, ["k"], "v", "t").collect()} == {1: "b", 2: "d"}


def test_latest_by_is_one_shuffle_and_keeps_null_values(spark):
    df = spark.sql("SELECT 1 k, CAST(NULL AS STRING) v, DATE'2024-01-02' t UNION ALL SELECT 1, 'b', DATE'2024-01-01'")
    out = relational.latest_by(df.repartition(2), ["k"], "v", "t")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(k") == 1
    assert [(r.k, r.v) for r in out.collect()] == [(1, None)]
