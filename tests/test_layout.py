"""Bucketed tables, quarantine, schema evolution, constraint state and seeded pairs."""

import gzip

import pytest
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators import checkstate, generate, quality
from starmill.sources import bucketed, landing
from starmill.sources.writers import create_schema, drop_namespace


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", [bucketed.HOT_ROWS, 1000])
def test_bucket_join_exchanges_nothing(spark, rows, tmp_path, hot):
    fact = spark.range(6000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"), "id")
    fact = fact.unionByName(spark.createDataFrame([(None, -1)], "k long, id long"))
    lookup = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    where = str(tmp_path / "b")
    a = bucketed.write_bucketed(fact, "t_bucketed", f"fact{hot}", "k", 4, where, hot_rows=hot)
    b = bucketed.write_bucketed(lookup, "t_bucketed", f"lookup{hot}", "k", 4, where, hot_rows=None)
    assert a.whole(spark).count() == 6001
    for how in ("inner", "left"):
        joined = bucketed.bucket_join(spark, a, b, how)
        assert rows(joined, "k", "id", "w") == rows(fact.join(lookup, "k", how), "k", "id", "w")
    inner = bucketed.bucket_join(spark, bucketed.Bucketed(a.name, "k", 4, False), b)
    assert "SortMergeJoin" in plan(inner) and "Exchange hashpartitioning" not in plan(inner)
    per_user = a.rows(spark).groupBy("k").count()
    assert "Exchange hashpartitioning" not in plan(per_user)
    with pytest.raises(ValueError):
        bucketed.bucket_join(spark, a, bucketed.Bucketed(b.name, "k", 8, False))


def test_bucket_count_follows_the_size(spark):
    df = spark.range(1000).select("id", F.lit("x" * 100).alias("t"))
    assert bucketed.bucket_count(df) == 1
    assert bucketed.bucket_count(df.limit(1), df, bucket_bytes=20_000) == 8


LINES = [
    "tt1\tmovie\tA\tA\t0\t1999\t\\N\t100\tDrama", "tt2\tmovie\tB", "tt3\tmovie\tC\tC\t0\tx\t\\N\t9\tWar", "",
    "tt4\tmovie\t\"D\tD\t0\t2001\t\\N\t12d\t\\N", "tt5\tmovie\tE\tE\t0\t2001\t\\N\t\\N\tWar\textra", "tt6\tmovie\tF\tF\t0\t2001\t\\N\t\\N\t\r",
]


def test_quarantine(spark, rows, tmp_path):
    table = schemas.CATALOGUE["title-basics"]
    header = "\t".join(table.names())
    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.tsv.gz", "wt", newline="") as f:
        f.write("\n".join([header, *LINES]) + "\n")
    (tmp_path / "in" / "b.tsv").write_text("tt9\tmovie\tA\tA\t0\t1999\t\\N\t100\tDrama\n")
    good, bad = landing.ingest_with_rejects(
        spark, str(tmp_path / "in"), table, str(tmp_path / "out"), str(tmp_path / "rejects"), strict=["runtimeMinutes"]
    )
    assert rows(good, "tconst", "primaryTitle", "startYear", "runtimeMinutes", "genres") == sorted(
        [("tt1", "A", 1999, 100, "Drama"), ("tt3", "C", None, 9, "War"), ("tt6", "F", 2001, None, "")], key=repr
    )
    assert rows(bad, "file", "reason") == [
        ("a.tsv.gz", "columns: 10 of 9"), ("a.tsv.gz", "columns: 3 of 9"), ("a.tsv.gz", "value: runtimeMinutes"), ("b.tsv", "header"),
    ]
    assert bad.filter("reason = 'columns: 3 of 9'").first().line == LINES[1]


def test_one_packed_file_is_parsed_by_many_tasks(spark, tmp_path):
    with gzip.open(tmp_path / "a.tsv.gz", "wt") as f:
        f.writelines(f"line {i} {hash(str(i))}\n" for i in range(300_000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() == 1
        assert landing.stage_lines(spark, str(tmp_path), row_group=1 << 20).rdd.getNumPartitions() > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_evolution_adds_and_widens(spark, rows, tmp_path):
    place = str(tmp_path / "t")
    spark.sql("SELECT 1 AS a, CAST(1.5 AS FLOAT) AS b, 'x' AS c").write.parquet(place)
    drop_namespace(spark, "t_evolve")
    create_schema(spark, "t_evolve", str(tmp_path / "s"))
    spark.catalog.createTable("t_evolve.t", path=place, source="parquet")
    assert landing.evolve_table(spark, "t_evolve.t").count() == 0
    before = set(spark.table("t_evolve.t").inputFiles())
    spark.sql("SELECT 2L AS a, 2.5D AS b, DATE'2024-01-01' AS d").write.mode("append").parquet(place)
    changes = landing.evolve_table(spark, "t_evolve.t")
    assert rows(changes, "column", "change", "declared", "found") == sorted(
        [("a", "retyped", "int", "bigint"), ("b", "retyped", "float", "double"), ("d", "added", None, "date")], key=repr
    )
    spark.sql("SELECT 3 AS a, 'y' AS e").write.mode("append").parquet(place)
    landing.evolve_table(spark, "t_evolve.t")
    table = spark.table("t_evolve.t")
    assert [f"{n} {t}" for n, t in table.dtypes] == ["a bigint", "b double", "c string", "d date", "e string"]
    assert sorted((r.a, r.b, r.c, str(r.d), r.e) for r in table.collect()) == [
        (1, 1.5, "x", "None", None), (2, 2.5, None, "2024-01-01", None), (3, None, None, "None", "y")
    ]
    assert before < set(table.inputFiles())
    spark.sql("SELECT 'no number' AS a").write.mode("append").parquet(place)
    with pytest.raises(ValueError):
        landing.evolve_table(spark, "t_evolve.t")


TABLE = schemas.Table(
    (schemas.Column("k", "long"), schemas.Column("p", "long"), schemas.Column("t", "text", 3)), ("k",), (("p", "parent"),)
)
ROWS = [(1, 1, "a"), (2, 1, "long"), (3, 9, None), (3, 9, "b"), (None, None, "c"), (5, 2, "longer"), (1, 8, "d"), (None, 2, "e")]


def test_state_of_batches_equals_the_whole_check(spark, rows, tmp_path):
    df = spark.createDataFrame(ROWS, "k long, p long, t string")
    parents = {"parent": (spark.createDataFrame([(1,), (2,)], "id long"), "id")}
    root = str(tmp_path / "s")
    for n, (a, b) in enumerate([(0, 4), (4, 6), (6, 8), (6, 8)]):
        checkstate.add_batch(spark.createDataFrame(ROWS[a:b], df.schema), TABLE, root, f"b{min(n, 2)}")
    assert rows(checkstate.check_state(spark, TABLE, root, parents)) == rows(quality.check_table(df, TABLE, parents))
    grown = {"parent": (spark.createDataFrame([(1,), (2,), (8,), (9,)], "id long"), "id")}
    assert rows(checkstate.check_state(spark, TABLE, root, grown)) == rows(quality.check_table(df, TABLE, grown))
    with pytest.raises(quality.ConstraintError):
        checkstate.check_state(spark, TABLE, root)


def test_a_later_check_reads_no_data_of_earlier_batches(spark, tmp_path):
    root, data = str(tmp_path / "s"), str(tmp_path / "d")
    for n, (a, b) in enumerate([(0, 6), (6, 8)]):
        spark.createDataFrame(ROWS[a:b], "k long, p long, t string").write.parquet(f"{data}/b{n}")
    checkstate.add_batch(spark.read.parquet(f"{data}/b0"), TABLE, root, "b0")
    delta = spark.read.parquet(f"{data}/b1")
    found = checkstate.clashes(delta, TABLE, root)
    assert {r.k: r.n_rows for r in found.collect()} == {1: 2}
    read = {f for part in found.inputFiles() for f in [part.split("/")[-2]]}
    assert read == {"b1", "keys"} and not any("/b0/" in f for f in found.inputFiles())
    parents = {"parent": (spark.createDataFrame([(1,)], "id long"), "id")}
    assert not any("/d/b" in f for f in checkstate.check_state(spark, TABLE, root, parents).inputFiles())


@pytest.mark.parametrize("sides", [(1, 1), (1, 50), (50, 1), (7, 9), (30, 20)])
def test_every_pair_comes_once(spark, sides):
    left, right = spark.range(sides[0]).withColumnRenamed("id", "l"), spark.range(sides[1]).withColumnRenamed("id", "r")
    got = generate.sample_pairs(left, right, "l", "r", 10**6, seed=3).collect()
    assert sorted((x.l, x.r) for x in got) == [(a, b) for a in range(sides[0]) for b in range(sides[1])]


def test_pairs_look_random(spark):
    """Few pairs of a large product: even over cells, and neighbours are unrelated."""
    left, right = spark.range(1000).withColumnRenamed("id", "l"), spark.range(900).withColumnRenamed("id", "r")
    got = [(x.l, x.r) for x in generate.sample_pairs(left, right, "l", "r", 20_000, seed=5).orderBy("pair_id").collect()]
    cells = {}
    for a, b in got:
        cells[a // 100, b // 90] = cells.get((a // 100, b // 90), 0) + 1
    chi = sum((n - 200) ** 2 / 200 for n in cells.values())
    assert len(cells) == 100 and 50 < chi < 160  # 99 degrees of freedom
    steps = [(c - a) % 1000 // 100 for (a, _), (c, _) in zip(got, got[1:])]
    chi = sum((steps.count(k) - len(steps) / 10) ** 2 / (len(steps) / 10) for k in range(10))
    assert chi < 30  # 9 degrees of freedom
    other = generate.sample_pairs(left, right, "l", "r", 100, seed=6).collect()
    assert len({(x.l, x.r) for x in other} & set(got[:100])) < 5
