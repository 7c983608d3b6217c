"""Later loads: keys that stay, batches that are merged once, partitions that are left alone."""

import os

import pytest
from pyspark.sql import functions as F

from starmill.operators.joins import lookup_join
from starmill.operators.quality import ConstraintError
from starmill.operators.registry import register, registered, registry_map
from starmill.plans import incremental
from starmill.sources import manifest
from starmill.sources.partitioned import merge_batch, read_partitioned


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_registry_keeps_keys(spark, rows, tmp_path):
    root, nk = str(tmp_path / "r"), ["a", "b"]
    one = frame(spark, [("x", 1), ("z", 1), ("x", 1), (None, 2)], "a string, b int")
    two = frame(spark, [("y", 1), ("z", 1), ("a", None), (None, 2)], "a string, b int")
    assert rows(register(one, nk, "k", root, "one")) == sorted([("x", 1, 1), ("z", 1, 2), (None, 2, 3)], key=repr)
    want = sorted([("x", 1, 1), ("z", 1, 2), (None, 2, 3), ("a", None, 4), ("y", 1, 5)], key=repr)
    assert rows(register(two, nk, "k", root, "two")) == want
    assert rows(register(two.limit(0), nk, "k", root, "three")) == want
    # A batch is known by its name, also if it would now bring more.
    assert rows(register(frame(spark, [("q", 9)], "a string, b int"), nk, "k", root, "two")) == want
    assert rows(registered(spark, root, nk, "k", one)) == want
    found = registry_map(two.withColumn("id", F.monotonically_increasing_id()), registered(spark, root, nk, "k", one), nk, "id", "k")
    assert sorted(r.k for r in found.collect()) == [2, 3, 4, 5]


def test_registry_map_of_one_column_with_null(spark, tmp_path):
    root = str(tmp_path / "r")
    source = frame(spark, [(1, "x"), (2, None), (3, "y"), (4, "unknown")], "id int, a string")
    registry = register(source.filter("id < 4"), ["a"], "k", root, "one")
    assert sorted((r.id, r.k) for r in registry_map(source, registry, ["a"], "id", "k").collect()) == [(1, 1), (2, 3), (3, 2)]


def test_registry_of_nothing(spark, tmp_path):
    root = str(tmp_path / "r")
    empty = frame(spark, [], "a string")
    assert register(empty, ["a"], "k", root, "one").count() == 0
    assert register(frame(spark, [("x",)], "a string"), ["a"], "k", root, "two").collect()[0].k == 1


def test_uncommitted_keys_do_not_count(spark, rows, tmp_path):
    root = str(tmp_path / "r")
    register(frame(spark, [("x",)], "a string"), ["a"], "k", root, "one")
    frame(spark, [("lost", 2)], "a string, k long").write.parquet(f"{root}/keys-left-behind")
    assert rows(register(frame(spark, [("y",)], "a string"), ["a"], "k", root, "two")) == [("x", 1), ("y", 2)]


FACT = "id long, v int, d string"


def files(root):
    return sorted(os.path.join(p, f) for p, _, fs in os.walk(f"{root}/data") for f in fs if f.endswith(".parquet"))


def test_merge_touches_only_its_partitions(spark, rows, tmp_path):
    root = str(tmp_path / "f")
    base = frame(spark, [(i, i, f"2024-0{1 + i % 3}") for i in range(30)], FACT)
    assert merge_batch(base, root, ["id"], "d", "base") == ["2024-01", "2024-02", "2024-03"]
    before = files(root)
    batch = frame(spark, [(1, 100, "2024-02"), (40, 40, "2024-02")], FACT)
    assert merge_batch(batch, root, ["id"], "d", "b1") == ["2024-02"]
    assert merge_batch(batch, root, ["id"], "d", "b1") == []
    after = files(root)
    assert [f for f in before if "2024-02" not in f] == [f for f in after if "2024-02" not in f]
    assert not set(before) & {f for f in after if "2024-02" in f}
    want = {i: (i, i, f"2024-0{1 + i % 3}") for i in range(30)} | {1: (1, 100, "2024-02"), 40: (40, 40, "2024-02")}
    assert rows(read_partitioned(spark, root, base, "d")) == sorted(want.values(), key=repr)


def test_rows_move_and_go(spark, rows, tmp_path):
    root = str(tmp_path / "f")
    base = frame(spark, [(1, 1, "a"), (2, 2, "a"), (3, 3, "b"), (4, 4, "c")], FACT)
    merge_batch(base, root, ["id"], "d", "base")
    batch = frame(spark, [(3, 30, "a", False), (2, None, "a", True), (4, None, "c", True), (9, 9, "z", True)], FACT + ", gone boolean")
    assert merge_batch(batch, root, ["id"], "d", "b1", deleted="gone") == ["a", "b", "c"]
    assert rows(read_partitioned(spark, root, base, "d")) == [(1, 1, "a"), (3, 30, "a")]


def test_a_batch_that_failed_before_its_commit_can_be_sent_again(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "f")
    base = frame(spark, [(1, 1, "a"), (2, 2, "b")], FACT)
    merge_batch(base, root, ["id"], "d", "base")
    batch = frame(spark, [(1, 10, "b"), (3, 3, "a")], FACT)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(manifest, "commit", fail)
        with pytest.raises(OSError):
            merge_batch(batch, root, ["id"], "d", "b1")
    assert merge_batch(batch, root, ["id"], "d", "b1")
    assert rows(read_partitioned(spark, root, base, "d")) == [(1, 10, "b"), (2, 2, "b"), (3, 3, "a")]


def test_batches_that_cannot_be_merged(spark, tmp_path):
    root = str(tmp_path / "f")
    with pytest.raises(ConstraintError):
        merge_batch(frame(spark, [(1, 1, "a"), (1, 2, "a")], FACT), root, ["id"], "d", "b")
    with pytest.raises(ConstraintError):
        merge_batch(frame(spark, [(1, 1, None)], FACT), root, ["id"], "d", "b")
    assert merge_batch(frame(spark, [], FACT), root, ["id"], "d", "none") == []
    assert not manifest.committed(spark, root, "b") and manifest.committed(spark, root, "none")


def test_merge_reads_only_the_partitions_it_touches(spark, tmp_path):
    root = str(tmp_path / "f")
    base = frame(spark, [(i, i, f"p{i % 9}") for i in range(90)], FACT)
    merge_batch(base, root, ["id"], "d", "base")
    plan = read_partitioned(spark, root, base, "d").filter(F.col("d").isin(["p1"]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "= p1" in plan


def operational(spark):
    users = [(i, f"u{i}@x", str(i % 3), "b", "m", f"s{i % 2}", f"l{i}") for i in range(6)]
    return {
        "usuario": frame(spark, users, "usuarioid long, email string, telefone string, bairro string, municipio string, estado string, logradouro string"),
        "filme": frame(spark, [(i,) for i in range(5)], "filmeid long"),
        "produtora": frame(spark, [(1, "p1"), (2, "p2")], "produtoraid long, produtoranome string"),
        "filmpagtoroy": frame(spark, [(1.0, "2024-01-01", 1, 0), (2.0, "2024-02-01", 2, 0)], "valorpagto double, d string, produtoraid long, filmeid long")
        .select("valorpagto", F.col("d").cast("date").alias("datapagto"), "produtoraid", "filmeid"),
    }


def test_a_batch_loads_only_what_it_brings(spark, rows, tmp_path, monkeypatch):
    """No payer without a rating, no key without a new batch; the facts are those of all batches."""
    root, source = str(tmp_path / "w"), operational(spark)
    day = F.col("d").cast("date")
    payments = frame(spark, [(i, 10.0 * i, f"2024-0{1 + i % 2}-03", i % 6) for i in range(8)], "usrpagtoid long, valorpago double, d string, usuarioid long")
    payments = payments.select("usrpagtoid", "valorpago", day.alias("datapagto"), "usuarioid")
    ratings = frame(spark, [(i, "2024-01-05", 3, i % 6, i % 5) for i in range(7)], "avaliacaoid long, d string, nota int, usuarioid long, filmeid long")
    ratings = ratings.select("avaliacaoid", day.alias("avaliacaodata"), "nota", "usuarioid", "filmeid")
    assert incremental.load_batch(source, payments, ratings, root, "one") == {"receita": ["2024-01", "2024-02"], "avaliacao": ["2024-01"]}

    def unwanted(*_):
        raise AssertionError("not asked for")

    monkeypatch.setattr(incremental.facts, "latest_payer", unwanted)
    more = payments.filter("usrpagtoid = 2").withColumn("valorpago", F.lit(7.0))
    assert incremental.load_batch(source, more, ratings.limit(0), root, "two") == {"receita": ["2024-01"], "avaliacao": []}
    monkeypatch.setattr(incremental, "register", unwanted)
    assert incremental.load_batch(source, payments, ratings, root, "one") == {"receita": [], "avaliacao": []}
    paid = incremental.loaded_fact(spark, root, "receita").select("receitask", "valorpago")
    assert rows(paid) == sorted([(i, 7.0 if i == 2 else 10.0 * i) for i in range(8)], key=repr)
    assert incremental.loaded_fact(spark, root, "avaliacao").count() == 7


def test_a_lookup_over_the_limit_does_not_pass_the_driver(spark, rows):
    """Spark alone would send it to all tasks, since its files are small."""
    many = spark.range(3000).selectExpr("id % 1000 AS k", "id AS v")
    few = spark.range(1000).selectExpr("id AS k", "id * 2 AS w")
    joined = lookup_join(many, few, "k", max_bytes=1000)
    joined.collect()
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()
    assert rows(joined) == rows(lookup_join(many, few, "k"))
