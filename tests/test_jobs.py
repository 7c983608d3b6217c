"""The jobs in their documented order, each in a process of its own, over the driver's smallest tables."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from starmill import schemas
from starmill.jobs import SOURCE_TABLES, main, parser
from starmill.operators import quality
from starmill.sources import staging
from starmill.sources.publish import publish, published
from workload import standins

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


def submit(*args):
    done = subprocess.run(
        [sys.executable, f"{ROOT}/run_job.py", *args], capture_output=True, text=True, timeout=600,
        env=os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[4] --conf spark.ui.enabled=false --conf spark.sql.shuffle.partitions=4 pyspark-shell"},
    )
    assert done.returncode == 0, done.stderr[-2000:]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_jobs_in_order(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    source = standins.operational(spark, FOLDER)
    for name in SOURCE_TABLES:
        source[name].write.parquet(f"{at('oper')}/{name}")
    submit("load", "--source", at("oper"), "--root", at("dw"), "--run-date", "2026-01-15")
    dw = published(spark, at("dw"))
    assert dw["receita"].count() == source["usrpagto"].count()

    (tmp_path / "landing").mkdir()
    for name, table in schemas.CATALOGUE.items():
        (tmp_path / "landing" / f"{name}.tsv").write_text("\t".join(table.names()) + "\n")
    titles = [f"tt{i}\tmovie\tT{i}\tT{i}\t0\t{1950 + i}\t\\N\t{80 + i}\tDrama,War" for i in range(60)]
    with open(at("landing/title-basics.tsv"), "a") as f:
        f.write("\n".join(titles) + "\n")
    with open(at("landing/title-ratings.tsv"), "a") as f:
        f.write("\n".join(f"tt{i}\t{6 + i % 4}\t{900 + i * 10}" for i in range(60)) + "\n")
    main(["catalogue", "--landing", at("landing"), "--brute", at("brute"), "--out", at("movies")])
    submit("recommend", "--warehouse", at("dw"), "--movies", at("movies"), "--out", at("pred"), "--num-trees", "3")
    predictions = spark.read.parquet(at("pred"))
    assert predictions.agg(F.max("FilmeIMDbSK")).first()[0] == predictions.count() > 0
    assert predictions.filter(~F.col("PredicaoModelo").between(1, 5)).isEmpty()

    again = ["--source", at("oper"), "--warehouse", at("dw"), "--predictions", at("pred"), "--root", at("rolled"), "--run-date", "2026-01-15"]
    main(["rollup", *again])
    first = {name: rows(df) for name, df in published(spark, at("rolled")).items()}
    main(["rollup", *again])
    rolled = published(spark, at("rolled"))
    assert {name: rows(df) for name, df in rolled.items()} == first
    assert rolled["endereco"].columns == ["enderecosk", "estado"]
    assert rolled["modelprediction"].count() == predictions.count()
    for fact in ("receita", "avaliacao", "modelprediction"):
        assert quality.check_fk(rolled[fact], "enderecosk", rolled["endereco"]).isEmpty()

    main(["export", "--warehouse", at("rolled"), "--folder", at("export")])
    assert spark.read.option("header", True).csv(at("export/modelprediction")).count() == predictions.count()


def test_nothing_staged_is_left(spark, tmp_path):
    good = spark.createDataFrame([(1, "a")], "produtorask long, produtoranome string")
    tables = {"produtora": schemas.WAREHOUSE["produtora"]}
    for frame, fails in ((good, False), (good.union(good), True)):
        try:
            with staging.run_scope(spark) as folder:
                publish(spark, {"produtora": staging.stage(frame, "probe")}, str(tmp_path / "root"), tables)
                assert os.path.isdir(folder.removeprefix("file:"))
        except quality.ConstraintError:
            assert fails
        assert not os.path.exists(folder.removeprefix("file:"))
    assert rows(published(spark, str(tmp_path / "root"))["produtora"]) == [(1, "a")]


def test_references_are_never_skipped(spark, tmp_path):
    revenue = spark.createDataFrame([(1, 2.0, 5, 6, 7)], "receitask int, valorpago double, usuariosk long, calendariosk long, enderecosk long")
    with pytest.raises(quality.ConstraintError):
        publish(spark, {"receita": revenue}, str(tmp_path), {"receita": schemas.WAREHOUSE["receita"]})
    with pytest.raises(quality.ConstraintError):
        quality.check_table(revenue, schemas.WAREHOUSE["receita"], {})


def test_job_arguments():
    with pytest.raises(SystemExit):
        parser().parse_args(["load", "--source", "x"])
