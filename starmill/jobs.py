"""The pipelines as jobs over folders, so each can run in a process of its own.

    spark-submit run_job.py load      --source DIR --root DIR [--run-date D]
    spark-submit run_job.py catalogue --landing DIR --brute DIR --out DIR
    spark-submit run_job.py recommend --warehouse DIR --movies DIR --out DIR [--num-trees N]
    spark-submit run_job.py rollup    --source DIR --warehouse DIR --predictions DIR --root DIR
    spark-submit run_job.py export    --warehouse DIR --folder DIR

A source is a folder with one Parquet table per name; a warehouse is a root that ``publish``
has written. The roll-up reads one root and writes another, so it can run again.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from starmill import schemas
from starmill.plans import init_load, load_catalogue, rollup_and_predict, run_recommender
from starmill.recommend import constants as K
from starmill.sources.names import lower_columns
from starmill.sources.publish import publish, published
from starmill.sources.staging import run_scope
from starmill.sources.writers import export_frames

SOURCE_TABLES = ["usuario", "filme", "filme_generofilme", "produtora", "filmpagtoroy", "avaliacao", "usrpagto"]


def _source(spark: SparkSession, folder: str, names: list[str]) -> dict:
    return {n: lower_columns(spark.read.parquet(f"{folder.rstrip('/')}/{n}")) for n in names}


def load(spark: SparkSession, a: argparse.Namespace) -> None:
    publish(spark, init_load(_source(spark, a.source, SOURCE_TABLES), a.run_date), a.root, schemas.WAREHOUSE)


def catalogue(spark: SparkSession, a: argparse.Namespace) -> None:
    landing = {name: f"{a.landing.rstrip('/')}/{name}.tsv" for name in schemas.CATALOGUE}
    load_catalogue(spark, landing, a.brute, a.out)


def recommend(spark: SparkSession, a: argparse.Namespace) -> None:
    dw = published(spark, a.warehouse)
    frames = [dw[name] for name in ("avaliacao", "filme", "receita", "endereco")]
    run_recommender(*frames, spark.read.parquet(a.movies), out_path=a.out, num_trees=a.num_trees)


def rollup(spark: SparkSession, a: argparse.Namespace) -> None:
    dw = published(spark, a.warehouse)
    users = _source(spark, a.source, ["usuario"])["usuario"]
    out = rollup_and_predict(
        dw, users, spark.read.parquet(a.predictions), a.run_date, dw["user_map"], a.user_key, on_unmatched=a.on_unmatched
    )
    publish(spark, out, a.root, schemas.ROLLED_UP)


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    dw = published(spark, a.warehouse)
    export_frames({name: dw[name] for name in schemas.ROLLED_UP}, a.folder)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="run_job.py")
    jobs = top.add_subparsers(required=True)

    def job(run, *required: str, **optional) -> None:
        sub = jobs.add_parser(run.__name__)
        sub.set_defaults(run=run)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        for name, default in optional.items():
            kind = type(default) if default is not None else str
            sub.add_argument(f"--{name.replace('_', '-')}", default=default, type=kind)

    job(load, "source", "root", run_date=None)
    job(catalogue, "landing", "brute", "out")
    job(recommend, "warehouse", "movies", "out", num_trees=K.NUM_TREES)
    job(rollup, "source", "warehouse", "predictions", "root", run_date=None, user_key="mapped", on_unmatched="fail")
    job(export, "warehouse", "folder")
    return top


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("starmill").getOrCreate()
    with run_scope(spark):  # what the job staged goes at its end
        args.run(spark, args)
    return 0
