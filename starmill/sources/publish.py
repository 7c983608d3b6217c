"""Publish a set of tables together: write a new run, check it, then point to it."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.quality import assert_valid
from starmill.schemas import Table
from starmill.sources.names import check_name
from starmill.sources.staging import together
from starmill.sources.writers import create_schema


#: Folder of a root with one row per finished run.
RUNS = "runs"


def publish(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    tables: Mapping[str, Table] | None = None,
    schema: str | None = None,
    run_id: str | None = None,
    others: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Full refresh of all frames.

    Every frame goes to a folder of its own under a new run, so a plan may read the
    previous run while the next is written. Declared constraints are checked on the
    written rows; only then is the run the current one of the root (see ``published``), in one
    step for all frames. The catalogue tables of ``schema``, if one is named, are pointed to it
    after that, one by one. A failure before leaves everything on the previous run.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    folder = f"{root.rstrip('/')}/run={check_name(run_id, 'run')}"

    def write(name: str, frame: DataFrame) -> DataFrame:
        check_name(name, "table")
        declared = (tables or {}).get(name)
        frame = frame.select(*declared.names()) if declared else frame
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    done = together(*[lambda n=name, f=frame: write(n, f) for name, frame in frames.items()])
    written = dict(zip(frames, done))
    if tables:
        assert_valid(written, tables, others)
    run = spark.range(1).select(F.lit(run_id).alias("run"), F.current_timestamp().alias("at"), _names(written).alias("names"))
    run.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{RUNS}")
    if schema:
        create_schema(spark, schema, root)
        for name in written:
            point_table(spark, f"{schema}.{name}", written[name], f"{folder}/{name}")
    return written


def _names(frames: Mapping[str, DataFrame]) -> Column:
    return F.array(*[F.lit(n) for n in frames]).cast("array<string>")


def published(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The frames of the latest run under the root, by name."""
    root = root.rstrip("/")
    last = spark.read.parquet(f"{root}/{RUNS}").agg(F.max(F.struct("at", "run", "names")).alias("r")).first()["r"]
    return {n: spark.read.parquet(f"{root}/run={last['run']}/{n}") for n in last["names"]}


def point_table(spark: SparkSession, full_name: str, frame: DataFrame, location: str) -> None:
    """Make the external table read the given folder."""
    if spark.catalog.tableExists(full_name):
        same = spark.table(full_name).dtypes == frame.dtypes
        if same:
            spark.sql(f"ALTER TABLE {full_name} SET LOCATION '{location}'")
            spark.catalog.refreshTable(full_name)
            return
        if spark.catalog.getTable(full_name).tableType != "EXTERNAL":
            raise ValueError(f"{full_name} holds its own data in another shape; drop it first")
        spark.sql(f"DROP TABLE {full_name}")
    spark.catalog.createTable(full_name, path=location, source="parquet")
