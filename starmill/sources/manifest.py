"""What a folder holds, as a list of commits. Data that no commit names does not count.

Each commit is written as one small file after its data is in place, so a run that fails before leaves
nothing behind that a reader would see, and a run that is sent again can tell that it was done.
One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

COMMITS = "commits"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def commits(spark: SparkSession, root: str) -> list[Row]:
    """The commits in order: ``n``, ``batch``, ``folder`` and ``at``. One row each, so there are few."""
    path = f"{root.rstrip('/')}/{COMMITS}"
    if not exists(spark, path):
        return []
    return spark.read.schema("n long, batch string, folder string, at timestamp").parquet(path).orderBy("n").collect()


def committed(spark: SparkSession, root: str, batch: str) -> bool:
    return any(c["batch"] == batch for c in commits(spark, root))


def commit(spark: SparkSession, root: str, batch: str, folder: str | None = None) -> None:
    """Name a batch, and the folder below the root that holds its data."""
    known = commits(spark, root)
    row = spark.range(1).select(
        F.lit(len(known)).cast("long").alias("n"), F.lit(batch).alias("batch"), F.lit(folder).cast("string").alias("folder"),
        F.current_timestamp().alias("at"),
    )
    row.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{COMMITS}")


def new_folder(name: str) -> str:
    """A name that no earlier attempt has used."""
    return f"{name}-{uuid.uuid4().hex[:12]}"


def committed_frame(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """All committed folders below the root as one frame; empty if there is none."""
    paths = [f"{root.rstrip('/')}/{c['folder']}" for c in commits(spark, root) if c["folder"]]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
