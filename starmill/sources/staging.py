"""Written intermediate tables in the cluster's shared folder.

A written table cuts lineage and survives the loss of executors. It is columnar,
so later readers still prune columns.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Where it is unset, the context's checkpoint folder is used. Only a local
    session (tests) gets a folder of its own; a cluster session must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starmill-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_scope = "session"


def _scope_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/starmill/{spark.sparkContext.applicationId}/{_scope}"


def staged_path(spark: SparkSession, label: str) -> str:
    return f"{_scope_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[str]:
    """What is staged inside belongs to one run and is removed at its end, also on failure.

    Frames that read staged rows end with it, so write results within. Runs do not nest.
    """
    global _scope
    before, _scope = _scope, f"run-{uuid.uuid4().hex[:12]}"
    folder = _scope_dir(spark)
    try:
        yield folder
    finally:
        _scope = before
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once to the shared folder and read it back."""
    path = staged_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*jobs: Callable) -> list:
    """Run independent steps at the same time, so one's last tasks overlap another's
    first ones. Results come back in the order given."""
    if not jobs:
        return []
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(min(8, len(jobs))) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]
