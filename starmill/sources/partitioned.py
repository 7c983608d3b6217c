"""A fact kept in date partitions, into which batches are merged one at a time.

Only partitions that a batch touches are written again; files of all others stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.quality import ConstraintError, check_unique
from starmill.sources import manifest
from starmill.sources.staging import stage

DATA = "data"


def read_partitioned(spark: SparkSession, root: str, like: DataFrame, partition: str) -> DataFrame:
    """The fact as it is now, with the columns of ``like``."""
    path = f"{root.rstrip('/')}/{DATA}"
    if not manifest.exists(spark, path):
        return spark.createDataFrame([], like.schema)
    columns = [f for f in like.schema if f.name != partition] + [like.schema[partition]]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
    return spark.read.schema(schema).parquet(path).select(*like.columns)


def merge_batch(
    batch: DataFrame, root: str, key: Sequence[str], partition: str, name: str, deleted: str | None = None, moves: bool = True
) -> list:
    """Insert the rows of ``batch`` or put them in the place of rows with their key; returns the partitions
    written again.

    ``name`` identifies the batch: one that was merged before is left out. ``deleted`` names a boolean column of the
    batch, true for keys to take out. A row may change its partition; ``moves=False`` promises that
    none does and saves reading the keys of the other partitions. Partition values must not be null and the batch must be
    unique in its key. If a run fails before its commit, the same batch can be merged again:
    replacing by key gives the same rows however often it is done.
    """
    spark, key, root = batch.sparkSession, list(key), root.rstrip("/")
    if manifest.committed(spark, root, name):
        return []
    batch = stage(batch, "batch")
    broken = check_unique(batch, key).select(F.to_json(F.struct(*key)).alias("k"))
    broken = broken.unionByName(batch.filter(F.col(partition).isNull()).select(F.lit(f"null {partition}").alias("k")))
    bad = broken.first()
    if bad is not None:
        raise ConstraintError(f"batch {name} cannot be merged: {bad['k']}")
    rows = batch.filter(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else batch
    old = read_partitioned(spark, root, rows, partition)
    # Both sides of the joins are unique in the key, so neither has a hot one.
    keys = batch.select(*key).hint("merge")

    # One row per partition.
    touched = {r[0] for r in rows.select(partition).distinct().collect()}
    if moves or deleted:
        held = old.select(*key, partition).join(keys, key, "left_semi").select(partition).distinct()
        touched |= {r[0] for r in held.collect()}
    if not touched:
        manifest.commit(spark, root, name)
        return []
    within = old.filter(F.col(partition).isin(sorted(touched)))
    kept = stage(within.join(keys, key, "left_anti"), "kept") if manifest.exists(spark, f"{root}/{DATA}") else old
    whole = kept.unionByName(rows.select(*kept.columns))
    path = f"{root}/{DATA}"
    # Partitions that lose their last row are not overwritten by a write, so they are taken out.
    left = dict(whole.groupBy(partition).count().collect())
    ordered = whole.repartition(partition, _slice(whole, partition, left)).sortWithinPartitions(partition, *key)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    for value in touched - set(left):
        _remove(spark, f"{path}/{partition}={value}")
    manifest.commit(spark, root, name)
    return sorted(touched)


#: Rows of one file, roughly.
ROWS_PER_FILE = 1_000_000


def _slice(rows: DataFrame, partition: str, counts: dict):
    """A number that deals each partition to as many tasks as its rows, one count a partition, ask for."""
    files = max(1, -(-max(counts.values(), default=0) // ROWS_PER_FILE))
    return F.pmod(F.xxhash64(*[c for c in rows.columns if c != partition]), F.lit(files))


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
