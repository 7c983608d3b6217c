"""Constraint checks that follow a growing table: each batch is read once, its state is kept and merged.

The state of a batch is small rows about it: counts per column, its keys with their number of rows, and the values of its
references. The checks of the whole table come from the states alone.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.quality import ConstraintError
from starmill.schemas import Table
from starmill.sources import manifest
from starmill.sources.staging import together

COUNTS = "check_name string, column_name string, violations bigint"


def _parts(spark: SparkSession, root: str, what: str) -> list[str]:
    root = root.rstrip("/")
    paths = [f"{root}/{c['folder']}/{what}" for c in manifest.commits(spark, root) if c["folder"]]
    return [p for p in paths if manifest.exists(spark, p)]


def add_batch(batch: DataFrame, table: Table, root: str, name: str) -> None:
    """Read a batch and keep its state below ``root``. A batch of the same name is read once only.

    One scan counts nulls and long texts of all columns; keys and references read their own columns.
    Keys and values are counted on the map side, so a hot one is one row.
    """
    spark, root = batch.sparkSession, root.rstrip("/")
    if manifest.committed(spark, root, name):
        return
    folder = manifest.new_folder("state")
    counts = {("not_null", c): F.count_if(F.col(c).isNull()) for c in table.required()}
    counts |= {("length", c): F.count_if(F.length(c) > n) for c, n in table.lengths().items()}

    def columns() -> None:
        if counts:
            one = batch.agg(*[
                F.struct(F.lit(check).alias("check_name"), F.lit(c).alias("column_name"), n.alias("violations")).alias(f"_{i}")
                for i, ((check, c), n) in enumerate(counts.items())
            ])
            one.select(F.inline(F.array(*one.columns))).coalesce(1).write.parquet(f"{root}/{folder}/columns")

    def keys() -> None:
        if table.primary_key:
            found = batch.groupBy(*table.primary_key).agg(F.count(F.lit(1)).alias("n_rows"))
            # Sorted by key, so a later batch reads only the row groups whose range it meets.
            first = table.primary_key[0]
            found.repartitionByRange(first).sortWithinPartitions(first).write.parquet(f"{root}/{folder}/keys")

    def reference(column: str) -> None:
        values = batch.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
        values.write.parquet(f"{root}/{folder}/ref_{column}")

    together(columns, keys, *[lambda c=c: reference(c) for c, _ in table.foreign_keys])
    manifest.commit(spark, root, name, folder)


def repeated_keys(spark: SparkSession, table: Table, root: str) -> DataFrame:
    """Keys that occur more than once over all batches, with their number of rows."""
    key = list(table.primary_key)
    parts = _parts(spark, root, "keys")
    if not parts:
        raise ConstraintError(f"no state below {root}")
    kept = spark.read.parquet(*parts)
    return kept.groupBy(*key).agg(F.sum("n_rows").alias("n_rows")).filter(F.col("n_rows") > 1)


def clashes(batch: DataFrame, table: Table, root: str) -> DataFrame:
    """Keys of a batch that occur twice in it or are in the state already. Of the state only row groups
    within the batch's range of keys are read."""
    spark, key = batch.sparkSession, list(table.primary_key)
    own = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
    parts = _parts(spark, root, "keys")
    if not parts:
        return own.filter(F.col("n_rows") > 1)
    span = batch.agg(F.min(key[0]).alias("lo"), F.max(key[0]).alias("hi")).first()
    known = spark.read.parquet(*parts)
    known = known.filter(F.col(key[0]).between(F.lit(span["lo"]), F.lit(span["hi"])) | F.col(key[0]).isNull())
    both = own.unionByName(known.join(own.select(*key), key, "left_semi"))
    return both.groupBy(*key).agg(F.sum("n_rows").alias("n_rows")).filter(F.col("n_rows") > 1)


def missing_parents(spark: SparkSession, root: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Values of all batches without a parent as it is now, with their number of rows."""
    values = spark.read.parquet(*_parts(spark, root, f"ref_{column}"))
    values = values.groupBy(column).agg(F.sum("n_rows").alias("n_rows"))
    return values.join(parent.select(F.col(parent_column).alias(column)).distinct(), column, "left_anti")


def check_state(
    spark: SparkSession, table: Table, root: str, parents: Mapping[str, tuple[DataFrame, str]] | None = None
) -> DataFrame:
    """All declared constraints as (check_name, column_name, violations), like ``quality.check_table`` of all
    batches together, from their states. A parent that has grown settles references that lacked it."""
    absent = sorted({p for _, p in table.foreign_keys} - set(parents or {}))
    if absent:
        raise ConstraintError(f"no frame to check references to {', '.join(absent)}")

    def total(check: str, column: str, found: DataFrame) -> DataFrame:
        return found.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), "violations"
        )

    parts = []
    if table.primary_key:
        parts.append(total("unique", ",".join(table.primary_key), repeated_keys(spark, table, root)))
    columns = _parts(spark, root, "columns")
    if columns:
        counts = spark.read.schema(COUNTS).parquet(*columns)
        parts.append(counts.groupBy("check_name", "column_name").agg(F.sum("violations").alias("violations")))
    for column, parent in table.foreign_keys:
        parts.append(total("reference", column, missing_parents(spark, root, column, *parents[parent])))
    return reduce(DataFrame.unionByName, parts)
