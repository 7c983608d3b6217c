"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.sources.staging import stage

_PLACE = "_place"


def _ordered(c: str | Column) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def dense_key(df: DataFrame, order_by: Sequence[str | Column], name: str, start: int = 1) -> DataFrame:
    """Number the rows 1..N in the given order, like ``row_number() over (order by …)``.

    The rows must be unique in ``order_by``. No task sees more than one key range:
    rows are range-partitioned, sorted and placed within their partition, written
    once, and the per-partition counts turn places into keys. The written table
    keeps counts and places consistent when executors are lost.
    """
    order = [_ordered(c) for c in order_by]
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = stage(placed.withColumn(_PLACE, F.monotonically_increasing_id()), f"key-{name}")

    within = F.col(_PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    if len(staged.inputFiles()) <= 1:  # one range, so places are already dense
        return staged.select((within + F.lit(start)).alias(name), *df.columns)

    part = F.shiftright(_PLACE, 33)
    counts = staged.groupBy(part.alias("_part")).count().collect()  # one row per partition
    bases, base = [], start
    for row in sorted(counts):
        bases.append((row["_part"], base))
        base += row["count"]

    offsets = df.sparkSession.createDataFrame(bases, "_part bigint, _base bigint")
    keyed = staged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return keyed.select((F.col("_base") + within).alias(name), *df.columns)


def next_key(df: DataFrame, key: str) -> Column:
    """``max(key) + 1``, or 1 for an empty table, as a scalar subquery."""
    return df.select(F.coalesce(F.max(key) + 1, F.lit(1)).cast("bigint").alias(key)).scalar()


def ensure_unknown_member(
    dim: DataFrame, key: str, label_column: str, label: str = "Produtora Desconhecida"
) -> DataFrame:
    """Append (max key + 1, label) unless a row already carries the label."""
    seen = F.max(F.when(F.col(label_column) == label, 1))
    row = (
        dim.agg(F.max(key).alias("top"), seen.alias("seen"))
        .filter(F.col("seen").isNull())
        .select(
            F.coalesce(F.col("top") + 1, F.lit(1)).cast(dim.schema[key].dataType).alias(key),
            F.lit(label).alias(label_column),
        )
    )
    return dim.unionByName(row, allowMissingColumns=True)


def member_key(dim: DataFrame, key: str, label_column: str, label: str) -> Column:
    """Key of the labelled row as a scalar subquery; the smallest if there are several."""
    return dim.filter(F.col(label_column) == label).select(F.min(key)).scalar()
