"""Grouped picks, top-N and null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.operators.joins import lookup_join
from starmill.operators.keys import dense_key

_RANK = "_rank"
# Up to this k Spark cuts each group to k rows before the shuffle.
EARLY_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """The first k rows of each group, in a total order.

    Each task first cuts its part of a group to k rows, so a group that holds most
    rows shuffles little. For a k beyond the session's early limit all rows are numbered
    in key ranges instead, and the rank is the distance from the group's first. Null is a
    group like any other, in both ways.
    """
    if k <= int(df.sparkSession.conf.get(EARLY_LIMIT, "1000")):
        w = Window.partitionBy(*group).orderBy(*order)
        ranked = df.withColumn(_RANK, F.row_number().over(w))
    else:
        keyed = dense_key(df, [*group, *order], "_n")
        keyed = keyed.withColumn("_g", F.struct(*group))  # a struct is never null, so null groups meet
        first = keyed.groupBy("_g").agg(F.min("_n").alias("_first"))
        placed = lookup_join(keyed, first, "_g")
        ranked = placed.select(*df.columns, (F.col("_n") - F.col("_first") + 1).cast("int").alias(_RANK))
    out = ranked.filter(F.col(_RANK) <= k)
    return out.withColumnRenamed(_RANK, rank) if rank else out.drop(_RANK)


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the first in ``order``."""
    return top_k_per_group(df, keys, order, 1)


def latest_by(df: DataFrame, keys: Sequence[str], value: str, by: str) -> DataFrame:
    """Value of the row with the latest date or timestamp per key; at one time the smallest
    value. Rows without a time come last.

    One aggregation, combined on the map side: a task sends one row per key, however many
    values or rows the key has.
    """
    moment = F.unix_micros(F.col(by).cast("timestamp"))
    first = F.struct(F.coalesce(-moment, F.lit(2**63 - 1)).alias("a"), F.col(value).alias(value))
    return df.groupBy(*keys).agg(F.min(first).alias("_first")).select(*keys, F.col(f"_first.`{value}`").alias(value))


def mode_by(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Most frequent non-null value per key, the smallest among ties.

    Counting per (key, value) combines on the map side; only the counts of a key
    meet in one task. ``weight`` names a column of prior counts.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("_n"))
    return counts.groupBy(*keys).agg(F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value))


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows overall; each task keeps only n."""
    return df.orderBy(*order).limit(n)


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without null or NaN in the columns."""
    return df.na.drop(subset=list(columns))


def min_by_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Smallest value per key."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
