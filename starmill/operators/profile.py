"""Row counts, samples and exact descriptive statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import coerce_numeric
from starmill.sources.staging import stage


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its name, row count and number of columns."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation, as (column_name, prob, value).

    The built-in ``percentile`` keeps every distinct value of a column in one
    buffer. Here values are counted, spread by range, and only the ranges that
    hold a wanted rank are accumulated.
    """
    spark = df.sparkSession
    long = coerce_numeric(df.select(*columns), columns).unpivot([], list(columns), "column_name", "v")
    counts = long.filter(F.col("v").isNotNull()).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
    spread = counts.repartitionByRange("column_name", "v").withColumn("part", F.spark_partition_id())
    staged = stage(spread, "quantiles")

    # At most one row per column and range.
    sizes = staged.groupBy("column_name", "part").agg(F.sum("n").alias("n")).collect()
    wanted = []
    for column in columns:
        ranges = sorted((r["part"], r["n"]) for r in sizes if r["column_name"] == column)
        total = sum(n for _, n in ranges)
        for prob in probs if total else ():
            at = (total - 1) * prob
            for rank, share in ((math.floor(at), 1 - (at - math.floor(at))), (math.ceil(at), at - math.floor(at))):
                base = 0
                for part, n in ranges:
                    if rank < base + n:
                        wanted.append((column, part, float(prob), rank - base, share))
                        break
                    base += n
    schema = "column_name string, part int, prob double, place bigint, share double"
    targets = spark.createDataFrame(wanted, schema)

    needed = staged.join(F.broadcast(targets.select("column_name", "part").distinct()), ["column_name", "part"], "left_semi")
    w = Window.partitionBy("column_name", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = needed.withColumn("upto", F.sum("n").over(w))
    hits = running.join(F.broadcast(targets), ["column_name", "part"]).filter(
        (F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("n"))
    )
    return hits.groupBy("column_name", "prob").agg(F.sum(F.col("v") * F.col("share")).alias("value"))


def describe_exact(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max, one row per column."""
    numbers = coerce_numeric(df.select(*columns), columns)
    one_pass = numbers.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("count"),
                F.mean(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).alias("min"),
                F.max(c).alias("max"),
            ).alias(f"_{i}")
            for i, c in enumerate(columns)
        ]
    )
    moments = one_pass.select(F.inline(F.array(*one_pass.columns)))
    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        .groupBy("column_name")
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("value"))).alias(label)
                for p, label in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
            ]
        )
    )
    # Both sides have one row per described column.
    return moments.join(F.broadcast(quartiles), "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )
