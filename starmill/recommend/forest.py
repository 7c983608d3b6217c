"""A regression forest whose bootstrap follows the rows and not their partitions.

Spark's own forest draws its samples by partition and position, so its trees change with the number
of partitions. Here a row's weight in a tree is drawn from a hash of the row and the tree: equal rows are one
row with their count ``n``, whose weight is Poisson distributed around ``n``, as ``n`` single draws
would add up to. The trees are Spark's, grown next to each other on these weights.
"""

from __future__ import annotations

import math

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.sources.staging import together

#: Means below are drawn by the distribution function, others by its normal expansion.
SMALL_MEAN = 30
#: Rows of the training table that one task works on.
ROWS_PER_PART = 200_000
#: Below this many distinct rows, one-hot columns are grown on as plain numbers, with the same splits.
FEW = 1000
FEATURES, WEIGHT, COUNT, ROW = "features", "weight", "n", "row_hash"


def uniform(*parts: Column) -> Column:
    """A number between 0 and 1, exclusive, by hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + F.lit(0.5)) * F.lit(2.0**-53)


def poisson(mean: Column, *parts: Column) -> Column:
    """A Poisson draw by hash of the parts, as a double."""
    u = uniform(*parts)
    first = F.exp(-mean)
    # How many steps the distribution function takes to pass u.
    steps = F.sequence(F.lit(1), (mean + 10 * F.sqrt(mean) + 10).cast("int"))
    begin = F.struct(first.alias("p"), first.alias("upto"), F.lit(0).alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * mean / i
        return F.struct(p.alias("p"), (s["upto"] + p).alias("upto"), (s["k"] + (s["upto"] <= u).cast("int")).alias("k"))

    small = F.aggregate(steps, begin, step)["k"].cast("double")
    z = F.sqrt(-2 * F.log(u)) * F.cos(2 * math.pi * uniform(*parts, F.lit("angle")))
    large = F.greatest(F.floor(mean + F.sqrt(mean) * z + (z * z - 1) / 6 + 0.5), F.lit(0)).cast("double")
    return F.when(mean < SMALL_MEAN, small).otherwise(large)


def bootstrap_weight(count: Column, row: Column, tree: Column, seed: int) -> Column:
    """How often ``count`` equal rows with the hash ``row`` occur in the sample of a tree."""
    return poisson(count.cast("double"), row, tree, F.lit(seed))


def sample_sizes(rows: DataFrame, num_trees: int, seed: int) -> dict[int, float]:
    """Total weight of each tree's sample; a tree without a row is missing."""
    trees = rows.select(COUNT, ROW, F.explode(F.sequence(F.lit(0), F.lit(num_trees - 1))).alias("tree"))
    weight = bootstrap_weight(F.col(COUNT), F.col(ROW), F.col("tree"), seed)
    sums = trees.groupBy("tree").agg(F.sum(weight).alias("w")).filter("w > 0")
    return {r["tree"]: r["w"] for r in sums.collect()}  # one row per tree


def grow(
    rows: DataFrame,
    target: str,
    num_trees: int,
    max_depth: int,
    seed: int,
    min_leaf: int = 5,
    max_bins: int = 256,
    task_memory_mb: int = 256,
    parts: int | None = None,
) -> RandomForestRegressionModel:
    """A forest over ``features``, ``target``, ``n`` and ``row_hash``, one row per distinct training row.

    Every leaf has a sample weight of ``min_leaf`` at least. ``parts`` follows the number of rows
    unless given, and does not change the trees: where the features have fewer distinct values than ``max_bins``, every
    one of them is a possible split, and sums of grades are exact in any order.
    """
    distinct = rows.count()
    parts = parts or -(-distinct // ROWS_PER_PART)
    points = F.col(FEATURES)
    if distinct < FEW:  # a sample of one row has fewer bins than a column known as binary has values
        points = points.alias(FEATURES, metadata={})
    held = rows.select(points, target, COUNT, ROW).repartition(max(1, parts), ROW).persist()
    try:
        sizes = sample_sizes(held, num_trees, seed)

        def fit(tree: int) -> DecisionTreeRegressionModel:
            if tree in sizes:
                weight, total = bootstrap_weight(F.col(COUNT), F.col(ROW), F.lit(tree), seed), sizes[tree]
                sample = held.withColumn(WEIGHT, weight).filter(F.col(WEIGHT) > 0)
            else:  # very few rows, none of them drawn
                sample, total = held.withColumn(WEIGHT, F.col(COUNT).cast("double")), float(min_leaf)
            learner = DecisionTreeRegressor(
                featuresCol=FEATURES, labelCol=target, weightCol=WEIGHT, maxDepth=max_depth, maxBins=max_bins,
                minWeightFractionPerNode=min(0.499, (min_leaf - 0.5) / total), maxMemoryInMB=task_memory_mb, seed=seed + tree,
            )
            return learner.fit(sample)

        trees = together(*[lambda t=t: fit(t) for t in range(num_trees)])
    finally:
        held.unpersist()
    return as_forest(rows, trees)


def as_forest(rows: DataFrame, trees: list[DecisionTreeRegressionModel]) -> RandomForestRegressionModel:
    """The trees as one model that predicts their mean, and can be saved like any other."""
    sc = rows.sparkSession.sparkContext
    package = sc._jvm.org.apache.spark.ml.regression
    array = sc._gateway.new_array(package.DecisionTreeRegressionModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree._java_obj
    made = package.RandomForestRegressionModel(f"forest_{trees[0].uid}", array, trees[0].numFeatures)
    made.set(made.getParam("numTrees"), len(trees))
    return RandomForestRegressionModel(made)
