"""Rating model, scoring of every state and candidate, and the ranked result."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions import clip
from starmill.operators.keys import dense_key
from starmill.operators.profile import exact_quantiles
from starmill.operators.relational import top_k_per_group
from starmill.recommend import constants as K
from starmill.recommend import features, forest
from starmill.schemas import PREDICTION_STAGING
from starmill.sources.staging import stage

#: Values of a feature that can be told apart.
MAX_BINS = 256

# Output name of each ranked column.
OUTPUT_NAMES = {
    "filmenome": "FilmeNome",
    "anodelancamento": "AnoDeLancamento",
    "duracaomin": "DuracaoMin",
    "generonome": "GeneroNome",
    "imdbavaliacao": "IMDbAvaliacao",
    "imdbnumvotos": "IMDbNumVotos",
    "estado": "Estado",
    "predicaomodelo": "PredicaoModelo",
}


def default_task_memory_mb(spark: SparkSession) -> int:
    """A quarter of the memory one running task can count on, between 32 and 512 MB."""
    conf = spark.sparkContext.getConf()
    local = spark.sparkContext.master.startswith("local")
    text = conf.get("spark.driver.memory" if local else "spark.executor.memory", "1g").lower()
    size = re.fullmatch(r"(\d+)([kmgt]?)b?", text)
    scale = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024, "": 1 / 1024 / 1024}
    total = int(size[1]) * scale[size[2]] if size else 1024
    cores = spark.sparkContext.defaultParallelism if local else int(conf.get("spark.executor.cores", "1"))
    return int(min(512, max(32, total / cores / 4)))


def build_pipeline(buckets: dict[str, list[float]] | None = None) -> Pipeline:
    """Standardised numbers and one-hot categories, as the features of the forest.

    A category not seen in training encodes as all zeros: the indexer puts it in
    an extra last slot, and the encoder drops that slot. ``buckets`` names number columns that the
    forest sees in ranges.
    """
    indexed = [f"{c}_index" for c in K.CATEGORICAL_COLUMNS]
    hot = [f"{c}_hot" for c in K.CATEGORICAL_COLUMNS]
    buckets = buckets or {}
    ranged = [f"{c}_range" for c in buckets]
    bucketed = [
        Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol=c, outputCol=out) for (c, cuts), out in zip(buckets.items(), ranged)
    ]
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=K.NUMERIC_COLUMNS, outputCol="numbers"),
            StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True),
            StringIndexer(
                inputCols=K.CATEGORICAL_COLUMNS,
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
            *bucketed,
            VectorAssembler(inputCols=[*ranged, *hot] if len(ranged) == len(K.NUMERIC_COLUMNS) else ["scaled", *ranged, *hot],
                            outputCol=forest.FEATURES),
        ]
    )


def wide_numbers(rows: DataFrame, most: int) -> dict[str, list[float]]:
    """Range limits for the number columns with more than ``most`` distinct values: exact quantiles.

    A learner that meets more values than it has bins takes its splits from a sample that goes by
    partition; ranges that each hold many rows leave nothing to the sample.
    """
    counts = rows.agg(*[F.countDistinct(c).alias(c) for c in K.NUMERIC_COLUMNS]).first()
    wide = [c for c in K.NUMERIC_COLUMNS if counts[c] > most]
    if not wide:
        return {}
    found = exact_quantiles(rows, wide, [k / most for k in range(1, most)]).collect()  # ``most`` rows a column
    return {c: sorted({r["value"] for r in found if r["column_name"] == c}) for c in wide}


def train(
    training: DataFrame,
    num_trees: int = K.NUM_TREES,
    max_depth: int = K.MAX_DEPTH,
    seed: int = K.SEED,
    parts: int | None = None,
    task_memory_mb: int | None = None,
) -> PipelineModel:
    """Fit on the feature columns. The frame is read several times, so pass a written one.

    Equal rows are counted first and stay one row. Every running task may hold
    ``task_memory_mb`` of node statistics; more of it means fewer passes over the training rows, the trees
    are the same. ``parts`` is the number of tasks of a pass, by the number of rows unless given; it does not change the picks.
    """
    spark = training.sparkSession
    rows = stage(features.compact(training), "training-rows")
    prepared = build_pipeline(wide_numbers(rows, MAX_BINS - 1)).fit(training.select(*K.FEATURE_COLUMNS))
    hashed = F.xxhash64(*K.FEATURE_COLUMNS, K.TARGET).alias(forest.ROW)
    points = prepared.transform(rows).select(forest.FEATURES, K.TARGET, F.col(K.COUNT).alias(forest.COUNT), hashed)
    grown = forest.grow(
        stage(points, "training-points"), K.TARGET, num_trees, max_depth, seed, max_bins=MAX_BINS, parts=parts,
        task_memory_mb=task_memory_mb or default_task_memory_mb(spark),
    )
    return PipelineModel([*prepared.stages, grown])


def pair_states(states: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every state with every candidate given, and the candidate's place (from 0) in best-first order.

    Candidates may be any number: they are numbered in key ranges and stay spread. Each row
    expands by the states, which are one row per state, so the pairs are made where the
    candidates lie and ranking shuffles at most the best few per state and task.
    """
    best = [F.desc("imdbavaliacao"), F.desc("imdbnumvotos"), F.asc("filmeimdbskraw")]
    placed = dense_key(candidates, best, "place", start=0)
    every = states.filter(F.col("estado").isNotNull()).agg(F.array_sort(F.collect_set("estado"))).scalar()
    return placed.select(F.explode(every).alias("estado"), "place", *candidates.columns)


def score(pairs: DataFrame, model: PipelineModel) -> DataFrame:
    """Predicted rating, limited to 1..5."""
    scored = model.transform(pairs)
    return scored.select(*pairs.columns, clip("prediction", 1.0, 5.0).alias("predicaomodelo"))


def score_with(pairs: DataFrame, expr: Column) -> DataFrame:
    """The same with any column expression in place of a model."""
    return pairs.withColumn("predicaomodelo", clip(expr, 1.0, 5.0))


def rank_predictions(scored: DataFrame, top_k: int = K.TOP_K_PER_STATE, keep_id: bool = False) -> DataFrame:
    """The best ``top_k`` per state, numbered through by state and rank.

    Equal predictions keep the candidates' order. ``keep_id`` adds the film's own id.
    """
    top = top_k_per_group(scored, ["estado"], [F.desc("predicaomodelo"), F.asc("place")], top_k, rank="rank")
    keyed = dense_key(stage(top, "ranked"), ["estado", "rank"], "FilmeIMDbSK")
    out = keyed.withColumnsRenamed(OUTPUT_NAMES)
    extra = [F.col("filmeimdbskraw").alias("tconst")] if keep_id else []
    return out.select(*PREDICTION_STAGING, *extra)


def recommend(
    training: DataFrame,
    candidates: DataFrame,
    states: DataFrame,
    top_k: int = K.TOP_K_PER_STATE,
    fit: Callable[..., PipelineModel] = train,
    **options: int,
) -> DataFrame:
    """Train, score every state and candidate, and rank."""
    if training.isEmpty():
        raise RuntimeError("the training set is empty")
    if states.isEmpty():
        raise ValueError("no state to predict for")
    model = fit(training, **options)
    return rank_predictions(score(pair_states(states, candidates), model), top_k)
