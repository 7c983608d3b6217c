"""Training set to ranked predictions, written to a table and a Parquet folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starmill.recommend import constants as K
from starmill.recommend import features
from starmill.recommend.catalog import prepare_candidates
from starmill.recommend.model import recommend
from starmill.sources.staging import stage, together
from starmill.sources.writers import write_table

DEFAULT_TABLE_NAME = "model_infer"


def run_recommender(
    ratings: DataFrame,
    films: DataFrame,
    revenue: DataFrame,
    addresses: DataFrame,
    movies: DataFrame,
    schema: str | None = None,
    table_name: str = DEFAULT_TABLE_NAME,
    out_path: str | None = None,
    limit: int = K.CANDIDATE_LIMIT,
    top_k: int = K.TOP_K_PER_STATE,
    **model_options: int,
) -> DataFrame:
    """The source of each table is the caller's choice: catalogue, Parquet or text."""
    def assemble() -> DataFrame:
        states = stage(features.user_state(revenue, addresses), "user-state")
        return stage(features.training_set(ratings, films, states), "training")

    training, candidates = together(assemble, lambda: stage(prepare_candidates(movies, limit), "candidates"))
    predictions = recommend(
        training, candidates, features.known_states(training), top_k, **model_options
    )
    if schema:
        write_table(predictions, schema=schema, table_name=table_name)
    if out_path:
        predictions.write.mode("overwrite").parquet(out_path)
    return predictions
