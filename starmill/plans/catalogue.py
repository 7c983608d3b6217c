"""External catalogue: landing files to typed tables to the movie extract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from starmill.recommend.catalog import extract_movies
from starmill.schemas import CATALOGUE
from starmill.sources.landing import ingest_landing


def load_catalogue(
    spark: SparkSession,
    landing: Mapping[str, str],
    brute_zone: str,
    out_path: str,
    fmt: str = "parquet",
    null_marker: str | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Ingest the named tab-separated files and write the movie extract."""
    tables = ingest_landing(spark, landing, CATALOGUE, brute_zone, fmt, null_marker)
    movies = extract_movies(tables["title-basics"], tables["title-ratings"])
    movies.write.mode("overwrite").parquet(out_path)
    return tables, spark.read.schema(movies.schema).parquet(out_path)
