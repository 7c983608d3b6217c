"""Supervised dataset: ratings with film attributes and the user's home state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions import coerce_numeric
from starmill.operators.joins import lookup_join
from starmill.operators.relational import drop_nulls, mode_by, sorted_values
from starmill.recommend.constants import COUNT, FEATURE_COLUMNS, TARGET


def user_state(revenue: DataFrame, addresses: DataFrame) -> DataFrame:
    """(usuariosk, estado): the most frequent state among the user's payments.

    Payments are counted per user and address before they meet the address table.
    No payments give no rows, which needs no special case.
    """
    counted = revenue.groupBy("usuariosk", "enderecosk").agg(F.count(F.lit(1)).alias("n"))
    placed = lookup_join(counted, addresses.select("enderecosk", "estado"), "enderecosk", "left")
    return mode_by(drop_nulls(placed, ["estado"]), ["usuariosk"], "estado", weight="n")


def training_set(ratings: DataFrame, films: DataFrame, states: DataFrame) -> DataFrame:
    """Ratings with all features present; ``states`` comes from :func:`user_state`."""
    film_columns = films.select("filmesk", "filmenome", "anodelancamento", "duracaomin", "generonome")
    facts = ratings.select("avaliacaosk", "usuariosk", "filmesk", TARGET)
    rows = lookup_join(facts, states, "usuariosk")
    rows = lookup_join(rows, film_columns, "filmesk", "left", skew_of=facts)
    rows = coerce_numeric(rows, ["anodelancamento", "duracaomin", TARGET])
    return drop_nulls(rows, FEATURE_COLUMNS + [TARGET]).select(
        "avaliacaosk", "usuariosk", "filmesk", TARGET, "filmenome", *FEATURE_COLUMNS
    )


def known_states(training: DataFrame) -> DataFrame:
    """Distinct states of the training set, sorted."""
    return sorted_values(training, "estado")


def compact(training: DataFrame) -> DataFrame:
    """Training rows for the forest: the distinct features and target, and how many rows have them.

    Features are few distinct values, so popular films give the same row very many
    times. Equal rows are counted on the map side, so a hot film does not load one task.
    """
    return training.groupBy(*FEATURE_COLUMNS, TARGET).agg(F.count(F.lit(1)).alias(COUNT))
