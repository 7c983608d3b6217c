"""Fact loads. Each fact row meets every dimension once, through prepared lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import as_date
from starmill.operators.joins import BROADCAST_BYTES, lookup_join
from starmill.operators.quality import ConstraintError
from starmill.operators.relational import latest_by
from starmill.sources.staging import stage


def latest_payer(royalties: DataFrame) -> DataFrame:
    """Producer of the latest royalty payment per film; the smallest id on equal dates."""
    return latest_by(royalties, ["filmeid"], "produtoraid", "datapagto")


def film_lookup(
    film_map: DataFrame, payer: DataFrame, producer_map: DataFrame, unknown_key: Column, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """(filmeid, filmesk, produtorask): the film's payer or the unknown member.

    Resolving the producer per film keeps these two joins off the rating rows.
    """
    paid = lookup_join(payer, producer_map, "produtoraid", max_bytes=max_bytes).select("filmeid", "produtorask")
    joined = film_map.select("filmeid", "filmesk").join(paid, "filmeid", "left")
    return joined.withColumn("produtorask", F.coalesce("produtorask", unknown_key))


def load_rating(
    ratings: DataFrame, user_map: DataFrame, films: DataFrame, cal: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Rating fact; ``films`` comes from :func:`film_lookup`. Unmatched rows drop out."""
    rows = ratings.select(
        F.col("avaliacaoid").alias("avaliacaosk"),
        "nota",
        "usuarioid",
        "filmeid",
        F.col("avaliacaodata").alias("datacompleta"),
    )
    joined = lookup_join(rows, user_map.select("usuarioid", "usuariosk"), "usuarioid", max_bytes=max_bytes)
    return _rated(joined, films, cal, rows, max_bytes)


def rate(ratings: DataFrame, films: DataFrame, cal: DataFrame) -> DataFrame:
    """The same for ratings that have their user's key already, as after a bucket join."""
    rows = ratings.withColumnsRenamed({"avaliacaoid": "avaliacaosk", "avaliacaodata": "datacompleta"})
    return _rated(rows, films, cal, rows)


def _rated(
    joined: DataFrame, films: DataFrame, cal: DataFrame, rows: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    joined = lookup_join(joined, films, "filmeid", max_bytes=max_bytes, skew_of=rows)
    joined = lookup_join(joined, cal.select("datacompleta", "calendariosk"), "datacompleta", skew_of=rows)
    return joined.select("avaliacaosk", "nota", "usuariosk", "filmesk", "produtorask", "calendariosk")


def user_lookup(users: DataFrame, user_map: DataFrame, addresses: DataFrame, address_key: list[str]) -> DataFrame:
    """(usuarioid, usuariosk, enderecosk). The address match runs once per user, not per payment."""
    located = lookup_join(
        users.select("usuarioid", *address_key), addresses.select(*address_key, "enderecosk"), address_key
    ).select("usuarioid", "enderecosk")
    return located.join(user_map.select("usuarioid", "usuariosk"), "usuarioid")


def load_revenue(payments: DataFrame, users: DataFrame, cal: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Revenue fact; ``users`` comes from :func:`user_lookup`. Unmatched rows drop out."""
    rows = payments.select(
        F.col("usrpagtoid").alias("receitask"),
        "valorpago",
        "usuarioid",
        F.col("datapagto").alias("datacompleta"),
    )
    joined = lookup_join(rows, users, "usuarioid", max_bytes=max_bytes)
    joined = lookup_join(joined, cal.select("datacompleta", "calendariosk"), "datacompleta", skew_of=rows)
    return joined.select("receitask", "valorpago", "usuariosk", "calendariosk", "enderecosk")


def load_prediction(
    predictions: DataFrame,
    addresses: DataFrame,
    cal: DataFrame,
    run_date: dt.date | str | Column | None = None,
    on_unmatched: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Prediction fact and the rows rejected for a missing key.

    ``fail`` raises when any row is rejected, as NOT NULL keys would; ``reject``
    only returns them. ``addresses`` must have one row per state.
    """
    if on_unmatched not in ("fail", "reject"):
        raise ValueError("on_unmatched must be 'fail' or 'reject'")
    today = cal.filter(F.col("datacompleta") == as_date(run_date)).select(F.min("calendariosk")).scalar()
    placed = lookup_join(
        predictions.withColumnRenamed("Estado", "estado"), addresses.select("estado", "enderecosk"), "estado", "left"
    )
    fact = placed.select(
        F.col("FilmeIMDbSK").cast("bigint").alias("filmeimdbsk"),
        F.col("FilmeNome").alias("filmenome"),
        F.col("AnoDeLancamento").cast("int").alias("anodelancamento"),
        F.col("DuracaoMin").cast("int").alias("duracaomin"),
        F.col("GeneroNome").alias("generonome"),
        F.col("IMDbAvaliacao").cast("double").alias("imdbavaliacao"),
        F.col("IMDbNumVotos").cast("double").alias("imdbnumvotos"),
        F.col("PredicaoModelo").cast("double").alias("predicaomodelo"),
        "enderecosk",
        today.alias("calendariosk"),
    )
    fact = stage(fact, "prediction-fact")
    missing = F.greatest(*[F.col(c).isNull() for c in fact.columns])
    rejected = fact.filter(missing)
    if on_unmatched == "fail" and not rejected.isEmpty():
        raise ConstraintError(f"prediction fact has rows without a key: {rejected.first()}")
    return fact.filter(~missing), rejected
