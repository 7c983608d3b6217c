"""Initial load of the seven warehouse tables from the operational source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators import dims, facts
from starmill.operators.keys import ensure_unknown_member, member_key
from starmill.sources.staging import stage, together

USER_KEY = ["email", "telefone"]
ADDRESS_KEY = ["bairro", "municipio", "estado", "logradouro"]
UNKNOWN_PRODUCER = "Produtora Desconhecida"
UNKNOWN_GENRE = "Gênero Desconhecido"


def load_users(users: DataFrame) -> tuple[DataFrame, DataFrame]:
    """User dimension and (usuarioid, usuariosk)."""
    dim = dims.from_distinct(users, USER_KEY, "usuariosk")
    return dim, stage(dims.key_map(users, dim, USER_KEY, "usuarioid", "usuariosk"), "user-map")


def load_films(films: DataFrame, genres: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Film dimension and (filmeid, filmesk)."""
    keyed = dims.from_entity(films, "filmeid", "filmesk")
    named = dims.with_bridge(keyed, genres, "filmeid", "generofilme", UNKNOWN_GENRE)
    dim = named.select(
        "filmesk",
        "duracaomin",
        "filmenome",
        F.col("anode_lancamento").alias("anodelancamento"),
        F.col("generofilme").alias("generonome"),
    )
    return stage(dim, "films"), keyed.select("filmeid", "filmesk")


def load_producers(producers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Producer dimension with its unknown member, and (produtoraid, produtorask)."""
    keyed = dims.from_entity(producers.select("produtoraid", "produtoranome"), "produtoraid", "produtorask")
    dim = ensure_unknown_member(
        keyed.select("produtorask", "produtoranome"), "produtorask", "produtoranome", UNKNOWN_PRODUCER
    )
    return dim, keyed.select("produtoraid", "produtorask")


def load_addresses(users: DataFrame) -> DataFrame:
    """Address dimension."""
    return dims.from_distinct(users, ADDRESS_KEY, "enderecosk")


def film_keys_of(
    film_map: DataFrame, payer: DataFrame, producers: DataFrame, producer_map: DataFrame
) -> DataFrame:
    """(filmeid, filmesk, produtorask) for the rating rows, written once."""
    unknown = member_key(producers, "produtorask", "produtoranome", UNKNOWN_PRODUCER)
    return stage(facts.film_lookup(film_map, payer, producer_map, unknown), "film-keys")


def user_keys_of(users: DataFrame, user_map: DataFrame, addresses: DataFrame) -> DataFrame:
    """(usuarioid, usuariosk, enderecosk) for the payment rows, written once."""
    return stage(facts.user_lookup(users, user_map, addresses, ADDRESS_KEY), "user-keys")


def init_load(
    source: Mapping[str, DataFrame],
    run_date: dt.date | str | None = None,
    weekday_style: str = "short",
) -> dict[str, DataFrame]:
    """The seven warehouse frames, and ``user_map`` for the later roll-up.

    ``source`` holds the operational tables usuario, filme, filme_generofilme,
    produtora, filmpagtoroy, avaliacao and usrpagto.
    """
    bounds = [(source["avaliacao"], "avaliacaodata"), (source["usrpagto"], "datapagto")]
    (usuario, user_map), endereco, (films, film_map), (produtora, producer_map), payer, calendario = together(
        lambda: load_users(source["usuario"]),
        lambda: load_addresses(source["usuario"]),
        lambda: load_films(source["filme"], source["filme_generofilme"]),
        lambda: load_producers(source["produtora"]),
        lambda: stage(facts.latest_payer(source["filmpagtoroy"]), "payer"),
        lambda: stage(dims.calendar(bounds, run_date, weekday_style), "calendar"),
    )
    film_keys, user_keys = together(
        lambda: film_keys_of(film_map, payer, produtora, producer_map),
        lambda: user_keys_of(source["usuario"], user_map, endereco),
    )
    avaliacao, receita = together(
        lambda: facts.load_rating(source["avaliacao"], user_map, film_keys, calendario),
        lambda: facts.load_revenue(source["usrpagto"], user_keys, calendario),
    )
    return {
        "usuario": usuario,
        "filme": films,
        "endereco": endereco,
        "calendario": calendario,
        "produtora": produtora,
        "avaliacao": avaliacao,
        "receita": receita,
        "user_map": user_map,
    }
