"""Address roll-up to one row per state, and the prediction fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators import dims, facts, mutate
from starmill.operators.joins import lookup_join
from starmill.plans.warehouse import ADDRESS_KEY
from starmill.sources.staging import stage


def user_addresses(
    users: DataFrame, addresses: DataFrame, user_map: DataFrame | None, user_key: str = "mapped"
) -> DataFrame:
    """(usuariosk, enderecosk) to put on the user dimension.

    ``mapped`` goes through the key map; several ids of one user give the address
    of the smallest id. ``positional`` takes the operational id for the warehouse
    key, which reproduces the original script and its mismatch.
    """
    located = lookup_join(
        users.select("usuarioid", *ADDRESS_KEY), addresses.select(*ADDRESS_KEY, "enderecosk"), ADDRESS_KEY, "left"
    ).select("usuarioid", "enderecosk")
    if user_key == "positional":
        return located.select(F.col("usuarioid").cast("bigint").alias("usuariosk"), "enderecosk")
    if user_key != "mapped":
        raise ValueError("user_key must be 'mapped' or 'positional'")
    keyed = located.join(user_map.select("usuarioid", "usuariosk"), "usuarioid")
    return keyed.groupBy("usuariosk").agg(F.min_by("enderecosk", "usuarioid").alias("enderecosk"))


def roll_up_addresses(
    warehouse: Mapping[str, DataFrame],
    users: DataFrame,
    user_map: DataFrame | None = None,
    user_key: str = "mapped",
) -> dict[str, DataFrame]:
    """New snapshots of receita, avaliacao and endereco at state grain.

    The inputs stay as they are, so the roll-up can run again.
    """
    address_of = stage(user_addresses(users, warehouse["endereco"], user_map, user_key), "user-address")
    usuario = mutate.update_from(
        warehouse["usuario"], address_of, {"usuariosk": "usuariosk"}, {"enderecosk": "enderecosk"}
    )
    to_state = stage(mutate.rollup_map(warehouse["endereco"], "estado", "enderecosk"), "rollup-map")
    remap = {"on": {"enderecosk": "enderecosk_original"}, "assign": {"enderecosk": "enderecosk_new"}}
    # Keys of a dimension are unique, and so are the keys of its map.
    receita = mutate.update_from(warehouse["receita"], to_state, **remap, validate=False)
    usuario = stage(mutate.update_from(usuario, to_state, **remap, validate=False), "user-state")
    avaliacao = mutate.update_from(
        warehouse["avaliacao"], usuario, {"usuariosk": "usuariosk"}, {"enderecosk": "enderecosk"}, validate=False
    )
    return {
        **warehouse,
        "receita": receita,
        "avaliacao": avaliacao,
        "endereco": mutate.shrink_dimension(warehouse["endereco"], "estado", "enderecosk"),
    }


def rollup_and_predict(
    warehouse: Mapping[str, DataFrame],
    users: DataFrame,
    predictions: DataFrame,
    run_date: dt.date | str | None = None,
    user_map: DataFrame | None = None,
    user_key: str = "mapped",
    weekday_style: str = "short",
    on_unmatched: str = "fail",
) -> dict[str, DataFrame]:
    """The eight warehouse frames after the roll-up, and ``rejected`` predictions."""
    rolled = roll_up_addresses(warehouse, users, user_map, user_key)
    rolled["calendario"] = dims.ensure_day(warehouse["calendario"], run_date, weekday_style)
    rolled["modelprediction"], rolled["rejected"] = facts.load_prediction(
        predictions, rolled["endereco"], rolled["calendario"], run_date, on_unmatched
    )
    return rolled
