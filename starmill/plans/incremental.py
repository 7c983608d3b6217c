"""The warehouse load as a series of batches: keys stay, facts are merged, calendars grow.

The first batch gives what ``init_load`` gives. A later one adds what is new in the source, puts corrected
payments and ratings in the place of the old ones, and writes only the months it touches.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions import date_parts
from starmill.operators import facts
from starmill.operators.dims import CALENDAR_COLUMNS
from starmill.operators.joins import lookup_join
from starmill.operators.registry import register, registered, registry_map
from starmill.plans.warehouse import ADDRESS_KEY, UNKNOWN_PRODUCER, USER_KEY
from starmill.sources import manifest
from starmill.sources.partitioned import merge_batch, read_partitioned
from starmill.sources.staging import stage, together

MONTH = "month"
#: Size of a lookup that a batch sends to all tasks. A series of batches has many lookups, and each passes through the driver.
LOOKUP_BYTES = 8 * 1024 * 1024


def _calendar_days(batch: Mapping[str, DataFrame]) -> DataFrame:
    """Every day between the first and last date of the batch."""
    days = batch["usrpagto"].select(F.col("datapagto").alias("d")).unionByName(batch["avaliacao"].select(F.col("avaliacaodata").alias("d")))
    span = days.agg(F.min(F.col("d").cast("date")).alias("lo"), F.max(F.col("d").cast("date")).alias("hi")).filter("lo IS NOT NULL")
    return span.select(F.explode(F.sequence("lo", "hi")).alias("datacompleta"))


def load_batch(source: Mapping[str, DataFrame], payments: DataFrame, ratings: DataFrame, root: str, name: str) -> dict[str, list[str]]:
    """Merge one batch into the warehouse below ``root``; returns the months written again per fact.

    ``source`` holds the operational tables usuario, filme, produtora and filmpagtoroy as they are now, the
    frames ``payments`` and ``ratings`` the new and corrected rows of usrpagto and avaliacao. A batch of the same
    ``name`` is merged once: if both facts have it, its keys are registered too and nothing is read.
    Registries are below ``root/keys``, facts below ``root/facts``.
    """
    spark, root = payments.sparkSession, root.rstrip("/")
    places = {fact: f"{root}/facts/{fact}" for fact in FACTS}
    if all(manifest.committed(spark, place, name) for place in places.values()):
        return {fact: [] for fact in FACTS}
    payments, ratings = together(lambda: stage(payments, "payments"), lambda: stage(ratings, "ratings"))
    rows = {"usrpagto": payments, "avaliacao": ratings}
    users = source["usuario"]
    unknown = spark.range(1).select(F.lit(None).cast(source["produtora"].schema["produtoraid"].dataType).alias("produtoraid"))
    user_keys, address_keys, film_keys, producer_keys, day_keys = together(
        lambda: register(users, USER_KEY, "usuariosk", f"{root}/keys/usuario", name),
        lambda: register(users, ADDRESS_KEY, "enderecosk", f"{root}/keys/endereco", name),
        lambda: register(source["filme"], ["filmeid"], "filmesk", f"{root}/keys/filme", name),
        # The unknown producer is the one without an id, numbered after the others of the first batch.
        lambda: register(source["produtora"].select("produtoraid").unionByName(unknown), ["produtoraid"], "produtorask", f"{root}/keys/produtora", name),
        lambda: register(_calendar_days(rows), ["datacompleta"], "calendariosk", f"{root}/keys/calendario", name),
    )
    user_map = stage(registry_map(users, user_keys, USER_KEY, "usuarioid", "usuariosk"), "user-map")

    def with_month(fact: DataFrame) -> DataFrame:
        days = day_keys.select("calendariosk", F.date_format("datacompleta", "yyyy-MM").alias(MONTH))
        return lookup_join(fact, days, "calendariosk")

    def revenue() -> DataFrame:
        if payments.isEmpty():  # no row to find an address for
            return spark.createDataFrame([], FACTS["receita"])
        address_map = registry_map(users, address_keys, ADDRESS_KEY, "usuarioid", "enderecosk")
        located = stage(user_map.join(address_map.hint("merge"), "usuarioid"), "user-keys")
        return with_month(facts.load_revenue(payments, located, day_keys, LOOKUP_BYTES))

    def rating() -> DataFrame:
        if ratings.isEmpty():  # no row to find a film and its payer for
            return spark.createDataFrame([], FACTS["avaliacao"])
        payer = stage(facts.latest_payer(source["filmpagtoroy"]), "payer")
        # A producer that carries the label stands for the unknown one, where there is any.
        labelled = source["produtora"].filter(F.col("produtoranome") == UNKNOWN_PRODUCER).select("produtoraid")
        named = producer_keys.join(labelled, "produtoraid", "left_semi").select(F.min("produtorask")).scalar()
        nobody = producer_keys.filter("produtoraid IS NULL").select(F.min("produtorask")).scalar()
        unknown_key = F.coalesce(named, nobody)
        films = stage(facts.film_lookup(film_keys, payer, producer_keys.dropna(), unknown_key, LOOKUP_BYTES), "film-keys")
        return with_month(facts.load_rating(ratings, user_map, films, day_keys, LOOKUP_BYTES))

    merged = together(
        lambda: merge_batch(revenue(), places["receita"], ["receitask"], MONTH, name),
        lambda: merge_batch(rating(), places["avaliacao"], ["avaliacaosk"], MONTH, name),
    )
    return dict(zip(FACTS, merged))


FACTS = {
    "receita": "receitask bigint, valorpago double, usuariosk bigint, calendariosk bigint, enderecosk bigint, month string",
    "avaliacao": "avaliacaosk bigint, nota int, usuariosk bigint, filmesk bigint, produtorask bigint, calendariosk bigint, month string",
}


def loaded_fact(spark: SparkSession, root: str, fact: str) -> DataFrame:
    """A fact of the warehouse below ``root`` as all batches left it."""
    like = spark.createDataFrame([], FACTS[fact])
    return read_partitioned(spark, f"{root.rstrip('/')}/facts/{fact}", like, MONTH).drop(MONTH)


def loaded_calendar(spark: SparkSession, root: str) -> DataFrame:
    """The calendar of all batches; days that a later batch added have the keys above."""
    like = spark.createDataFrame([], "datacompleta date")
    days = registered(spark, f"{root.rstrip('/')}/keys/calendario", ["datacompleta"], "calendariosk", like)
    return days.select("calendariosk", "datacompleta", *date_parts(F.col("datacompleta"))).select(*CALENDAR_COLUMNS)
