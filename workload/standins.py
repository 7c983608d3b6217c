"""The given tables seen as the operational source and the film catalogue.

Each function has its SQL counterpart of the same name in ``workload.sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the file once, then declared."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def usuario(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation, region = (table(spark, folder, n) for n in ("customer", "nation", "region"))
    # Nation and region are fixed, tiny tables; Spark broadcasts them by file size.
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("usuarioid"),
            F.col("c_name").alias("email"),
            F.col("c_nationkey").cast("string").alias("telefone"),
            F.col("c_mktsegment").alias("bairro"),
            F.col("n_name").alias("municipio"),
            F.col("r_name").alias("estado"),
            F.concat(F.lit("Rua "), F.floor(F.col("c_acctbal") / 1000).cast("int").cast("string")).alias("logradouro"),
        )
    )


def filme(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("filmeid"),
        F.col("p_name").alias("filmenome"),
        F.col("p_size").alias("duracaomin"),
        (F.lit(1970) + F.col("p_partkey") % 56).cast("int").alias("anode_lancamento"),
    )


def filme_generofilme(spark: SparkSession, folder: str) -> DataFrame:
    """Every line tags a film. The films' ids skip each eighth one, so an eighth has no tag, and
    the tags of the highest ids have no film."""
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_returnflag", "l_linestatus").alias("generofilme"),
        F.expr("(l_partkey div 7) * 8 + l_partkey % 7").alias("filmeid"),
    )


def produtora(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("produtoraid"), F.col("s_name").alias("produtoranome")
    )


def filmpagtoroy(spark: SparkSession, folder: str) -> DataFrame:
    """Every line is a royalty payment. The films' ids skip each fifth one, which so has none."""
    return table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("valorpagto"),
        F.col("l_shipdate").cast("date").alias("datapagto"),
        F.col("l_suppkey").alias("produtoraid"),
        F.expr("(l_partkey div 4) * 5 + l_partkey % 4").alias("filmeid"),
    )


def usrpagto(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("usrpagtoid"),
        F.col("o_totalprice").alias("valorpago"),
        F.col("o_orderdate").cast("date").alias("datapagto"),
        F.col("o_custkey").alias("usuarioid"),
    )


def avaliacao(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias("avaliacaoid"),
        F.col("ts").cast("date").alias("avaliacaodata"),
        F.least(F.lit(5), (F.floor(F.col("value") / 100) + 1).cast("int")).alias("nota"),
        F.col("user_id").alias("usuarioid"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("filmeid"),
    )


def operational(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        f.__name__: f(spark, folder)
        for f in (usuario, filme, filme_generofilme, produtora, filmpagtoroy, usrpagto, avaliacao)
    }


def title_basics(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as titles; numbers are text with the missing marker and one bad value."""
    size = F.col("p_size")
    return table(spark, folder, "part").select(
        F.concat(F.lit("tt"), F.col("p_partkey").cast("string")).alias("tconst"),
        F.when(F.col("p_type") == "PROMO", "short").otherwise("movie").alias("titleType"),
        F.col("p_name").alias("primaryTitle"),
        F.col("p_name").alias("originalTitle"),
        F.lit("0").alias("isAdult"),
        F.when(size == 7, "\\N").otherwise((F.lit(1880) + F.col("p_partkey") % 140).cast("string")).alias("startYear"),
        F.lit("\\N").alias("endYear"),
        F.when(size == 13, "\\N").when(size == 14, "12d").otherwise(size.cast("string")).alias("runtimeMinutes"),
        F.when(size != 50, F.concat_ws(",", "p_type", "p_brand")).alias("genres"),
    )


def title_ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    units = F.sum("l_quantity").cast("bigint")
    tenths = F.lit(10) + F.expr("cast(sum(l_quantity) as bigint) * 90 div (50 * count(1))")
    return lines.groupBy("l_partkey").agg(tenths.alias("tenths"), units.alias("units")).select(
        F.concat(F.lit("tt"), F.col("l_partkey").cast("string")).alias("tconst"),
        (F.col("tenths").cast("double") / 10).alias("averageRating"),
        (2 * F.col("units")).alias("numVotes"),
    )


def landing_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All seven catalogue files as text, from tables of similar shape."""

    def text(frame: DataFrame, **columns) -> DataFrame:
        return frame.select(*[F.coalesce(c.cast("string"), F.lit("\\N")).alias(n) for n, c in columns.items()])

    def code(prefix: str, c: str):
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    none = F.lit(None)
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    return {
        "title-akas": text(
            orders, titleId=code("tt", "o_custkey"), ordering=F.col("o_orderkey"), title=F.col("o_orderpriority"),
            region=F.col("o_orderstatus"), language=none, types=none, attributes=none, isOriginalTitle=F.lit(0),
        ),
        "title-basics": title_basics(spark, folder),
        "title-crew": text(
            table(spark, folder, "supplier"), tconst=code("tt", "s_suppkey"), directors=code("nm", "s_nationkey"),
            writers=none,
        ),
        "title-episode": text(
            lines, tconst=code("tt", "l_orderkey"), parentTconst=code("tt", "l_partkey"),
            seasonNumber=F.col("l_linenumber"), episodeNumber=F.nullif(F.col("l_quantity").cast("int"), F.lit(1)),
        ),
        "title-principals": text(
            lines, tconst=code("tt", "l_orderkey"), ordering=F.col("l_linenumber"), nconst=code("nm", "l_suppkey"),
            category=F.col("l_returnflag"), job=none, characters=F.col("l_linestatus"),
        ),
        "title-ratings": title_ratings(spark, folder),
        "name-basics": text(
            table(spark, folder, "customer"), nconst=code("nm", "c_custkey"), primaryName=F.col("c_name"),
            birthYear=F.lit(1950) + F.col("c_nationkey"), deathYear=none, primaryProfession=F.col("c_mktsegment"),
            knownForTitles=none,
        ),
    }
