"""Every registered query with its SQL counterpart, where SQL can express it."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill import schemas
from starmill.functions import (
    clip, coerce_numeric, date_parts, first_token, ordered_pair, strip_ws, to_numeric, weekday_text,
)
from starmill.operators import checkstate, dims, facts, generate, mutate, profile, quality, relational
from starmill.operators.joins import lookup_join
from starmill.operators.keys import dense_key, ensure_unknown_member, next_key
from starmill.operators.registry import register as register_keys
from starmill.plans import incremental
from starmill.plans import warehouse as load
from starmill.plans.rollup import roll_up_addresses, user_addresses
from starmill.recommend import catalog, features, forest, model
from starmill.sources import bucketed, landing, names, publish, readers, staging, writers
from workload import standins as src
from workload.sql import RUN_DATE, query

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = query(sql)
        return fn

    return add


# --- pieces several queries share ------------------------------------------------


def _users(spark, d):
    return load.load_users(src.usuario(spark, d))


def _addresses(spark, d):
    return load.load_addresses(src.usuario(spark, d))


def _calendar(spark, d):
    bounds = [(src.avaliacao(spark, d), "avaliacaodata"), (src.usrpagto(spark, d), "datapagto")]
    return dims.calendar(bounds, RUN_DATE)


def _films(spark, d):
    return load.load_films(src.filme(spark, d), src.filme_generofilme(spark, d))


def _revenue(spark, d):
    (_, user_map), addresses, cal = staging.together(
        lambda: _users(spark, d),
        lambda: _addresses(spark, d),
        lambda: staging.stage(_calendar(spark, d), "calendar"),
    )
    users = load.user_keys_of(src.usuario(spark, d), user_map, addresses)
    return facts.load_revenue(src.usrpagto(spark, d), users, cal), addresses


def _ratings(spark, d):
    (_, user_map), film_map, (producers, producer_map), payer, cal = staging.together(
        lambda: _users(spark, d),
        lambda: dims.from_entity(src.filme(spark, d).select("filmeid"), "filmeid", "filmesk"),
        lambda: load.load_producers(src.produtora(spark, d)),
        lambda: staging.stage(facts.latest_payer(src.filmpagtoroy(spark, d)), "payer"),
        lambda: staging.stage(_calendar(spark, d), "calendar"),
    )
    films = load.film_keys_of(film_map, payer, producers, producer_map)
    return facts.load_rating(src.avaliacao(spark, d), user_map, films, cal)


def _movies(spark, d):
    return catalog.extract_movies(src.title_basics(spark, d), src.title_ratings(spark, d), in_order=False)


def _candidates(spark, d):
    return staging.stage(catalog.prepare_candidates(_movies(spark, d)), "candidates")


def _states(spark, d):
    """Regions, where customers live, and nations, which no address has for its state."""
    regions = src.table(spark, d, "region").select(F.col("r_name").alias("estado"))
    return regions.union(src.table(spark, d, "nation").select("n_name")).distinct()


def _model_infer(spark, d):
    pairs = model.pair_states(_states(spark, d), _candidates(spark, d))
    points = (
        F.col("imdbnumvotos").cast("bigint") + 31 * F.length("estado") + 7 * F.col("duracaomin").cast("bigint")
    ) % 60
    return model.rank_predictions(model.score_with(pairs, points.cast("double") / 10))


# --- dimensions and keys ----------------------------------------------------------


@register("SELECT * FROM d_usuario")
def dim_user_key(spark, d):
    return dims.from_distinct(src.usuario(spark, d), load.USER_KEY, "usuariosk")


@register("SELECT * FROM d_endereco")
def dim_address_key(spark, d):
    return _addresses(spark, d)


@register("SELECT * FROM m_usuario")
def user_key_map(spark, d):
    return _users(spark, d)[1]


@register("SELECT usuarioid, enderecosk FROM m_local")
def address_key_map(spark, d):
    users = src.usuario(spark, d)
    return dims.key_map(users, _addresses(spark, d), load.ADDRESS_KEY, "usuarioid", "enderecosk")


@register("SELECT * FROM d_filme")
def dim_film_bridge_min(spark, d):
    return _films(spark, d)[0]


@register("SELECT * FROM d_produtora")
def dim_producer_unknown(spark, d):
    return load.load_producers(src.produtora(spark, d))[0]


@register("SELECT produtoraid AS produtorask, produtoranome FROM produtora")
def dim_producer_known(spark, d):
    """The label is already there, so nothing is appended."""
    dim = src.produtora(spark, d).withColumnRenamed("produtoraid", "produtorask")
    return ensure_unknown_member(dim, "produtorask", "produtoranome", "Supplier#000000000")


@register("""
    SELECT l_orderkey, l_partkey, l_suppkey, row_number() OVER (
        ORDER BY l_orderkey DESC, l_partkey, l_suppkey) AS line_key
    FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem)""")
def dense_key_lines(spark, d):
    """Sequential key over a large composite natural key, one part descending."""
    lines = src.table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey").distinct()
    return dense_key(lines, [F.desc("l_orderkey"), "l_partkey", "l_suppkey"], "line_key")


@register("""
    SELECT o_orderstatus, count(*) AS n_rows, (SELECT max(o_orderkey) + 1 FROM orders) AS next_order
    FROM orders GROUP BY o_orderstatus""")
def next_free_key(spark, d):
    orders = src.table(spark, d, "orders")
    return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")).select(
        "*", next_key(orders, "o_orderkey").alias("next_order")
    )


@register("SELECT * FROM d_calendario")
def dim_calendar(spark, d):
    return _calendar(spark, d)


CALENDAR_TODAY = f"""
    SELECT * FROM d_calendario
    UNION ALL
    SELECT (SELECT max(calendariosk) + 1 FROM d_calendario), t, %s, CAST(extract(day FROM t) AS INTEGER),
           CAST(extract(month FROM t) AS INTEGER), CAST(extract(quarter FROM t) AS INTEGER),
           CAST(extract(year FROM t) AS INTEGER)
    FROM (SELECT DATE '{RUN_DATE}' AS t) WHERE NOT EXISTS (SELECT 1 FROM d_calendario WHERE datacompleta = t)"""


@register(CALENDAR_TODAY % "strftime(t, '%a')")
def calendar_ensure_day(spark, d):
    return dims.ensure_day(_calendar(spark, d), RUN_DATE)


@register(CALENDAR_TODAY % "rpad(strftime(t, '%A'), 9, ' ')")
def calendar_ensure_day_padded(spark, d):
    """The appended day with the padded full weekday name."""
    return dims.ensure_day(_calendar(spark, d), RUN_DATE, weekday_style="padded")


@register("SELECT * FROM d_calendario")
def calendar_day_present(spark, d):
    """The run date is already there, so nothing is appended."""
    return dims.ensure_day(_calendar(spark, d), F.lit("1998-01-01"))


# --- facts ------------------------------------------------------------------------


@register("""
    SELECT filmeid, produtoraid FROM (
        SELECT filmeid, produtoraid,
               row_number() OVER (PARTITION BY filmeid ORDER BY datapagto DESC, produtoraid) AS n
        FROM filmpagtoroy) WHERE n = 1""")
def latest_payer(spark, d):
    return facts.latest_payer(src.filmpagtoroy(spark, d))


@register("SELECT * FROM f_avaliacao")
def fact_rating(spark, d):
    return _ratings(spark, d)


@register("SELECT * FROM f_receita")
def fact_revenue(spark, d):
    return _revenue(spark, d)[0]


def _prediction_fact(spark, d):
    cal = staging.stage(dims.ensure_day(_calendar(spark, d), RUN_DATE), "calendar")
    states = mutate.shrink_dimension(_addresses(spark, d), "estado", "enderecosk")
    states = staging.stage(states, "states")
    return facts.load_prediction(_model_infer(spark, d), states, cal, RUN_DATE, on_unmatched="reject")


PREDICTION_FACT = """
    SELECT "FilmeIMDbSK" AS filmeimdbsk, "FilmeNome" AS filmenome, CAST("AnoDeLancamento" AS INTEGER) AS anodelancamento,
           CAST("DuracaoMin" AS INTEGER) AS duracaomin, "GeneroNome" AS generonome, "IMDbAvaliacao" AS imdbavaliacao,
           "IMDbNumVotos" AS imdbnumvotos, "PredicaoModelo" AS predicaomodelo, e.enderecosk,
           (SELECT max(calendariosk) + 1 FROM d_calendario) AS calendariosk
    FROM model_infer LEFT JOIN d_estado e ON e.estado = model_infer."Estado"
    WHERE e.enderecosk IS %s NULL"""


@register(PREDICTION_FACT % "NOT")
def prediction_fact(spark, d):
    return _prediction_fact(spark, d)[0]


@register(PREDICTION_FACT % "")
def prediction_rejects(spark, d):
    return _prediction_fact(spark, d)[1]


# --- update, delete, roll-up ---------------------------------------------------------


@register("""
    SELECT o_orderkey, o_custkey,
           CASE WHEN c_custkey IS NULL THEN o_totalprice WHEN c_acctbal >= 0 THEN c_acctbal END AS o_totalprice
    FROM orders LEFT JOIN customer ON c_custkey * 2 = o_custkey""")
def update_from_match(spark, d):
    """Matched rows take the new value, even a null one; the others (odd keys) keep theirs."""
    orders = src.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    balances = src.table(spark, d, "customer").select(
        (F.col("c_custkey") * 2).alias("c_custkey"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance")
    )
    return mutate.update_from(orders, balances, {"o_custkey": "c_custkey"}, {"o_totalprice": "balance"})


@register("""
    SELECT * FROM part a WHERE NOT EXISTS (
        SELECT 1 FROM (SELECT p_brand, min(p_partkey) AS keep FROM part GROUP BY p_brand) b
        WHERE b.p_brand = a.p_brand AND a.p_partkey <> b.keep)""")
def delete_using_group_min(spark, d):
    part = src.table(spark, d, "part")
    kept = mutate.group_representative(part, "p_brand", "p_partkey")
    return mutate.delete_using(part, kept, ["p_brand"], lambda t, s: t["p_partkey"] != s["_s_keep"])


@register("SELECT * FROM m_endereco")
def rollup_map(spark, d):
    return mutate.rollup_map(_addresses(spark, d), "estado", "enderecosk")


@register("""
    SELECT r.receitask, r.valorpago, r.usuariosk, r.calendariosk, m.enderecosk_new AS enderecosk
    FROM f_receita r JOIN m_endereco m ON m.enderecosk_original = r.enderecosk""")
def rollup_revenue(spark, d):
    revenue, addresses = _revenue(spark, d)
    to_state = staging.stage(mutate.rollup_map(addresses, "estado", "enderecosk"), "rollup-map")
    return mutate.update_from(
        revenue, to_state, {"enderecosk": "enderecosk_original"}, {"enderecosk": "enderecosk_new"}
    )


@register("SELECT * FROM d_estado")
def rollup_shrink(spark, d):
    return mutate.shrink_dimension(_addresses(spark, d), "estado", "enderecosk")


def _rolled_ratings(spark, d, user_key):
    source = src.operational(spark, d)
    warehouse = load.init_load(source, RUN_DATE)
    return roll_up_addresses(warehouse, source["usuario"], warehouse["user_map"], user_key)["avaliacao"]


@register("""
    SELECT a.*, m.enderecosk_new AS enderecosk FROM f_avaliacao a
    LEFT JOIN u_endereco u ON u.usuariosk = a.usuariosk
    LEFT JOIN m_endereco m ON m.enderecosk_original = u.enderecosk""")
def rollup_rating(spark, d):
    """Warehouse load and roll-up end to end: ratings with the state address of their user."""
    return _rolled_ratings(spark, d, "mapped")


POSITIONAL = "(SELECT usuarioid AS usuariosk, enderecosk FROM m_local)"


@register(f"""
    SELECT a.*, m.enderecosk_new AS enderecosk FROM f_avaliacao a
    LEFT JOIN {POSITIONAL} u ON u.usuariosk = a.usuariosk
    LEFT JOIN m_endereco m ON m.enderecosk_original = u.enderecosk""")
def rollup_rating_positional(spark, d):
    """The same with the operational id taken for the warehouse key."""
    return _rolled_ratings(spark, d, "positional")


@register(f"""
    SELECT d.usuariosk, d.email, d.telefone, u.enderecosk
    FROM d_usuario d LEFT JOIN {POSITIONAL} u ON u.usuariosk = d.usuariosk""")
def user_positional_address(spark, d):
    dim, user_map = _users(spark, d)
    found = user_addresses(src.usuario(spark, d), _addresses(spark, d), user_map, "positional")
    return mutate.update_from(dim, found, {"usuariosk": "usuariosk"}, {"enderecosk": "enderecosk"})


# --- grouped picks and sorts -------------------------------------------------------------


@register("""
    SELECT user_id, event_type FROM (
        SELECT user_id, event_type,
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS n
        FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type) WHERE n = 1""")
def mode_by_user(spark, d):
    return relational.mode_by(src.table(spark, d, "events"), ["user_id"], "event_type")


@register("""
    SELECT * FROM (
        SELECT p_partkey, p_name, p_brand, p_retailprice,
               CAST(row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS pos
        FROM part) WHERE pos <= 25""")
def top_k_per_group(spark, d):
    part = src.table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    order = [F.desc("p_retailprice"), F.asc("p_partkey")]
    return relational.top_k_per_group(part, ["p_brand"], order, 25, rank="pos")


@register("""
    SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_orderdate, o_totalprice
    FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey""")
def distinct_on_customer(spark, d):
    orders = src.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return relational.distinct_on(orders, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")])


@register("""
    SELECT DISTINCT ON (l_orderkey, l_linenumber) * FROM lineitem
    ORDER BY l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount,
             l_tax, l_returnflag, l_linestatus""")
def drop_duplicate_lines(spark, d):
    """Whole rows, one per key, the first in a total order."""
    lines = src.table(spark, d, "lineitem")
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
    return relational.distinct_on(lines, ["l_orderkey", "l_linenumber"], [F.asc(c) for c in order])


@register("""
    SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
    ORDER BY o_totalprice DESC, o_orderdate DESC, o_orderkey LIMIT 400""")
def top_n_orders(spark, d):
    orders = src.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return relational.top_n(orders, [F.desc("o_totalprice"), F.desc("o_orderdate"), F.asc("o_orderkey")], 400)


@register("SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def sorted_values(spark, d):
    return relational.sorted_values(src.table(spark, d, "orders"), "o_orderpriority")


@register("SELECT l_partkey, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_partkey")
def min_by_part(spark, d):
    return relational.min_by_key(src.table(spark, d, "lineitem"), ["l_partkey"], "l_shipdate")


# --- scalar functions and filters -----------------------------------------------------------


@register(r"""
    SELECT tconst, TRY_CAST(startyear AS DOUBLE) AS startyear, TRY_CAST(endyear AS DOUBLE) AS endyear,
           TRY_CAST(runtimeminutes AS DOUBLE) AS runtimeminutes FROM title_basics""")
def coerce_catalogue_numbers(spark, d):
    basics = names.lower_columns(src.title_basics(spark, d))
    columns = ["startyear", "endyear", "runtimeminutes"]
    return coerce_numeric(basics, columns).select("tconst", *columns)


@register("""
    SELECT doc_id, CASE WHEN regexp_full_match(text, '\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*')
                        THEN TRY_CAST(trim(text) AS DOUBLE) END AS number
    FROM documents""")
def coerce_free_text(spark, d):
    """Whole documents: nearly none is a number, and none may raise."""
    return src.table(spark, d, "documents").select("doc_id", to_numeric("text").alias("number"))


@register("""
    SELECT tconst, coalesce(split_part(genres, ',', 1), 'desconhecido') AS genre FROM title_basics""")
def first_token_genre(spark, d):
    return src.title_basics(spark, d).select("tconst", first_token("genres").alias("genre"))


@register(r"""
    SELECT doc_id, regexp_replace(regexp_replace(split_part(text, ',', 1), '^\s+', ''), '\s+$', '') AS head
    FROM documents""")
def first_token_text(spark, d):
    """First comma-separated part of whole documents, stripped."""
    return src.table(spark, d, "documents").select("doc_id", first_token("text").alias("head"))


@register("""
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%a') AS diasemana,
           CAST(extract(day FROM o_orderdate) AS INTEGER) AS dia, CAST(extract(month FROM o_orderdate) AS INTEGER) AS mes,
           CAST(extract(quarter FROM o_orderdate) AS INTEGER) AS trimestre,
           CAST(extract(year FROM o_orderdate) AS INTEGER) AS ano,
           rpad(strftime(CAST(o_orderdate AS DATE), '%A'), 9, ' ') AS diacompleto
    FROM orders""")
def date_attributes(spark, d):
    day = F.col("o_orderdate").cast("date")
    return src.table(spark, d, "orders").select(
        "o_orderkey", *date_parts(day), weekday_text(day, "padded").alias("diacompleto")
    )


@register("""
    SELECT event_id, least(5.0, greatest(1.0, value / 20)) AS rating, least(value, user_id) AS lo,
           greatest(value, user_id) AS hi, round(value, 1) AS tenth
    FROM (SELECT event_id, value, CAST(user_id AS DOUBLE) AS user_id FROM events)""")
def clip_and_order(spark, d):
    lo, hi = ordered_pair(F.col("value"), F.col("user_id").cast("double"))
    return src.table(spark, d, "events").select(
        "event_id", clip(F.col("value") / 20, 1.0, 5.0).alias("rating"), lo.alias("lo"), hi.alias("hi"),
        F.round("value", 1).alias("tenth"),
    )


@register("""
    SELECT tconst, averagerating, numvotes FROM title_ratings WHERE averagerating >= 6.2 AND numvotes >= 500""")
def threshold_filter(spark, d):
    ratings = names.lower_columns(src.title_ratings(spark, d))
    return ratings.filter((F.col("averagerating") >= 6.2) & (F.col("numvotes") >= 500))


@register(r"""
    SELECT tconst, CAST(startyear AS DOUBLE) AS startyear, CAST(runtimeminutes AS DOUBLE) AS runtimeminutes
    FROM title_basics WHERE TRY_CAST(startyear AS DOUBLE) IS NOT NULL AND TRY_CAST(runtimeminutes AS DOUBLE) IS NOT NULL""")
def drop_null_rows(spark, d):
    columns = ["startyear", "runtimeminutes"]
    basics = coerce_numeric(names.lower_columns(src.title_basics(spark, d)), columns)
    return relational.drop_nulls(basics, columns).select("tconst", *columns)


@register("""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, n_nationkey, n_name, n_regionkey
    FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def repeated_columns(spark, d):
    """A select-all join whose key name occurs twice; the first copy is kept."""
    customer, nation = src.table(spark, d, "customer"), src.table(spark, d, "nation")
    doubled = nation.withColumn("c_nationkey", F.col("n_nationkey"))
    joined = customer.join(doubled, customer["c_nationkey"] == doubled["c_nationkey"])
    return names.drop_repeated_columns(joined)


@register("""
    SELECT c_custkey, trim(c_name) AS c_name, lower(c_mktsegment) AS segment FROM customer""")
def lower_and_strip(spark, d):
    padded = src.table(spark, d, "customer").select(
        F.col("c_custkey").alias("C_CUSTKEY"),
        F.concat(F.lit(" \t"), "c_name", F.lit("\n ")).alias("C_Name"),
        F.lower("c_mktsegment").alias("SEGMENT"),
    )
    return names.lower_columns(padded).withColumn("c_name", strip_ws("c_name"))


# --- profiles and constraint checks -------------------------------------------------------


STATS = """
    SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
           round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75,
           CAST(max({c}) AS DOUBLE) AS max
    FROM {t}"""


def _rounded(stats):
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@register(" UNION ALL ".join(
    STATS.format(c=c, t="lineitem") for c in ("l_extendedprice", "l_quantity", "l_tax")))
def describe_lines(spark, d):
    lines = src.table(spark, d, "lineitem")
    return _rounded(profile.describe_exact(lines, ["l_extendedprice", "l_quantity", "l_tax"]))


@register(" UNION ALL ".join(STATS.format(c=c, t="title_ratings") for c in ("averagerating", "numvotes")))
def describe_ratings(spark, d):
    ratings = staging.stage(names.lower_columns(src.title_ratings(spark, d)), "ratings")
    return _rounded(profile.describe_exact(ratings, ["averagerating", "numvotes"]))


PROFILED = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
            "embeddings", "pages", "benchmark", "labels", "conversations"]


@register(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER)"
    f" AS n_columns FROM {t}" for t in PROFILED))
def profile_tables(spark, d):
    return profile.profile_tables({t: src.table(spark, d, t) for t in PROFILED})


@register(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, least(5, count(*)) AS n_rows FROM {t}" for t in PROFILED))
def first_rows(spark, d):
    """The first five rows of each table, as counts, since which rows come first is open."""
    heads = {t: profile.first_rows(src.table(spark, d, t)) for t in PROFILED}
    return profile.profile_tables(heads).drop("n_columns")


@register("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark, d):
    return quality.check_unique(src.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_nulls FROM title_basics" for c in ("tconst", "genres")))
def check_not_null(spark, d):
    return quality.check_not_null(src.title_basics(spark, d), ["tconst", "genres"])


@register("""
    SELECT o_custkey, count(*) AS n_rows FROM orders
    WHERE o_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL) GROUP BY o_custkey""")
def check_fk(spark, d):
    """Orders whose customer has no event; the parent side repeats its keys."""
    return quality.check_fk(src.table(spark, d, "orders"), "o_custkey", src.table(spark, d, "events"), "user_id")


@register("""
    SELECT 'text' AS column_name, CAST(count(*) FILTER (length(text) > 255) AS BIGINT) AS n_long FROM documents
    UNION ALL
    SELECT 'lang', CAST(count(*) FILTER (length(lang) > 9) AS BIGINT) FROM documents""")
def check_length(spark, d):
    return quality.check_length(src.table(spark, d, "documents"), {"text": 255, "lang": 9})


@register(r"""
    SELECT 'startYear' AS column_name, count(*) FILTER (startyear = '\N') AS n_bad FROM title_basics
    UNION ALL
    SELECT 'runtimeMinutes', count(*) FILTER (runtimeminutes IN ('\N', '12d')) FROM title_basics""")
def check_coercion(spark, d):
    return quality.check_coercion(src.title_basics(spark, d), ["startYear", "runtimeMinutes"])


REVENUE_CHECKS = """
    SELECT 'unique' AS check_name, 'receitask' AS column_name,
           (SELECT count(*) FROM (SELECT receitask FROM f_receita GROUP BY 1 HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'not_null', 'receitask', (SELECT count(*) - count(receitask) FROM f_receita)
    UNION ALL SELECT 'not_null', 'valorpago', (SELECT count(*) - count(valorpago) FROM f_receita)
    UNION ALL SELECT 'not_null', 'usuariosk', (SELECT count(*) - count(usuariosk) FROM f_receita)
    UNION ALL SELECT 'not_null', 'calendariosk', (SELECT count(*) - count(calendariosk) FROM f_receita)
    UNION ALL SELECT 'not_null', 'enderecosk', (SELECT count(*) - count(enderecosk) FROM f_receita)
    UNION ALL SELECT 'reference', 'enderecosk',
        (SELECT count(DISTINCT enderecosk) FROM f_receita WHERE enderecosk NOT IN (SELECT enderecosk FROM d_estado))
    UNION ALL SELECT 'reference', 'usuariosk',
        (SELECT count(DISTINCT usuariosk) FROM f_receita WHERE usuariosk NOT IN (SELECT usuariosk FROM d_usuario))
    UNION ALL SELECT 'reference', 'calendariosk',
        (SELECT count(DISTINCT calendariosk) FROM f_receita
         WHERE calendariosk NOT IN (SELECT calendariosk FROM d_calendario))"""


@register(REVENUE_CHECKS)
def check_revenue_table(spark, d):
    """All declared checks of the revenue fact, against the shrunk address table."""
    revenue, addresses = _revenue(spark, d)
    states = mutate.shrink_dimension(addresses, "estado", "enderecosk")
    revenue = staging.stage(revenue, "revenue")
    parents = {
        "endereco": (states, "enderecosk"), "usuario": (_users(spark, d)[0], "usuariosk"),
        "calendario": (_calendar(spark, d), "calendariosk"),
    }
    return quality.check_table(revenue, schemas.WAREHOUSE["receita"], parents)


# --- catalogue and recommender ---------------------------------------------------------------


@register("SELECT * FROM movies")
def catalogue_extract(spark, d):
    return catalog.extract_movies(src.title_basics(spark, d), src.title_ratings(spark, d))


@register("""
    SELECT b.tconst, titletype, primarytitle, originaltitle, TRY_CAST(isadult AS DOUBLE) AS isadult,
           TRY_CAST(startyear AS DOUBLE) AS startyear, TRY_CAST(endyear AS DOUBLE) AS endyear,
           TRY_CAST(runtimeminutes AS DOUBLE) AS runtimeminutes, genres, averagerating,
           CAST(numvotes AS DOUBLE) AS numvotes
    FROM title_basics b JOIN title_ratings r ON r.tconst = b.tconst WHERE titletype = 'movie'""")
def catalogue_join(spark, d):
    return catalog.movie_ratings(src.title_basics(spark, d), src.title_ratings(spark, d))


@register("SELECT * FROM candidates")
def candidates_top_n(spark, d):
    return catalog.prepare_candidates(_movies(spark, d))


@register("SELECT * FROM user_state")
def user_home_state(spark, d):
    revenue, addresses = _revenue(spark, d)
    return features.user_state(revenue, addresses)


def _training(spark, d):
    warehouse = load.init_load(src.operational(spark, d), RUN_DATE)
    states = staging.stage(features.user_state(warehouse["receita"], warehouse["endereco"]), "user-state")
    return features.training_set(warehouse["avaliacao"], warehouse["filme"], states)


@register("SELECT * FROM training")
def training_set(spark, d):
    return _training(spark, d)


@register("SELECT * FROM model_infer")
def cross_score_topk(spark, d):
    """Every state with every candidate under a fixed score, best 25 per state, numbered through."""
    return _model_infer(spark, d)


def recommendations(spark, d, **options):
    training, candidates = staging.together(
        lambda: staging.stage(_training(spark, d), "training"), lambda: _candidates(spark, d)
    )
    return model.recommend(training, candidates, features.known_states(training), **options)


@register()
def recommend_model(spark, d):
    """The forest trained on all ratings, then every state and candidate scored and ranked."""
    return recommendations(spark, d)


# --- fixtures at scale -----------------------------------------------------------------------


PAIR_SEED = -5


def _permuted_sql(source: str) -> str:
    """SQL of ``generate.permute`` over ``spot`` of the source, with ``width`` and ``height`` as columns."""
    rows = f"SELECT *, spot // height AS q, spot % height AS r FROM {source}"
    for k in range(generate.ROUNDS):
        own, other, size = ("q", "r", "width") if k % 2 == 0 else ("r", "q", "height")
        shift = f"CAST('0x' || md5('{PAIR_SEED}:{k}:' || {other})[1:15] AS BIGINT)"
        rows = f"SELECT * REPLACE (({own} + {shift} % {size}) % {size} AS {own}) FROM ({rows})"
    return f"SELECT pair_id, q * height + r AS spot, pool, n_right, width, height FROM ({rows})"


@register(f"""
    WITH RECURSIVE l AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer),
         r AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS j FROM part),
         size AS (SELECT (SELECT count(*) FROM customer) * (SELECT count(*) FROM part) AS pool,
                         (SELECT count(*) FROM part) AS n_right),
         side AS (SELECT *, CAST(ceil(sqrt(pool)) AS BIGINT) AS height FROM size),
         square AS (SELECT *, (pool + height - 1) // height AS width FROM side),
         first AS (SELECT i AS pair_id, i AS spot, pool, n_right, width, height
                   FROM square, range(0, (SELECT count(*) FROM events)) t(i)),
         walk AS ({_permuted_sql("first")}
                  UNION ALL {_permuted_sql("(SELECT * FROM walk WHERE spot >= pool)")})
    SELECT pair_id, c_custkey, p_partkey FROM walk JOIN l ON l.i = spot // n_right JOIN r ON r.j = spot % n_right
    WHERE spot < pool""")
def sample_pairs(spark, d):
    """As many distinct customer and part pairs as there are events."""
    customer, part = src.table(spark, d, "customer"), src.table(spark, d, "part")
    n = src.table(spark, d, "events").count()
    return generate.sample_pairs(customer, part, "c_custkey", "p_partkey", n, seed=PAIR_SEED)


@register("""
    SELECT count(*) // 5 AS n_rows, count(*) // 5 AS n_ids, 0 AS n_unknown FROM part""")
def pick_subset(spark, d):
    """A fifth of the parents by seeded hash, as counts: rows, distinct ids, ids that are no parent."""
    part = src.table(spark, d, "part")
    picked = staging.stage(
        generate.bridge(part, "p_partkey", part.count() // 5, F.lit("x"), "value", seed=3), "picked"
    )
    known = lookup_join(picked, part.select("p_partkey", F.lit(1).alias("known")), "p_partkey", "left")
    return known.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("p_partkey").alias("n_ids"),
        F.count_if(F.col("known").isNull()).cast("int").alias("n_unknown"),
    )


@register("""
    SELECT count(*) AS n_rows, count(*) AS n_int, count(*) AS n_date, count(*) AS n_amount, count(*) AS n_key,
           CAST(5 AS BIGINT) AS grades
    FROM orders""")
def uniform_values(spark, d):
    """Seeded grades, dates, amounts and keys for every order; counts of those within range."""
    i = F.col("o_orderkey")
    made = src.table(spark, d, "orders").select(
        generate.uniform_int(i, 1, 5, 1).alias("grade"),
        generate.uniform_date(i, "2023-01-01", "2025-12-31", 2).alias("day"),
        generate.uniform_amount(i, 1.0, 100.0, 3).alias("amount"),
        generate.pick_key(i, 1500, 4).alias("key"),
    )
    return made.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("grade").between(1, 5)).alias("n_int"),
        F.count_if(F.col("day").between(F.lit("2023-01-01").cast("date"), F.lit("2025-12-31").cast("date"))).alias("n_date"),
        F.count_if(F.col("amount").between(1.0, 100.0)).alias("n_amount"),
        F.count_if(F.col("key").between(1, 1500)).alias("n_key"),
        F.countDistinct("grade").alias("grades"),
    )


# --- sources and sinks ----------------------------------------------------------------------


@register("SELECT * FROM customer")
def read_csv(spark, d):
    customer = src.table(spark, d, "customer")
    path = staging.staged_path(spark, "csv")
    customer.write.option("header", True).csv(path)
    return readers.read_delimited(spark, path, customer.schema)


@register("SELECT s_suppkey, s_name || ', Ltd; ' AS s_name, s_nationkey, s_acctbal FROM supplier")
def read_semicolon_csv(spark, d):
    """Values hold the separator, commas and a trailing blank."""
    supplier = src.table(spark, d, "supplier").withColumn("s_name", F.concat("s_name", F.lit(", Ltd; ")))
    path = staging.staged_path(spark, "semicolon")
    supplier.write.options(header=True, sep=";", ignoreTrailingWhiteSpace=False).csv(path)
    return readers.read_delimited(spark, path, supplier.schema, sep=";")


@register(r"""
    SELECT tconst, titletype AS "titleType", primarytitle AS "primaryTitle", originaltitle AS "originalTitle",
           TRY_CAST(isadult AS BIGINT) AS "isAdult", TRY_CAST(startyear AS BIGINT) AS "startYear",
           TRY_CAST(endyear AS BIGINT) AS "endYear", TRY_CAST(runtimeminutes AS BIGINT) AS "runtimeMinutes",
           coalesce(genres, '\N') AS genres
    FROM title_basics""")
def ingest_landing(spark, d):
    """Tab-separated landing file to the typed table; text keeps its null marker."""
    raw, target = staging.staged_path(spark, "landing"), staging.staged_path(spark, "brute")
    src.title_basics(spark, d).write.options(header=True, sep="\t", nullValue="\\N", quote="").csv(raw)
    tables = landing.ingest_landing(spark, {"title-basics": raw}, schemas.CATALOGUE, target)
    return tables["title-basics"]


@register("SELECT * FROM supplier")
def table_roundtrip(spark, d):
    """Replace-write a catalogue table from mixed-case columns and read it back in lower case."""
    supplier = src.table(spark, d, "supplier")
    mixed = supplier.toDF(*[c.upper() for c in supplier.columns])
    where = staging.staged_path(spark, "tables")
    writers.write_table(mixed, schema="starmill_probe", table_name="fornecedor", location=where)
    return readers.read_table(spark, "fornecedor", "starmill_probe")


@register("SELECT * FROM d_produtora")
def export_tables(spark, d):
    """Catalogue table to a folder of text files, read back."""
    dim = load.load_producers(src.produtora(spark, d))[0]
    where = staging.staged_path(spark, "tables")
    writers.write_table(dim, schema="starmill_probe", table_name="produtora", location=where)
    folder = staging.staged_path(spark, "export")
    written = writers.export_tables(spark, "starmill_probe", ["Produtora"], folder)
    return readers.read_delimited(spark, written["Produtora"], dim.schema)


@register("SELECT * FROM d_usuario")
def publish_users(spark, d):
    """Write, check and publish the user dimension, then read the catalogue table."""
    dim = dims.from_distinct(src.usuario(spark, d), load.USER_KEY, "usuariosk")
    root = staging.staged_path(spark, "publish")
    tables = {"usuario": schemas.WAREHOUSE["usuario"]}
    publish.publish(spark, {"usuario": dim}, root, tables, schema="starmill_publish")
    return spark.table("starmill_publish.usuario")


@register("""
    SELECT b.tconst, b.primarytitle, r.numvotes FROM title_basics b JOIN title_ratings r ON r.tconst = b.tconst
    WHERE b.titletype = 'movie'""")
def lake_sql(spark, d):
    return readers.query_lake(
        spark,
        "select b.tconst, b.primarytitle, r.numvotes from {b} b join {r} r on r.tconst = b.tconst"
        " where b.titletype = 'movie'",
        b=names.lower_columns(src.title_basics(spark, d)),
        r=names.lower_columns(src.title_ratings(spark, d)),
    )


@register("""
    SELECT *, (SELECT count(*) FROM events) AS n_rows
    FROM (VALUES ('ts', 'missing', 'date', NULL), ('event_id', 'retyped', 'int', 'bigint'),
        ('value', 'added', NULL, 'double')) t(column_name, change, declared, found)""")
def schema_drift(spark, d):
    """The events as written, against a declaration that differs in three places; with their row count."""
    path = staging.staged_path(spark, "drift")
    src.table(spark, d, "events").select("event_id", "user_id", "value").write.parquet(path)
    declared = schemas.Table(
        (schemas.Column("event_id", "int"), schemas.Column("user_id", "long"), schemas.Column("ts", "date"))
    )
    frame, drift = landing.refresh_schema(spark, path, declared)
    n_rows = frame.select(F.count(F.lit(1))).scalar()
    return drift.withColumnRenamed("column", "column_name").withColumn("n_rows", n_rows)


@register("""
    SELECT 'title-akas' AS table_name, count(*) AS n_rows, 8 AS n_columns, CAST(NULL AS VARCHAR) AS checked,
           CAST(NULL AS BIGINT) AS missing FROM orders
    UNION ALL SELECT 'title-basics', count(*), 9, 'startYear', count(*) FILTER (p_size = 7) FROM part
    UNION ALL SELECT 'title-crew', count(*), 3, NULL, NULL FROM supplier
    UNION ALL SELECT 'title-episode', count(*), 4, 'episodeNumber',
                     count(*) FILTER (CAST(floor(l_quantity) AS INTEGER) = 1) FROM lineitem
    UNION ALL SELECT 'title-principals', count(*), 6, NULL, NULL FROM lineitem
    UNION ALL SELECT 'title-ratings', count(DISTINCT l_partkey), 3, NULL, NULL FROM lineitem
    UNION ALL SELECT 'name-basics', count(*), 6, 'deathYear', count(*) FROM customer""")
def ingest_catalogue(spark, d):
    """All seven landing files to typed tables; rows per table, and nulls of one number column."""
    raw, target = staging.staged_path(spark, "landing"), staging.staged_path(spark, "brute")
    paths = {}
    for name, frame in src.landing_tables(spark, d).items():
        paths[name] = f"{raw}/{name}"
        frame.write.options(header=True, sep="\t", nullValue="\\N", quote="").csv(paths[name])
    tables = landing.ingest_landing(spark, paths, schemas.CATALOGUE, target)
    checked = {"title-basics": "startYear", "title-episode": "episodeNumber", "name-basics": "deathYear"}
    nulls = [
        quality.check_not_null(tables[name], [column]).select(
            F.lit(name).alias("table_name"), F.col("column_name").alias("checked"), F.col("n_nulls").alias("missing")
        )
        for name, column in checked.items()
    ]
    found = nulls[0].unionByName(nulls[1]).unionByName(nulls[2])
    return profile.profile_tables(tables).join(found, "table_name", "left")


LOADED = {
    "usuario": ("usuariosk", "email"), "filme": ("filmesk", "generonome"), "endereco": ("enderecosk", "logradouro"),
    "calendario": ("calendariosk", "diasemana"), "produtora": ("produtorask", "produtoranome"),
    "avaliacao": ("avaliacaosk", "produtorask"), "receita": ("receitask", "enderecosk"),
}


@register(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST({key} AS BIGINT) AS key, CAST({value} AS VARCHAR) AS value"
    f" FROM {'f' if name in ('avaliacao', 'receita') else 'd'}_{name}"
    for name, (key, value) in LOADED.items()
))
def warehouse_load(spark, d):
    """The whole initial load, written, constraint-checked and read back as published: every row
    of every table with its key and one more column."""
    warehouse = load.init_load(src.operational(spark, d), RUN_DATE)
    root = staging.staged_path(spark, "warehouse")
    publish.publish(spark, {n: warehouse[n] for n in schemas.WAREHOUSE}, root, schemas.WAREHOUSE)
    done = publish.published(spark, root)
    rows = [
        done[name].select(
            F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("key"), F.col(value).cast("string").alias("value")
        )
        for name, (key, value) in LOADED.items()
    ]
    return functools.reduce(lambda a, b: a.unionByName(b), rows)


@register("""
    SELECT 'avaliacao' AS table_name, 6 AS n_columns, 0 AS n_rows, (SELECT count(*) FROM supplier) AS n_kept
    UNION ALL SELECT 'produtora', 2, 0, (SELECT count(*) FROM supplier)""")
def namespace_recreate(spark, d):
    """A namespace with typed empty tables; one is filled, dropped and made anew, the copy of its
    rows in another table stays."""
    where = staging.staged_path(spark, "namespace")
    tables = {n: schemas.WAREHOUSE[n] for n in ("produtora", "avaliacao")}
    writers.drop_namespace(spark, "starmill_space")
    writers.create_namespace(spark, "starmill_space", tables, location=where)
    dim = src.produtora(spark, d).select(F.col("produtoraid").alias("produtorask"), "produtoranome")
    dim.write.insertInto("starmill_space.produtora")
    n_kept = staging.stage(spark.table("starmill_space.produtora"), "kept").count()
    writers.recreate_table(spark, "starmill_space", "produtora", tables["produtora"])
    shape = profile.profile_tables({n: spark.table(f"starmill_space.{n}") for n in tables})
    return shape.select(
        "table_name", F.col("n_columns").cast("int").alias("n_columns"), F.col("n_rows").cast("int").alias("n_rows"),
        F.lit(n_kept).cast("bigint").alias("n_kept"),
    )


@register("""
    SELECT o_orderstatus, o_orderkey, n AS place FROM (
        SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS n
        FROM (SELECT o_orderkey, o_totalprice, nullif(o_orderstatus, 'O') AS o_orderstatus FROM orders))
    WHERE n <= 1500""")
def top_1500_per_group(spark, d):
    """More rows per group than Spark cuts early, with a null group."""
    orders = src.table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.nullif("o_orderstatus", F.lit("O")).alias("o_orderstatus")
    )
    top = relational.top_k_per_group(orders, ["o_orderstatus"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 1500, "place")
    return top.select("o_orderstatus", "o_orderkey", "place")


@register("""
    WITH c AS (SELECT p_partkey, p_retailprice,
                      row_number() OVER (ORDER BY p_retailprice DESC, p_size DESC, p_partkey) - 1 AS place FROM part)
    SELECT r_name AS estado, place, CAST(p_partkey AS VARCHAR) AS filmeimdbskraw FROM region, c""")
def pair_all_candidates(spark, d):
    """Every region with every part: far more candidates than a recommendation takes."""
    regions = src.table(spark, d, "region").select(F.col("r_name").alias("estado"))
    films = src.table(spark, d, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 12, "0").alias("filmeimdbskraw"), F.col("p_retailprice").alias("imdbavaliacao"),
        F.col("p_size").alias("imdbnumvotos"),
    )
    pairs = model.pair_states(regions, films)
    return pairs.select("estado", "place", F.col("filmeimdbskraw").cast("bigint").cast("string").alias("filmeimdbskraw"))


@register("""
    SELECT 'anodelancamento' AS feature, round(avg(anodelancamento), 6) AS mean, round(stddev_samp(anodelancamento), 6) AS std
    FROM training UNION ALL
    SELECT 'duracaomin', round(avg(duracaomin), 6), round(stddev_samp(duracaomin), 6) FROM training""")
def model_scaling(spark, d):
    """Means and deviations that the model's scaler learns."""
    assemble, scale = model.build_pipeline().getStages()[:2]
    fitted = scale.fit(assemble.transform(staging.stage(_training(spark, d), "training")))
    rows = list(zip(model.K.NUMERIC_COLUMNS, fitted.mean.tolist(), fitted.std.tolist()))
    return spark.createDataFrame(rows, "feature string, mean double, std double").select(
        "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )


@register("""
    SELECT generonome, dense_rank() OVER (ORDER BY generonome) - 1 AS slot FROM (SELECT DISTINCT generonome FROM training)
    UNION ALL SELECT 'no such genre', NULL""")
def model_one_hot(spark, d):
    """The slot that is 1 for each genre; a genre that training did not see has none."""
    training = staging.stage(_training(spark, d), "training")
    _, _, index, hot, *_ = model.build_pipeline().getStages()
    fitted = index.fit(training)
    encoder = hot.fit(fitted.transform(training))
    genres = training.select("generonome").distinct().union(spark.sql("SELECT 'no such genre'"))
    states = training.agg(F.min("estado")).scalar()
    shown = encoder.transform(fitted.transform(genres.withColumn("estado", states)))
    values = vector_to_array("generonome_hot")
    slot = F.array_position(values, F.lit(1.0)) - 1
    return shown.select("generonome", F.when(slot >= 0, slot).cast("bigint").alias("slot"))


@register("""
    SELECT estado, least(25, (SELECT count(*) FROM candidates)) AS n, TRUE AS in_range, TRUE AS in_order
    FROM (SELECT DISTINCT estado FROM training)""")
def model_predictions(spark, d):
    """What must hold for the picks of a real forest, whatever it predicts; the forest is that of ``recommend_model``."""
    picks = staging.stage(recommendations(spark, d), "picks")
    after = F.lag("PredicaoModelo").over(Window.partitionBy("Estado").orderBy("FilmeIMDbSK"))
    marked = picks.withColumn("falls", F.coalesce(after >= F.col("PredicaoModelo"), F.lit(True)))
    return marked.groupBy(F.col("Estado").alias("estado")).agg(
        F.count("*").alias("n"), F.every(F.col("PredicaoModelo").between(1, 5)).alias("in_range"),
        F.every("falls").alias("in_order"),
    )


@register("SELECT r_name AS estado, TRUE AS close FROM region")
def model_learns(spark, d):
    """A forest of thirty trees learns a known function of the part's size and the region to 0.25."""
    part, region = src.table(spark, d, "part"), src.table(spark, d, "region")
    known = 1.0 + (F.col("r_regionkey") % 4) + F.when(F.col("p_size") > 25, 1).otherwise(0)
    every = region.agg(F.collect_list(F.struct("r_regionkey", "r_name"))).scalar()  # five rows
    rows = part.select("p_size", "p_type").distinct().select("*", F.inline(every)).select(
        F.lit(2000.0).alias("anodelancamento"), F.col("p_size").cast("double").alias("duracaomin"),
        F.col("p_type").alias("generonome"), F.col("r_name").alias("estado"), known.alias("nota"),
    )
    training = staging.stage(rows, "training")
    scored = model.score(rows, model.train(training, num_trees=30))
    return scored.groupBy("estado").agg(F.every(F.abs(F.col("predicaomodelo") - F.col("nota")) < 0.25).alias("close"))


@register("""
    SELECT estado, least(25, (SELECT count(*) FROM candidates)) AS n, TRUE AS same
    FROM (SELECT DISTINCT estado FROM training)""")
def model_partition_free(spark, d):
    """The picks of a forest grown in 16 and in 64 parts: films and predictions are the same."""
    training, candidates = staging.together(
        lambda: staging.stage(_training(spark, d), "training"), lambda: _candidates(spark, d)
    )
    states = features.known_states(training)
    some, many = (model.recommend(training, candidates, states, num_trees=12, parts=parts) for parts in (16, 64))
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in some.columns]
    both = some.alias("a").join(many.alias("b"), functools.reduce(lambda x, y: x & y, on), "left")
    return both.groupBy(F.col("a.Estado").alias("estado")).agg(
        F.count("*").alias("n"), F.every(F.col("b.FilmeIMDbSK").isNotNull()).alias("same")
    )


@register("""
    SELECT count(*) AS n_groups, CAST(sum(n) AS BIGINT) AS n_rows, TRUE AS mean_holds, TRUE AS spread_holds, TRUE AS whole
    FROM (SELECT count(*) AS n FROM training GROUP BY anodelancamento, duracaomin, generonome, estado, nota)""")
def bootstrap_weights(spark, d):
    """Weights of every training row in 64 trees: their mean and variance are those of drawing with replacement."""
    rows = features.compact(_training(spark, d)).withColumn("h", F.xxhash64(*model.K.FEATURE_COLUMNS, model.K.TARGET))
    drawn = rows.select("n_equal", "h", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("tree")).withColumn(
        "w", forest.bootstrap_weight(F.col("n_equal"), F.col("h"), F.col("tree"), model.K.SEED)
    )
    scaled = (F.col("w") - F.col("n_equal")) / F.sqrt("n_equal")
    n = F.count("*")
    out = drawn.agg(
        F.count_if(F.col("tree") == 0).alias("n_groups"), F.sum(F.when(F.col("tree") == 0, F.col("n_equal"))).alias("n_rows"),
        (F.abs(F.avg(scaled)) < 5 / F.sqrt(n)).alias("mean_holds"),
        (F.abs(F.avg(scaled * scaled) - 1) < 10 / F.sqrt(n)).alias("spread_holds"),
        F.every((F.col("w") >= 0) & (F.col("w") == F.floor("w"))).alias("whole"),
    )
    return out


# --- later loads ---------------------------------------------------------------------------------


@register("""
    SELECT * FROM u_first
    UNION ALL
    SELECT email, telefone, (SELECT max(usuariosk) FROM u_first) + row_number() OVER (ORDER BY email, telefone) AS usuariosk
    FROM (SELECT DISTINCT email, telefone FROM usuario u WHERE bairro <> 'MACHINERY'
          AND NOT EXISTS (SELECT 1 FROM u_first f WHERE f.email = u.email AND f.telefone = u.telefone))""")
def key_registry(spark, d):
    """Two loads of the users: the second one lacks a district and has another one new. Known users keep
    their keys, new ones are numbered above; the second load is sent twice."""
    users, root = src.usuario(spark, d), staging.staged_path(spark, "registry")
    register_keys(users.filter("bairro <> 'BUILDING'"), load.USER_KEY, "usuariosk", root, "first")
    register_keys(users.filter("bairro <> 'MACHINERY'"), load.USER_KEY, "usuariosk", root, "second")
    return register_keys(users.filter("bairro <> 'MACHINERY'"), load.USER_KEY, "usuariosk", root, "second")


def _files(spark, root, fact):
    """File name and year of every file of a fact."""
    like = spark.createDataFrame([], incremental.FACTS[fact])
    rows = incremental.read_partitioned(spark, f"{root}/facts/{fact}", like, incremental.MONTH)
    return rows.select(F.col("_metadata.file_name").alias("file"), F.substring("month", 1, 4).cast("int").alias("ano")).distinct()


def _batches(spark, d, root):
    """Payments before 1998, those of 1996 without their amounts, and the first ratings; then what came
    late; then the amounts of 1996. The late batch is sent twice."""
    source = src.operational(spark, d)
    payments, ratings = source["usrpagto"], source["avaliacao"]
    year, day = F.year("datapagto"), F.col("avaliacaodata")
    early = day < F.lit("2024-01-15").cast("date")
    open_1996 = payments.filter(year < 1998).withColumn("valorpago", F.when(year == 1996, 0.0).otherwise(F.col("valorpago")))
    incremental.load_batch(source, open_1996, ratings.filter(early), root, "base")
    late = (source, payments.filter(year >= 1998), ratings.filter(~early), root, "late")
    incremental.load_batch(*late)
    before = staging.stage(_files(spark, root, "receita"), "files")
    incremental.load_batch(source, payments.filter(year == 1996), ratings.limit(0), root, "corrections")
    incremental.load_batch(*late)
    return before


@register("SELECT * FROM f_receita")
def incremental_revenue(spark, d):
    """Base and two later batches, one sent twice, equal the full load."""
    root = staging.staged_path(spark, "incremental")
    _batches(spark, d, root)
    return incremental.loaded_fact(spark, root, "receita")


@register("SELECT * FROM f_avaliacao")
def incremental_rating(spark, d):
    root = staging.staged_path(spark, "incremental")
    _batches(spark, d, root)
    return incremental.loaded_fact(spark, root, "avaliacao")


@register("""
    SELECT DISTINCT CAST(extract(year FROM datapagto) AS INTEGER) AS ano, extract(year FROM datapagto) <> 1996 AS untouched
    FROM usrpagto""")
def incremental_untouched(spark, d):
    """Which years keep all their files, by name, while the corrections of one year are merged."""
    root = staging.staged_path(spark, "incremental")
    before = _batches(spark, d, root).withColumn("was", F.lit(True))
    both = before.join(_files(spark, root, "receita").withColumn("is", F.lit(True)), ["file", "ano"], "full")
    return both.groupBy("ano").agg(F.every(F.coalesce("was", F.lit(False)) & F.coalesce("is", F.lit(False))).alias("untouched"))


@register(REVENUE_CHECKS)
def check_increment(spark, d):
    """The revenue fact in two batches, each read once; the checks come from their states."""
    revenue, addresses = _revenue(spark, d)
    revenue = staging.stage(revenue, "revenue")
    root, table = staging.staged_path(spark, "check-state"), schemas.WAREHOUSE["receita"]
    checkstate.add_batch(revenue.filter("valorpago < 100000"), table, root, "base")
    for _ in range(2):  # sent twice
        checkstate.add_batch(revenue.filter("NOT valorpago < 100000"), table, root, "delta")
    parents = {
        "endereco": (mutate.shrink_dimension(addresses, "estado", "enderecosk"), "enderecosk"),
        "usuario": (_users(spark, d)[0], "usuariosk"), "calendario": (_calendar(spark, d), "calendariosk"),
    }
    return checkstate.check_state(spark, table, root, parents)


# --- layout and landing ------------------------------------------------------------------------------


@register("SELECT * FROM f_avaliacao")
def bucketed_rating(spark, d):
    """The rating fact from ratings and users that lie in buckets of the user: neither is exchanged to meet the other."""
    (_, user_map), film_map, (producers, producer_map), payer, cal = staging.together(
        lambda: _users(spark, d),
        lambda: dims.from_entity(src.filme(spark, d).select("filmeid"), "filmeid", "filmesk"),
        lambda: load.load_producers(src.produtora(spark, d)),
        lambda: staging.stage(facts.latest_payer(src.filmpagtoroy(spark, d)), "payer"),
        lambda: staging.stage(_calendar(spark, d), "calendar"),
    )
    films = load.film_keys_of(film_map, payer, producers, producer_map)
    ratings = src.avaliacao(spark, d)
    n, where = bucketed.bucket_count(ratings, user_map), staging.staged_path(spark, "bucketed")
    rows, users = staging.together(
        lambda: bucketed.write_bucketed(ratings, "starmill_bucketed", "avaliacao", "usuarioid", n, where),
        lambda: bucketed.write_bucketed(user_map, "starmill_bucketed", "user_map", "usuarioid", n, where, hot_rows=None),
    )
    return facts.rate(bucketed.bucket_join(spark, rows, users), films, cal)


@register(r"""
    SELECT tconst, TRY_CAST(startyear AS BIGINT) AS "startYear", NULL AS reason FROM title_basics
    WHERE tconst NOT IN (SELECT 'tt' || p_partkey FROM part WHERE p_size IN (9, 11, 14, 21))
    UNION ALL
    SELECT 'tt' || p_partkey, NULL, CASE WHEN p_size = 9 THEN 'columns: 8 of 9' WHEN p_size = 11 THEN 'columns: 10 of 9'
           WHEN p_size = 14 THEN 'value: runtimeMinutes' ELSE 'header' END FROM part WHERE p_size IN (9, 11, 14, 21)""")
def ingest_quarantine(spark, d):
    """Packed landing files with lines that lack a field, have one too many or a bad number, and files without
    a header: rows go to the table, lines to the rejects with the reason."""
    basics, table = src.title_basics(spark, d), schemas.CATALOGUE["title-basics"]
    size = src.table(spark, d, "part").select(F.concat(F.lit("tt"), F.col("p_partkey").cast("string")).alias("tconst"), "p_size")
    fields = [F.coalesce(F.col(c), F.lit("\\N")) for c in table.names()]
    line = F.when(F.col("p_size") == 9, F.concat_ws("\t", *fields[:-1])).when(
        F.col("p_size") == 11, F.concat_ws("\t", *fields, F.lit("more"))
    ).otherwise(F.concat_ws("\t", *fields))
    lines = staging.stage(basics.join(size, "tconst").select(line.alias("\t".join(table.names())), "p_size"), "lines")
    raw = staging.staged_path(spark, "landing")
    plain = {"sep": "\x01", "quote": "", "compression": "gzip", "ignoreTrailingWhiteSpace": False, "ignoreLeadingWhiteSpace": False}
    lines.filter("p_size <> 21").drop("p_size").write.options(header=True, **plain).csv(f"{raw}/headed")
    lines.filter("p_size = 21").drop("p_size").write.options(header=False, **plain).csv(f"{raw}/bare")
    accepted, rejected = landing.ingest_with_rejects(
        spark, f"{raw}/*", table, staging.staged_path(spark, "brute"), staging.staged_path(spark, "rejects"),
        strict=["runtimeMinutes"],
    )
    bad = rejected.select(F.split("line", "\t")[0].alias("tconst"), F.lit(None).cast("bigint").alias("startYear"), "reason")
    return accepted.select("tconst", "startYear", F.lit(None).cast("string").alias("reason")).unionByName(bad)


@register("""
    SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value,
           CASE WHEN event_type = 'click' THEN NULL ELSE props END AS props
    FROM events""")
def catalogue_evolve(spark, d):
    """A table whose older files have narrower and fewer columns is brought up to its files and read whole."""
    events, place = src.table(spark, d, "events"), staging.staged_path(spark, "evolving")
    old = events.filter("event_type = 'click'").select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("int").alias("user_id"))
    old.write.parquet(place)
    writers.drop_namespace(spark, "starmill_evolving")
    writers.create_schema(spark, "starmill_evolving", staging.staged_path(spark, "evolving-schema"))
    spark.catalog.createTable("starmill_evolving.events", path=place, source="parquet")
    fresh = events.filter("event_type IS DISTINCT FROM 'click'").select("event_id", "user_id", "value", "props")
    fresh.write.mode("append").parquet(place)
    landing.evolve_table(spark, "starmill_evolving.events")
    return spark.table("starmill_evolving.events")


@register("""
    SELECT * FROM (VALUES ('training', 'RuntimeError'), ('states', 'ValueError'), ('revenue', '0 rows'), ('candidates', '0 rows'))
    t(missing, outcome)""")
def guard_outcomes(spark, d):
    """What each empty input of the recommender leads to, the others being whole."""
    training, candidates = staging.together(
        lambda: staging.stage(_training(spark, d), "training"), lambda: _candidates(spark, d)
    )
    revenue, addresses = _revenue(spark, d)
    states = features.known_states(training)
    trees = {"num_trees": 2}
    tried = {
        "training": lambda: model.recommend(training.limit(0), candidates, states, **trees),
        "states": lambda: model.recommend(training, candidates, states.limit(0), **trees),
        "revenue": lambda: features.user_state(revenue.limit(0), addresses),
        "candidates": lambda: model.recommend(training, candidates.limit(0), states, **trees),
    }

    def outcome(run) -> str:
        try:
            return f"{run().count()} rows"
        except (RuntimeError, ValueError) as e:
            return type(e).__name__

    return spark.createDataFrame([(name, outcome(run)) for name, run in tried.items()], "missing string, outcome string")
