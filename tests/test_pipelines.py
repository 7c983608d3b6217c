"""The four pipelines on a hand-made company."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators.quality import ConstraintError, check_fk
from starmill.plans import init_load, load_catalogue, rollup_and_predict, run_recommender
from starmill.recommend import catalog, features, forest, model
from starmill.sources.publish import publish

D = dt.date
RUN = "2024-06-01"


@pytest.fixture(scope="module")
def source(spark):
    return {
        "usuario": spark.createDataFrame(
            [
                (10, "b@x", "1", "B1", "M1", "SP", "L1"),
                (11, "a@x", "2", "B2", "M2", "SP", "L2"),
                (12, "c@x", "3", "B1", "M1", "SP", "L1"),
                (13, "c@x", "3", "B3", "M3", "RJ", "L3"),
                (1, "d@x", "4", "B4", "M4", "RJ", "L4"),
            ],
            "usuarioid int, email string, telefone string, bairro string, municipio string, estado string, logradouro string",
        ),
        "filme": spark.createDataFrame(
            [(100, "look", 65, 2009), (101, "occur", 82, 1982), (105, "enjoy", 176, 1977)],
            "filmeid int, filmenome string, duracaomin int, anode_lancamento int",
        ),
        "filme_generofilme": spark.createDataFrame([("war", 100), ("art", 100)], "generofilme string, filmeid int"),
        "produtora": spark.createDataFrame([(7, "P7"), (3, "P3")], "produtoraid int, produtoranome string"),
        "filmpagtoroy": spark.createDataFrame(
            [(1.0, D(2024, 1, 5), 7, 100), (2.0, D(2024, 1, 5), 3, 100), (1.0, D(2023, 1, 5), 7, 101)],
            "valorpagto double, datapagto date, produtoraid int, filmeid int",
        ),
        "avaliacao": spark.createDataFrame(
            [(0, D(2024, 1, 2), 5, 10, 100), (1, D(2024, 1, 3), 1, 13, 101), (2, D(2024, 1, 3), 3, 11, 105), (3, D(2024, 1, 3), 4, 1, 105)],
            "avaliacaoid int, avaliacaodata date, nota int, usuarioid int, filmeid int",
        ),
        "usrpagto": spark.createDataFrame(
            [(0, 9.5, D(2024, 1, 1), 12), (1, 1.0, D(2024, 1, 4), 13), (2, 1.0, D(2024, 1, 4), 13), (3, 2.0, D(2024, 1, 2), 11), (4, 7.0, D(2024, 1, 2), 1)],
            "usrpagtoid int, valorpago double, datapagto date, usuarioid int",
        ),
    }


@pytest.fixture(scope="module")
def warehouse(source):
    return init_load(source, RUN)


def test_initial_load(warehouse, rows):
    assert rows(warehouse["usuario"]) == [(1, "a@x", "2"), (2, "b@x", "1"), (3, "c@x", "3"), (4, "d@x", "4")]
    assert rows(warehouse["user_map"]) == sorted([(10, 2), (11, 1), (12, 3), (13, 3), (1, 4)], key=repr)
    assert rows(warehouse["endereco"], "enderecosk", "bairro", "estado") == [
        (1, "B1", "SP"), (2, "B2", "SP"), (3, "B3", "RJ"), (4, "B4", "RJ"),
    ]
    assert rows(warehouse["filme"], "filmesk", "filmenome", "generonome") == [
        (1, "look", "art"), (2, "occur", "Gênero Desconhecido"), (3, "enjoy", "Gênero Desconhecido"),
    ]
    assert rows(warehouse["produtora"]) == [(1, "P3"), (2, "P7"), (3, "Produtora Desconhecida")]
    assert warehouse["calendario"].count() == 4
    # avaliacaosk, nota, usuariosk, filmesk, produtorask, calendariosk
    assert rows(warehouse["avaliacao"]) == [(0, 5, 2, 1, 1, 2), (1, 1, 3, 2, 2, 3), (2, 3, 1, 3, 3, 3), (3, 4, 4, 3, 3, 3)]
    assert rows(warehouse["receita"]) == [(0, 9.5, 3, 1, 1), (1, 1.0, 3, 4, 3), (2, 1.0, 3, 4, 3), (3, 2.0, 1, 2, 2), (4, 7.0, 4, 2, 4)]


def test_warehouse_passes_its_constraints(spark, warehouse, tmp_path):
    publish(spark, {n: warehouse[n] for n in schemas.WAREHOUSE}, str(tmp_path), schemas.WAREHOUSE)


def _predictions(spark, states):
    return spark.createDataFrame(
        [(i + 1, "f", 2000.0, 90.0, "Drama", 8.0, 2000.0, s, 4.5) for i, s in enumerate(states)],
        "FilmeIMDbSK long, FilmeNome string, AnoDeLancamento double, DuracaoMin double, GeneroNome string, "
        "IMDbAvaliacao double, IMDbNumVotos double, Estado string, PredicaoModelo double",
    )


def test_rollup(spark, source, warehouse, rows):
    out = rollup_and_predict(warehouse, source["usuario"], _predictions(spark, ["SP", "RJ"]), RUN, warehouse["user_map"])
    assert rows(out["endereco"]) == [(1, "SP"), (3, "RJ")]
    assert rows(out["receita"], "receitask", "enderecosk") == [(0, 1), (1, 3), (2, 3), (3, 1), (4, 3)]
    # User 3 has ids 12 and 13; the address of the smallest id counts.
    assert rows(out["avaliacao"], "avaliacaosk", "usuariosk", "enderecosk") == [(0, 2, 1), (1, 3, 1), (2, 1, 1), (3, 4, 3)]
    assert out["calendario"].count() == 5
    assert rows(out["modelprediction"], "filmeimdbsk", "enderecosk", "calendariosk") == [(1, 1, 5), (2, 3, 5)]
    assert out["modelprediction"].columns == schemas.ROLLED_UP["modelprediction"].names()
    for fact in ("receita", "avaliacao", "modelprediction"):
        assert check_fk(out[fact], "enderecosk", out["endereco"]).isEmpty()
    again = rollup_and_predict(
        {**warehouse, "receita": out["receita"]}, source["usuario"], _predictions(spark, ["SP"]), RUN, warehouse["user_map"]
    )
    assert rows(again["receita"]) == rows(out["receita"])


def test_rollup_positional(spark, source, warehouse, rows):
    out = rollup_and_predict(warehouse, source["usuario"], _predictions(spark, []), RUN, user_key="positional")
    # Only warehouse key 1 equals an operational id, the one of another user.
    assert rows(out["avaliacao"], "usuariosk", "enderecosk") == sorted([(2, None), (3, None), (1, 3), (4, None)], key=repr)


def test_unmatched_prediction(spark, source, warehouse, rows):
    args = (warehouse, source["usuario"], _predictions(spark, ["SP", "XX"]), RUN, warehouse["user_map"])
    with pytest.raises(ConstraintError):
        rollup_and_predict(*args)
    out = rollup_and_predict(*args, on_unmatched="reject")
    assert rows(out["modelprediction"], "filmeimdbsk") == [(1,)]
    assert rows(out["rejected"], "filmeimdbsk", "enderecosk") == [(2, None)]


def test_home_state(warehouse, rows):
    # User 3 paid once in SP and twice in RJ.
    assert rows(features.user_state(warehouse["receita"], warehouse["endereco"])) == [(1, "SP"), (3, "RJ"), (4, "RJ")]
    none = warehouse["receita"].limit(0)
    assert features.user_state(none, warehouse["endereco"]).count() == 0


def test_training_set(warehouse, rows):
    states = features.user_state(warehouse["receita"], warehouse["endereco"])
    out = features.training_set(warehouse["avaliacao"], warehouse["filme"], states)
    assert rows(out, "avaliacaosk", "estado", "nota") == [(1, "RJ", 1.0), (2, "SP", 3.0), (3, "RJ", 4.0)]
    assert [r.estado for r in features.known_states(out).collect()] == ["RJ", "SP"]


def test_compact_counts_equal_rows(spark):
    df = spark.range(30).select(
        F.lit(2000.0).alias("anodelancamento"), F.lit(90.0).alias("duracaomin"), F.lit("g").alias("generonome"),
        F.when(F.col("id") < 25, "SP").otherwise("RJ").alias("estado"), F.lit(4.0).alias("nota"),
    )
    assert {r.estado: r.n_equal for r in features.compact(df).collect()} == {"SP": 25, "RJ": 5}


def test_poisson_draws(spark):
    """Mean and variance of the draws, small means and large ones; the same draw for the same parts."""
    for mean in (0.5, 1.0, 29.0, 31.0, 500.0):
        drawn = spark.range(40000).select(forest.poisson(F.lit(mean), F.col("id"), F.lit(7)).alias("w"), "id")
        got = drawn.agg(F.avg("w").alias("m"), F.var_samp("w").alias("v"), F.min("w").alias("lo")).first()
        assert abs(got.m - mean) < 5 * (mean / 40000) ** 0.5 and abs(got.v / mean - 1) < 0.06 and got.lo >= 0
    zero = spark.range(40000).filter(forest.poisson(F.lit(1.0), F.col("id"), F.lit(1)) == 0).count()
    assert abs(zero / 40000 - 0.3679) < 0.01


def test_picks_do_not_depend_on_parts_or_order(spark):
    r = random.Random(4)
    data = [(1900.0 + r.randrange(400) / 3, 60.0 + r.randrange(90), r.choice("abc"), r.choice("xyz"), float(r.randrange(1, 6))) for _ in range(3000)]
    columns = "anodelancamento double, duracaomin double, generonome string, estado string, nota double"
    probe = spark.createDataFrame(data, columns).drop("nota").distinct()

    def scores(rows, slices, **options):
        fitted = model.train(spark.createDataFrame(rows, columns).repartition(slices), num_trees=5, **options)
        return {tuple(x)[:4]: round(x.predicaomodelo, 9) for x in model.score(probe, fitted).collect()}

    one = scores(data, 1, parts=1)
    assert one == scores(data[::-1], 7, parts=64) == scores(sorted(data), 3)
    assert one != scores(data, 1, seed=43)


def test_few_rows_and_heavy_rows(spark):
    columns = "anodelancamento double, duracaomin double, generonome string, estado string, nota double"
    single = spark.createDataFrame([(2000.0, 90.0, "g", "SP", 3.0)], columns)
    assert model.score(single.drop("nota"), model.train(single, num_trees=6)).first().predicaomodelo == 3.0
    heavy = spark.createDataFrame([(2000.0, 90.0, "g", "SP", 5.0)] * 3000 + [(2000.0, 90.0, "g", "SP", 1.0)] * 1000, columns)
    assert abs(model.score(single.drop("nota"), model.train(heavy, num_trees=30)).first().predicaomodelo - 4.0) < 0.05


def test_forest_can_be_saved(spark, tmp_path):
    from pyspark.ml import PipelineModel

    rows = [(2000.0 + i, 90.0, "ab"[i % 2], "SP", float(i % 2 + 1)) for i in range(40)]
    training = spark.createDataFrame(rows, "anodelancamento double, duracaomin double, generonome string, estado string, nota double")
    fitted = model.train(training, num_trees=3)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    points = training.drop("nota")
    assert [tuple(r) for r in model.score(points, fitted).collect()] == [tuple(r) for r in model.score(points, again).collect()]


BASICS = "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"


@pytest.fixture(scope="module")
def movies(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    lines = [
        "tt1\tmovie\tA\tA\t0\t1999\t\\N\t100\tDrama,Crime",
        "tt1\tmovie\tZ\tA\t0\t1999\t\\N\t100\tDrama",
        "tt2\tmovie\tB\tB\t0\t\\N\t\\N\t90\tWar",
        "tt3\tshort\tC\tC\t0\t2001\t\\N\t9\tWar",
        "tt4\tmovie\tD\tD\t0\t2001\t\\N\t80\t\\N",
        "tt5\tmovie\tE\tE\t0\t2002\t\\N\t70\t Art ,War",
        "tt6\tmovie\tF\tF\t0\t1890\t\\N\t70\tWar",
        "tt7\tmovie\tG\tG\t0\t2003\t\\N\t0\tWar",
    ]
    (folder / "b.tsv").write_text(BASICS + "\n".join(lines) + "\n")
    ratings = ["tt1\t8.0\t2000", "tt1\t7.0\t9000", "tt2\t9\t5000", "tt3\t9.9\t9999", "tt4\t8.0\t3000", "tt5\t6.2\t1000",
               "tt6\t9.0\t5000", "tt7\t9.0\t5000", "tt8\t9.0\t5000"]
    (folder / "r.tsv").write_text("tconst\taverageRating\tnumVotes\n" + "\n".join(ratings) + "\n")
    return load_catalogue(
        spark, {"title-basics": str(folder / "b.tsv"), "title-ratings": str(folder / "r.tsv")},
        str(folder / "brute"), str(folder / "out"),
    )[1]


def test_extract(movies):
    got = [(r.tconst, r.primarytitle, r.averagerating, r.numvotes, r.genres) for r in catalog_order(movies)]
    assert got == [
        ("tt2", "B", 9.0, 5000.0, "War"), ("tt6", "F", 9.0, 5000.0, "War"), ("tt7", "G", 9.0, 5000.0, "War"),
        ("tt4", "D", 8.0, 3000.0, "\\N"), ("tt1", "A", 8.0, 2000.0, "Drama"), ("tt5", "E", 6.2, 1000.0, " Art "),
    ]


def catalog_order(df):
    return df.orderBy(*catalog.best_first("averagerating", "numvotes", "tconst")).collect()


def test_candidates(movies):
    got = [(r.filmeimdbskraw, r.generonome) for r in catalog.prepare_candidates(movies).collect()]
    assert got == [("tt4", "\\N"), ("tt1", "Drama"), ("tt5", "Art")]
    clean = catalog.prepare_candidates(movies, limit=2, null_marker="\\N").collect()
    assert [(r.filmeimdbskraw, r.generonome) for r in clean] == [("tt4", "desconhecido"), ("tt1", "Drama")]


def test_recommender(spark, movies, rows, tmp_path):
    ratings = spark.range(400).select(
        F.col("id").alias("avaliacaosk"), (F.col("id") % 40).alias("usuariosk"), (F.col("id") % 10 + 1).alias("filmesk"),
        (F.col("id") % 5 + 1).alias("nota"),
    )
    films = spark.range(1, 11).select(
        F.col("id").alias("filmesk"), F.lit("f").alias("filmenome"), (F.lit(1990) + F.col("id")).alias("anodelancamento"),
        (F.col("id") * 10).alias("duracaomin"), F.when(F.col("id") < 5, "Drama").otherwise("War").alias("generonome"),
    )
    revenue = spark.range(40).select(F.col("id").alias("usuariosk"), (F.col("id") % 3 + 1).alias("enderecosk"))
    addresses = spark.createDataFrame([(1, "SP"), (2, "RJ"), (3, "MG")], "enderecosk long, estado string")
    run = lambda **kw: run_recommender(ratings, films, revenue, addresses, movies, top_k=2, num_trees=8, **kw)
    out = run(schema="t_model", out_path=str(tmp_path / "p"))
    got = out.orderBy("FilmeIMDbSK").collect()
    assert [r.FilmeIMDbSK for r in got] == [1, 2, 3, 4, 5, 6]
    assert [r.Estado for r in got] == ["MG", "MG", "RJ", "RJ", "SP", "SP"]
    assert all(1.0 <= r.PredicaoModelo <= 5.0 for r in got)
    assert all(a.PredicaoModelo >= b.PredicaoModelo for a, b in zip(got[::2], got[1::2]))
    assert out.columns == schemas.PREDICTION_STAGING
    assert rows(spark.table("t_model.model_infer")) == rows(out) == rows(spark.read.parquet(str(tmp_path / "p")))
    assert rows(run()) == rows(out)  # same seed, same trees


def test_recommender_guards(spark, movies):
    training = spark.createDataFrame([], "anodelancamento double, duracaomin double, generonome string, estado string, nota double")
    candidates = catalog.prepare_candidates(movies)
    with pytest.raises(RuntimeError):
        model.recommend(training, candidates, features.known_states(training))
    some = spark.createDataFrame([(1.0, 1.0, "g", "SP", 1.0)], training.schema)
    with pytest.raises(ValueError):
        model.recommend(some, candidates, features.known_states(training))


def test_unseen_category_is_all_zeros(spark):
    rows = [(2000.0 + i, 90.0, "ab"[i % 2], "SP", float(i % 5)) for i in range(20)]
    training = spark.createDataFrame(rows, "anodelancamento double, duracaomin double, generonome string, estado string, nota double")
    fitted = model.train(training, num_trees=2)
    probe = spark.createDataFrame([(2000.0, 90.0, "zz", "SP"), (2000.0, 90.0, "b", "SP")], "anodelancamento double, duracaomin double, generonome string, estado string")
    hot = [r.generonome_hot.toArray().tolist() for r in fitted.transform(probe).collect()]
    assert hot == [[0.0, 0.0], [0.0, 1.0]]


def test_equal_predictions_keep_candidate_order(spark, movies, rows):
    states = spark.createDataFrame([("SP",), ("RJ",), ("SP",)], "estado string")
    pairs = model.pair_states(states, catalog.prepare_candidates(movies))
    assert pairs.count() == 6
    out = model.rank_predictions(model.score_with(pairs, F.lit(9.0)), top_k=2, keep_id=True)
    assert rows(out, "FilmeIMDbSK", "Estado", "tconst", "PredicaoModelo") == [
        (1, "RJ", "tt4", 5.0), (2, "RJ", "tt1", 5.0), (3, "SP", "tt4", 5.0), (4, "SP", "tt1", 5.0),
    ]


def test_forest_learns_genre_and_state(spark):
    grade = {("Drama", "SP"): 5.0, ("Drama", "RJ"): 2.0, ("War", "SP"): 1.0, ("War", "RJ"): 4.0}
    data = [(1990.0 + i % 20, 80.0 + i % 30, g, s, n) for i in range(60) for (g, s), n in grade.items()]
    training = spark.createDataFrame(
        data, "anodelancamento double, duracaomin double, generonome string, estado string, nota double"
    )
    scored = model.score(training.drop("nota").distinct(), model.train(training, num_trees=10)).collect()
    assert scored and all(abs(r.predicaomodelo - grade[r.generonome, r.estado]) < 0.5 for r in scored)


def test_task_memory_follows_the_session(spark):
    assert model.default_task_memory_mb(spark) == 256  # 8 GB for 8 cores in these tests
