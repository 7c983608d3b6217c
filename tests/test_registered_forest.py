from workload import queries


def test_checked_picks_are_those_of_the_production_forest(spark, monkeypatch):
    """The row check passes no option that makes the forest smaller than that of recommend_model."""
    seen = []

    def picks(spark, d, **options):
        seen.append(options)
        return spark.createDataFrame([("x", 1, 3.0)], "Estado string, FilmeIMDbSK long, PredicaoModelo double")

    monkeypatch.setattr(queries, "recommendations", picks)
    assert queries.QUERIES["model_predictions"](spark, "unused").collect()[0].n == 1
    assert seen == [{}]
