import gzip

import pytest
from pyspark.sql import functions as F

from starmill import schemas
from starmill.operators.quality import ConstraintError
from starmill.sources import landing, names, publish, readers, staging, writers


def test_read_semicolon_with_commas(spark, rows, tmp_path):
    (tmp_path / "p.csv").write_text("produtorask;produtoranome\n1;Fuentes, Bell and Brown\n2;A, B \n21;Produtora Desconhecida\n")
    df = readers.read_delimited(spark, str(tmp_path / "p.csv"), schemas.WAREHOUSE["produtora"].struct(), sep=";")
    assert rows(df) == [(1, "Fuentes, Bell and Brown"), (2, "A, B "), (21, "Produtora Desconhecida")]


def test_header_only_file(spark, tmp_path):
    table = schemas.ROLLED_UP["modelprediction"]
    (tmp_path / "m.csv").write_text(",".join(table.names()) + "\n")
    df = readers.read_delimited(spark, str(tmp_path / "m.csv"), table.struct())
    assert df.count() == 0 and df.columns == table.names()


def test_wrong_header_fails(spark, tmp_path):
    (tmp_path / "w.csv").write_text("a,b\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        readers.read_delimited(spark, str(tmp_path / "w.csv"), schemas.WAREHOUSE["produtora"].struct()).collect()


@pytest.mark.parametrize("packed", [False, True])
def test_landing_ingest(spark, rows, tmp_path, packed):
    text = "tconst\taverageRating\tnumVotes\ntt1\t7.5\t1200\ntt2\t\\N\t12d\ntt\"3\t6\t\\N\n"
    path = tmp_path / ("r.tsv.gz" if packed else "r.tsv")
    path.write_bytes(gzip.compress(text.encode()) if packed else text.encode())
    out = landing.ingest_landing(spark, {"title-ratings": str(path)}, schemas.CATALOGUE, str(tmp_path / "brute"))
    assert rows(out["title-ratings"]) == sorted([("tt1", 7.5, 1200), ("tt2", None, None), ('tt"3', 6.0, None)], key=repr)


def test_landing_text_marker(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("tconst\tdirectors\twriters\ntt1\t\\N\tx\n")
    source = {"title-crew": str(tmp_path / "c.tsv")}
    kept = landing.ingest_landing(spark, source, schemas.CATALOGUE, str(tmp_path / "a"))["title-crew"]
    clean = landing.ingest_landing(spark, source, schemas.CATALOGUE, str(tmp_path / "b"), null_marker="\\N")["title-crew"]
    assert kept.first().directors == "\\N" and clean.first().directors is None


def test_schema_diff(spark, rows):
    found = spark.createDataFrame([], "a int, B string, extra date").schema
    declared = spark.createDataFrame([], "a long, b string, gone int").schema
    assert rows(landing.schema_diff(found, declared, spark)) == sorted(
        [("extra", "added", None, "date"), ("gone", "missing", "int", None), ("a", "retyped", "bigint", "int")], key=repr
    )


@pytest.mark.parametrize("bad", ["a b", "x;drop", "x\n", "", "é"])
def test_names_are_checked(spark, bad):
    with pytest.raises(ValueError):
        names.check_name(bad)
    with pytest.raises(ValueError):
        writers.write_table(spark.range(1), schema=bad, table_name="t")
    with pytest.raises(ValueError):
        writers.write_table(spark.range(1), schema="s", table_name=bad)


def test_write_replace_append_read(spark, rows):
    df = spark.createDataFrame([(1, "a")], "ID int, Nome string")
    writers.write_table(df, schema="t_write", table_name="x")
    writers.write_table(df, schema="t_write", table_name="x")
    back = readers.read_table(spark, "x", "t_write")
    assert back.columns == ["id", "nome"] and back.count() == 1
    writers.write_table(df, schema="t_write", table_name="x", if_exists="append")
    assert readers.read_table(spark, "t_write.x").count() == 2
    with pytest.raises(ValueError):
        writers.write_table(df, schema="t_write", table_name="x", if_exists="other")
    writers.drop_namespace(spark, "t_write")
    assert not spark.catalog.databaseExists("t_write")


def test_namespaces_hold_typed_tables(spark):
    for schema, tables in (("t_oper", schemas.OPERATIONAL), ("t_dw", schemas.ROLLED_UP)):
        writers.create_namespace(spark, schema, tables)
        writers.create_namespace(spark, schema, tables)
        assert {t.name for t in spark.catalog.listTables(schema)} == set(tables)
    assert len(schemas.OPERATIONAL) == 16 and len(schemas.ROLLED_UP) == 8 and len(schemas.CATALOGUE) == 7
    with pytest.raises(Exception, match="(?i)length|limit"):
        spark.sql(f"insert into t_dw.produtora values (1, '{'x' * 129}')").collect()
    spark.sql("insert into t_dw.produtora values (1, 'x')")
    writers.recreate_table(spark, "t_dw", "produtora", schemas.WAREHOUSE["produtora"])
    assert spark.table("t_dw.produtora").count() == 0
    for schema in ("t_oper", "t_dw"):
        writers.drop_namespace(spark, schema)


def test_export(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "produtorask long, produtoranome string")
    writers.write_table(df, schema="t_export", table_name="produtora")
    where = writers.export_tables(spark, "t_export", ["Produtora"], str(tmp_path))
    back = readers.read_delimited(spark, where["Produtora"], df.schema)
    assert rows(back) == rows(df)


def test_drop_repeated_columns(spark):
    df = spark.sql("select 1 a, 2 b, 3 a, 4 c, 5 b")
    out = names.drop_repeated_columns(df)
    assert out.columns == ["a", "b", "c"] and tuple(out.first()) == (1, 2, 4)


def test_publish_checks_then_points(spark, rows, tmp_path):
    tables = {"produtora": schemas.WAREHOUSE["produtora"]}
    good = spark.createDataFrame([(1, "a"), (2, "b")], "produtorask long, produtoranome string")
    publish.publish(spark, {"produtora": good}, str(tmp_path), tables, schema="t_pub")
    assert rows(spark.table("t_pub.produtora")) == [(1, "a"), (2, "b")]
    for broken in (
        good.union(good), good.withColumn("produtoranome", F.lit("x" * 200)),
        good.withColumn("produtoranome", F.lit(None).cast("string")),
    ):
        with pytest.raises(ConstraintError):
            publish.publish(spark, {"produtora": broken}, str(tmp_path), tables, schema="t_pub")
        assert rows(spark.table("t_pub.produtora")) == [(1, "a"), (2, "b")]
    # A new run may read the published table it replaces.
    more = spark.table("t_pub.produtora").withColumn("produtoranome", F.upper("produtoranome"))
    publish.publish(spark, {"produtora": more}, str(tmp_path), tables, schema="t_pub")
    assert rows(spark.table("t_pub.produtora")) == [(1, "A"), (2, "B")]
    writers.drop_namespace(spark, "t_pub")


def test_shared_folder_is_the_sessions(spark):
    folder = staging.shared_dir(spark)
    assert folder == staging.shared_dir(spark)
    df = staging.stage(spark.range(5), "probe")
    assert df.count() == 5 and all(f.startswith(folder) for f in df.inputFiles()) or folder in df.inputFiles()[0]


def test_together_keeps_order(spark):
    got = staging.together(lambda: spark.range(3).count(), lambda: spark.range(5).count())
    assert got == [3, 5]
    with pytest.raises(ZeroDivisionError):
        staging.together(lambda: 1, lambda: 1 / 0)


def test_text_with_line_breaks_comes_back(spark, rows, tmp_path):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, None)], "produtorask long, produtoranome string")
    where = writers.export_frames({"produtora": df}, str(tmp_path))
    assert rows(readers.read_delimited(spark, where["produtora"], df.schema, multiline=True)) == rows(df)


def test_no_jobs_together():
    assert staging.together() == []
