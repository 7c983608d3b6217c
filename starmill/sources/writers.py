"""Writers and namespaces."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from starmill.schemas import Table
from starmill.sources.names import check_name


def create_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """Create the schema unless it exists. ``location`` is a folder all executors share;
    without one the warehouse folder of the session is used."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {check_name(schema)}{where}")


def write_table(
    df: DataFrame,
    *,
    schema: str,
    table_name: str,
    if_exists: str = "replace",
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Save as a catalogue table, creating its schema. ``replace``, ``append`` or ``fail``."""
    modes = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}
    if if_exists not in modes:
        raise ValueError(f"if_exists must be one of {sorted(modes)}")
    check_name(schema)
    check_name(table_name, "table")
    create_schema(df.sparkSession, schema, location)
    df.write.format(fmt).mode(modes[if_exists]).saveAsTable(f"{schema}.{table_name}")


def export_tables(
    spark: SparkSession, schema: str, names: Iterable[str], folder: str, fmt: str = "csv"
) -> dict[str, str]:
    """One output folder per catalogue table; returns where each went."""
    from starmill.sources.readers import read_table

    return export_frames({name: read_table(spark, name, schema) for name in names}, folder, fmt)


def export_frames(frames: Mapping[str, DataFrame], folder: str, fmt: str = "csv") -> dict[str, str]:
    """One output folder per frame. Text with line breaks is quoted; read it with ``multiline``."""
    written = {}
    for name, frame in frames.items():
        target = f"{folder.rstrip('/')}/{check_name(name, 'table').lower()}"
        writer = frame.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.save(target)
        written[name] = target
    return written


def create_namespace(
    spark: SparkSession,
    schema: str,
    tables: Mapping[str, Table],
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """The schema and its empty typed tables. Spark keeps VARCHAR lengths on insert;
    keys and NOT NULL are checked by ``starmill.operators.quality``."""
    create_schema(spark, schema, location)
    for name, table in tables.items():
        check_name(name, "table")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {schema}.{name} ({table.ddl()}) USING {fmt}")


def drop_namespace(spark: SparkSession, schema: str) -> None:
    spark.sql(f"DROP SCHEMA IF EXISTS {check_name(schema)} CASCADE")


def recreate_table(spark: SparkSession, schema: str, name: str, table: Table, fmt: str = "parquet") -> None:
    """Drop one table and create it empty."""
    full = f"{check_name(schema)}.{check_name(name, 'table')}"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(f"CREATE TABLE {full} ({table.ddl()}) USING {fmt}")
