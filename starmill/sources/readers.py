"""Readers. Every text read takes a declared schema, so there is no inference pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmill.sources.names import check_name, lower_columns


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    quote: str = '"',
    null_value: str | None = None,
    mode: str = "FAILFAST",
    multiline: bool = False,
) -> DataFrame:
    """Delimited text with a header line.

    ``multiline`` allows quoted values with line breaks; a file is then read by one task, so
    keep such files small or many.

    ``enforceSchema`` is off, so the header is checked against the schema.
    A ``.gz`` file cannot be split; unpack large ones before reading.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", sep)
        .option("quote", quote)
        .option("mode", mode)
        .option("multiLine", multiline)
    )
    if quote:
        reader = reader.option("escape", quote)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def read_tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-separated landing file, unquoted, every column as text with markers kept."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_delimited(spark, path, schema, sep="\t", quote="")


def read_table(spark: SparkSession, table_name: str, schema: str | None = None) -> DataFrame:
    """Whole catalogue table with lower-case column names."""
    parts = ([schema] if schema else []) + table_name.split(".")
    for part in parts:
        check_name(part, "table")
    return lower_columns(spark.table(".".join(parts)))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_name: str,
    partition_column: str,
    lower_bound: int,
    upper_bound: int,
    num_partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Whole table of a relational source, read in key ranges by many tasks."""
    for part in table_name.split("."):
        check_name(part, "table")
    return lower_columns(
        spark.read.jdbc(
            url,
            table_name,
            column=partition_column,
            lowerBound=lower_bound,
            upperBound=upper_bound,
            numPartitions=num_partitions,
            properties=dict(properties or {}),
        )
    )


def query_lake(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over frames named in braces: ``query_lake(spark, 'select … from {t}', t=df)``."""
    return spark.sql(query, **tables)
