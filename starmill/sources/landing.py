"""Landing zone to typed tables, and a report of schema drift."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions import null_out, to_long, to_numeric
from starmill.operators.joins import checked_broadcast
from starmill.schemas import Column, Table
from starmill.sources.readers import read_tsv
from starmill.sources.staging import stage, staged_path, together

NULL_MARKER = "\\N"


def _typed_column(column: Column, null_marker: str | None) -> SparkColumn:
    make = {
        "long": to_long,
        "double": to_numeric,
        "text": lambda c: null_out(c, null_marker),
        "int": lambda c: to_long(c).try_cast("int"),
        "date": lambda c: F.col(c).try_cast("date"),
    }
    return make[column.kind](column.name)


def typed(raw: DataFrame, table: Table, null_marker: str | None = None) -> DataFrame:
    """Text columns to the declared types. Text keeps its markers unless told otherwise;
    a number that does not parse becomes null (``quality.check_coercion`` counts those)."""
    return raw.select(*[_typed_column(c, null_marker).alias(c.name) for c in table.columns])


def ingest_landing(
    spark: SparkSession,
    sources: Mapping[str, str],
    tables: Mapping[str, Table],
    target: str,
    fmt: str = "parquet",
    null_marker: str | None = None,
) -> dict[str, DataFrame]:
    """Read each tab-separated source, give it its declared types and write it.

    ``fmt`` may be any installed source (``avro`` needs its package on the cluster).
    Typed columns let later range filters prune row groups.
    """

    def ingest(name: str, path: str) -> DataFrame:
        table = tables[name]
        location = f"{target.rstrip('/')}/{name}"
        frame = typed(read_tsv(spark, path, table.names()), table, null_marker)
        frame.write.format(fmt).mode("overwrite").save(location)
        return spark.read.format(fmt).schema(frame.schema).load(location)

    done = together(*[lambda n=name, p=path: ingest(n, p) for name, path in sources.items()])
    return dict(zip(sources, done))


def stage_lines(spark: SparkSession, path: str, row_group: int = 16 << 20) -> DataFrame:
    """Every line of the text files with the file it came from, written once as Parquet.

    A ``.gz`` file cannot be split, so one task unpacks it; what follows reads the written lines, many tasks per
    file, one per ``row_group`` bytes or more.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), "value")
    where = staged_path(spark, "lines")
    lines.write.option("parquet.block.size", str(row_group)).parquet(where)
    return spark.read.schema(lines.schema).parquet(where)


def read_with_rejects(
    spark: SparkSession, path: str, table: Table, sep: str = "\t", null_marker: str = "\\N", strict: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Rows of unquoted text files with a header line each, and the lines that are no rows.

    Rejected are lines with another number of fields (``columns: found of declared``), all lines of a file that lacks the
    declared header (``header``), and lines with a value in a ``strict`` column that is neither of
    its type nor the marker (``value: column``). The second frame has ``file``, ``line`` and ``reason``. Other
    unreadable numbers become null, as in ``typed``. Empty lines are no lines.
    """
    names = table.names()
    lines = stage_lines(spark, path).withColumn("value", F.regexp_replace("value", "\r$", "")).filter("value <> ''")
    header = sep.join(names)
    headed = stage(lines.filter(F.col("value") == header).select("file").distinct(), "headed")  # one row per file
    marked = lines.filter(F.col("value") != header).join(
        checked_broadcast(headed.withColumn("_headed", F.lit(True))), "file", "left"
    )
    fields = marked.withColumn("_f", F.split("value", re.escape(sep), -1))
    found = F.size("_f")
    raw = fields.select("*", *[F.when(found == len(names), F.col("_f")[i]).alias(n) for i, n in enumerate(names)])
    made = {c.name: _typed_column(c, null_marker) for c in table.columns}
    bad_value = [
        F.when((F.col(c) != null_marker) & made[c].isNull(), F.lit(f"value: {c}")) for c in strict
    ]
    reason = F.coalesce(
        F.when(F.col("_headed").isNull(), F.lit("header")),
        F.when(found != len(names), F.concat(F.lit("columns: "), found.cast("string"), F.lit(f" of {len(names)}"))),
        *bad_value,
    )
    judged = raw.withColumn("_reason", reason)
    accepted = judged.filter(F.col("_reason").isNull()).select(*[made[n].alias(n) for n in names])
    rejected = judged.filter(F.col("_reason").isNotNull()).select("file", F.col("value").alias("line"), F.col("_reason").alias("reason"))
    return accepted, rejected


def ingest_with_rejects(
    spark: SparkSession, path: str, table: Table, target: str, rejects: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Write the rows to ``target`` and the rejected lines to ``rejects``; one bad line no longer stops a load."""
    accepted, rejected = read_with_rejects(spark, path, table, **options)
    together(
        lambda: accepted.write.mode("overwrite").parquet(target), lambda: rejected.write.mode("overwrite").parquet(rejects)
    )
    return spark.read.schema(accepted.schema).parquet(target), spark.read.schema(rejected.schema).parquet(rejects)


def schema_diff(found: T.StructType, declared: T.StructType, spark: SparkSession) -> DataFrame:
    """Columns that were added, are missing or changed type, one row each."""
    have = {f.name.lower(): f.dataType.simpleString() for f in found}
    want = {f.name.lower(): f.dataType.simpleString() for f in declared}
    rows = [(c, "added", None, t) for c, t in have.items() if c not in want]
    rows += [(c, "missing", t, None) for c, t in want.items() if c not in have]
    rows += [(c, "retyped", want[c], t) for c, t in have.items() if c in want and want[c] != t]
    return spark.createDataFrame(rows, "column string, change string, declared string, found string")


def refresh_schema(spark: SparkSession, path: str, declared: Table) -> tuple[DataFrame, DataFrame]:
    """The table as it now lies at the path, merging part-file schemas, and its drift
    from the declaration. Nothing is dropped."""
    frame = spark.read.option("mergeSchema", True).parquet(path)
    return frame, schema_diff(frame.schema, declared.struct(), spark)


#: What a column may become without losing a value, besides itself.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def wider(a: str, b: str) -> str:
    """The type that holds both."""
    if a == b or b in WIDER.get(a, ()):
        return b
    if a in WIDER.get(b, ()):
        return a
    raise ValueError(f"no type holds both {a} and {b}")


def merged_schema(known: T.StructType, found: T.StructType) -> T.StructType:
    """The known columns, widened where the other schema asks for it, then its new columns, nullable."""
    types = {f.name.lower(): f.dataType.simpleString() for f in found}
    out = []
    for f in known:
        kind = f.dataType.simpleString()
        out.append(T.StructField(f.name, _type(wider(kind, types.get(f.name.lower(), kind)), f.dataType), True))
    have = {f.name.lower() for f in known}
    return T.StructType(out + [T.StructField(f.name, f.dataType, True) for f in found if f.name.lower() not in have])


def _type(simple: str, old: T.DataType) -> T.DataType:
    return old if old.simpleString() == simple else T.StructType.fromDDL(f"c {simple}")[0].dataType


def files_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema that all part files of a folder fit into.

    One distributed pass over the footers; only where files differ in a type that Spark does not merge is each
    file's schema read by itself.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except (Py4JJavaError, PySparkException) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    names = [r["p"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
             .load(path).select(F.col("_metadata.file_path").alias("p")).collect()]  # one row per file
    schemas = together(*[lambda n=n: spark.read.parquet(n).schema for n in sorted(names)])
    whole = schemas[0]
    for other in schemas[1:]:
        whole = merged_schema(whole, other)
    return whole


def evolve_table(spark: SparkSession, full_name: str) -> DataFrame:
    """Bring a Parquet table of the catalogue up to the files that lie at its place; returns what changed.

    Columns that files have and the table lacks are added, columns that became wider are widened; old files are
    read through the new schema, with null for what they lack. The table and its files stay where
    they are; a column that no file has any more stays too. Types that no common type holds raise.
    """
    known = spark.table(full_name).schema
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").filter("col_name = 'Location'").first()["data_type"]
    whole = merged_schema(known, files_schema(spark, place))
    changes = schema_diff(whole, known, spark)
    if whole != known:
        session = spark._jsparkSession.sessionState()
        schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(whole.json())
        session.catalog().alterTableDataSchema(session.sqlParser().parseTableIdentifier(full_name), schema)
        spark.catalog.refreshTable(full_name)
    return changes
