"""Tables laid out by key, so joins and groupings on that key need no exchange.

Both sides of a join are written with the same number of buckets of the same key. Rows of a key that holds
very many rows go to a plain table beside it, since a bucket is one task: their few keys
meet the other side by broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.joins import HOT_ROWS, checked_broadcast, hot_keys, measured_bytes
from starmill.sources.names import check_name
from starmill.sources.staging import stage
from starmill.sources.writers import create_schema

BUCKET_BYTES = 128 * 1024 * 1024
MOST_BUCKETS = 1 << 15


def bucket_count(*frames: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """A power of two, so that the largest of the frames has about ``bucket_bytes`` in a bucket.

    A table that has outgrown its buckets can be written with a multiple of them.
    """
    most = max(measured_bytes(f) for f in frames)
    wanted = max(1, -(-most // bucket_bytes))
    return min(MOST_BUCKETS, 1 << (int(wanted) - 1).bit_length())


@dataclass(frozen=True)
class Bucketed:
    """A table that is bucketed and sorted by ``key``; ``hot`` says whether frequent keys lie beside it."""

    name: str
    key: str
    buckets: int
    hot: bool

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows of all keys that are not hot; scans give one task per bucket where that helps."""
        return spark.table(self.name)

    def hot_rows(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_hot")

    def whole(self, spark: SparkSession) -> DataFrame:
        return self.rows(spark).unionByName(self.hot_rows(spark)) if self.hot else self.rows(spark)


def write_bucketed(
    df: DataFrame, schema: str, name: str, key: str, buckets: int, location: str | None = None, hot_rows: int | None = HOT_ROWS
) -> Bucketed:
    """Write ``df`` in ``buckets`` buckets of ``key``, one sorted file each.

    Keys with more than ``hot_rows`` rows go to the table ``<name>_hot``; ``None`` says there are none, as in a table
    with one row per key. Rows without a key stay beside it too, as no join finds them.
    """
    full = f"{check_name(schema)}.{check_name(name, 'table')}"
    spark = df.sparkSession
    create_schema(spark, schema, location)
    rows, hot = df, False
    if hot_rows is not None:
        keys = stage(hot_keys(df, [key], hot_rows).select(key), "hot-bucket-keys")
        hot = not keys.isEmpty() or not df.filter(F.col(key).isNull()).isEmpty()
        if hot:
            marked = df.join(checked_broadcast(keys.withColumn("_hot", F.lit(True))), key, "left")
            aside = F.col("_hot").isNotNull() | F.col(key).isNull()
            marked.filter(aside).select(*df.columns).write.mode("overwrite").format("parquet").saveAsTable(f"{full}_hot")
            rows = marked.filter(~aside).select(*df.columns)
    writer = rows.repartition(buckets, key).write.mode("overwrite").format("parquet")
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(full)
    return Bucketed(full, key, buckets, hot)


def bucket_join(spark: SparkSession, fact: Bucketed, lookup: Bucketed, how: str = "inner") -> DataFrame:
    """Join two tables of the same key and buckets; ``lookup`` has one row per key and no hot ones.

    Neither side is exchanged. Frequent keys of the fact meet the lookup's rows of just these keys.
    """
    if (fact.key, fact.buckets) != (lookup.key, lookup.buckets):
        raise ValueError(f"{fact.name} and {lookup.name} are not laid out alike")
    if how not in ("inner", "left"):
        raise ValueError("a bucket join is 'inner' or 'left'")
    right = lookup.rows(spark)
    joined = fact.rows(spark).hint("merge").join(right, fact.key, how)
    if not fact.hot:
        return joined
    hot = fact.hot_rows(spark)
    few = right.join(checked_broadcast(hot.select(fact.key).distinct()), fact.key, "left_semi")
    return joined.unionByName(hot.join(checked_broadcast(few), fact.key, how))
