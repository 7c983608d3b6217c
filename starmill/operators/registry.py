"""Surrogate keys that survive a reload: a registry of natural keys and the numbers they were given.

``dense_key`` numbers a whole table anew, so a second load would orphan facts that were loaded with
the first numbers. Here a known natural key keeps its number for good, also while it is missing
from the source, and new ones get dense numbers above the largest, in their own order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.joins import lookup_join
from starmill.operators.keys import dense_key
from starmill.sources import manifest
from starmill.sources.staging import stage


def _schema(rows: DataFrame, natural_key: Sequence[str], key: str) -> str:
    return ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in natural_key] + [f"`{key}` bigint"])


def registered(spark: SparkSession, root: str, natural_key: Sequence[str], key: str, like: DataFrame) -> DataFrame:
    """The natural keys known so far and their numbers; ``like`` gives the types of the natural key."""
    return manifest.committed_frame(spark, root, _schema(like, natural_key, key))


def register(rows: DataFrame, natural_key: Sequence[str], key: str, root: str, batch: str) -> DataFrame:
    """Give every natural key of ``rows`` a number and return the whole registry below ``root``.

    Only keys that are not known are numbered and written, as a folder of their own; what was written
    before is never touched. Null is a value like others. A batch that is sent again changes nothing, also
    if the source has changed since: it is known by its name. Matching reduces both sides to one
    row per key first, so a hot key is one row.
    """
    spark, columns = rows.sparkSession, list(natural_key)
    known = registered(spark, root, columns, key, rows)
    if manifest.committed(spark, root, batch):
        return known
    asked = rows.select(*columns).distinct()
    named = known.select(*[F.col(c).alias(f"_k_{c}") for c in columns])
    same = F.lit(True)
    for c in columns:
        same = same & asked[c].eqNullSafe(named[f"_k_{c}"])
    unknown = stage(asked.join(named.hint("merge"), same, "left_anti"), f"unknown-{key}")
    if unknown.isEmpty():
        manifest.commit(spark, root, batch)
        return known
    start = known.agg(F.coalesce(F.max(key) + 1, F.lit(1)).alias("n")).first()["n"]
    folder = manifest.new_folder("keys")
    numbered = dense_key(unknown, columns, key, start=start)
    numbered.select(*columns, key).write.parquet(f"{root.rstrip('/')}/{folder}")
    manifest.commit(spark, root, batch, folder)
    return registered(spark, root, columns, key, rows)


def registry_map(source: DataFrame, registry: DataFrame, natural_key: Sequence[str], source_id: str, key: str) -> DataFrame:
    """(source id, number) of every source row; null parts of a natural key match."""
    columns = list(natural_key)
    marked = [F.struct(*[F.col(c) for c in columns]).alias("_nk")]
    rows = source.select(source_id, F.xxhash64(*columns).alias("_h"), *marked)
    lookup = registry.select(F.xxhash64(*columns).alias("_h"), *[F.col(c).alias(f"_r_{c}") for c in columns], key)
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"_nk.{c}").eqNullSafe(F.col(f"_r_{c}"))
    if len(columns) == 1:  # plain columns can be measured for a broadcast
        plain = source.select(source_id, F.col(columns[0]).alias("_c")).filter("_c IS NOT NULL")
        found = lookup_join(plain, registry.select(F.col(columns[0]).alias("_c"), key).dropna(), "_c")
        none = registry.filter(F.col(columns[0]).isNull()).select(key).agg(F.min(key)).scalar()
        nulls = source.filter(F.col(columns[0]).isNull()).select(source_id, none.alias(key)).filter(F.col(key).isNotNull())
        return found.select(source_id, key).unionByName(nulls)
    return rows.join(lookup.hint("merge"), (rows["_h"] == lookup["_h"]) & same).select(source_id, key)
