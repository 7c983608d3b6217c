"""Join of many rows to a table that has one row per key.

Broadcasting is decided by the measured size of that table. Beyond the limit the
join shuffles, and keys that hold very many rows are salted. Both ways give the
same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.sources.staging import stage

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 2_000_000

_SALT, _SALTS = "_salt", "_salts"


def measured_bytes(df: DataFrame) -> int:
    """Size of the frame: rows times fixed width plus the bytes of its text.

    Without text columns this is a plain count, answered from file footers.
    """
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    sizes = [F.count(F.lit(1)).alias("n")]
    sizes += [F.sum(F.octet_length(c)).alias(f"b{i}") for i, c in enumerate(text)]
    row = df.agg(*sizes).first()
    fixed = row["n"] * (16 + 8 * len(df.columns))
    return fixed + sum(row[f"b{i}"] or 0 for i in range(len(text)))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure the frame. Arrays, maps and structs have no such measure, so a frame with one does
    not count as small."""
    if any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in df.schema):
        return False
    return measured_bytes(df) <= max_bytes


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The frame, marked for broadcast only when its measured size allows it."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every key with more than ``hot_rows`` rows, and how many salts it needs.

    There are at most rows / ``hot_rows`` of them.
    """
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot_rows)
    return counts.select(*on, F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias(_SALTS))


def _same_key(left: DataFrame, right: DataFrame, on: list[str]) -> Column:
    cond = F.lit(True)
    for c in on:
        cond = cond & left[c].eqNullSafe(right[f"_k_{c}"])
    return cond


def _with_salts(df: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    keys = hot.select(*[F.col(c).alias(f"_k_{c}") for c in on], _SALTS)
    joined = df.join(checked_broadcast(keys), _same_key(df, keys, on), "left")
    return joined.drop(*[f"_k_{c}" for c in on])


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    skew_of: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup``, which must be unique in ``on``; ``inner`` or ``left``.

    ``skew_of`` is the frame to look for hot keys in. In a chain of lookups it is the
    unjoined fact, so the search reads one column instead of repeating earlier joins.
    """
    on = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left"):
        raise ValueError("a lookup join is 'inner' or 'left'")
    if fits_broadcast(lookup, max_bytes):
        return rows.join(F.broadcast(lookup), on, how)

    hot = stage(hot_keys(rows if skew_of is None else skew_of, on, hot_rows), "hot-keys")
    if hot.isEmpty():  # Spark would broadcast by the size of the files, which are packed
        return rows.join(lookup.hint("merge"), on, how)

    # The salt depends on row content and partition only, so a retried task
    # sends every row to the same place; copies in different files still spread.
    content = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in rows.columns])
    spread = (
        _with_salts(rows.withColumn("_h", content), on, hot)
        .withColumn(_SALT, F.coalesce(F.pmod("_h", F.col(_SALTS)), F.lit(0)).cast("int"))
        .drop("_h", _SALTS)
    )
    copies = (
        _with_salts(lookup, on, hot)
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)))
        .drop(_SALTS)
    )
    return spread.join(copies.hint("merge"), [*on, _SALT], how).drop(_SALT)
