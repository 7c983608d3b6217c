"""Seeded fixture rows at any scale: distinct pairs, subsets, keys, numbers, dates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.text import _col
from starmill.operators.joins import checked_broadcast, lookup_join
from starmill.operators.keys import dense_key
from starmill.sources.staging import stage

#: Rounds of the permutation; four of a good function cannot be told from a random order.
ROUNDS = 4


def permute(df: DataFrame, column: str, width: int, height: int, seed: int) -> DataFrame:
    """Put a keyed permutation of 0 to ``width * height - 1`` in the place of the column's value.

    A Feistel network over quotient and remainder: each round shifts one half by a digest of the
    other, so it can be undone, whatever the digest; no two values meet.
    """
    quotient, rest = F.call_function("div", F.col(column), F.lit(height)), F.col(column) % F.lit(height)
    for k in range(ROUNDS):
        own, other, size = (quotient, rest, width) if k % 2 == 0 else (rest, quotient, height)
        digest = F.md5(F.concat(F.lit(f"{seed}:{k}:"), other.cast("string")))
        shift = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % F.lit(size)
        moved = (own + shift) % F.lit(size)
        quotient, rest = (moved, rest) if k % 2 == 0 else (quotient, moved)
    return df.withColumn(column, quotient * F.lit(height) + rest)


def sample_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, n: int, seed: int = 0) -> DataFrame:
    """``min(n, left × right)`` distinct (left, right) id pairs, numbered from 0, in pseudo-random order.

    The product is never built: pair i is the element that a keyed permutation sends i to. The permutation
    works on a square that is hardly larger than the product; the few indices that it sends outside
    are sent on until they are inside, which keeps it a permutation.
    """
    lefts = dense_key(left.select(left_id).distinct(), [left_id], "_l", start=0)
    rights = dense_key(right.select(right_id).distinct(), [right_id], "_r", start=0)
    spark = left.sparkSession
    n_left, n_right = lefts.count(), rights.count()
    pool = n_left * n_right
    n = min(n, pool)
    if n == 0:
        schema = T.StructType([T.StructField("pair_id", T.LongType()), left.schema[left_id], right.schema[right_id]])
        return spark.createDataFrame([], schema)
    height = math.isqrt(pool - 1) + 1
    width = -(-pool // height)
    first = permute(spark.range(n).select(F.col("id").alias("pair_id"), F.col("id").alias("_at")), "_at", width, height, seed)
    inside, outside = first.filter(F.col("_at") < pool), first.filter(F.col("_at") >= pool)
    while width * height > pool and not outside.isEmpty():  # about one in ``height`` each time
        again = stage(permute(outside, "_at", width, height, seed), "walk")
        inside, outside = inside.unionByName(again.filter(F.col("_at") < pool)), again.filter(F.col("_at") >= pool)
    picks = inside.select(
        "pair_id", F.call_function("div", F.col("_at"), F.lit(n_right)).alias("_l"), (F.col("_at") % F.lit(n_right)).alias("_r")
    )
    joined = lookup_join(lookup_join(picks, lefts, "_l"), rights, "_r")
    return joined.select("pair_id", left_id, right_id)


def pick_subset(df: DataFrame, id_column: str, n: int, seed: int = 0) -> DataFrame:
    """n whole rows, chosen by a seeded hash of a unique id.

    Only ids are sorted, in key ranges, so a large n never meets in one task.
    """
    hashed = df.select(id_column, F.xxhash64(F.lit(seed), F.col(id_column)).alias("_hash"))
    picked = dense_key(hashed, ["_hash", id_column], "_n").filter(F.col("_n") <= n).select(id_column)
    return df.join(checked_broadcast(picked), id_column, "left_semi")


def pick_key(id_column: str | Column, n: int, seed: int = 0) -> Column:
    """A key from 1..n for each id."""
    return F.pmod(F.xxhash64(F.lit(seed), _col(id_column)), F.lit(n)) + 1


def uniform_int(id_column: str | Column, low: int, high: int, seed: int = 0) -> Column:
    """An integer from low..high, both included."""
    return F.pmod(F.xxhash64(F.lit(seed), _col(id_column)), F.lit(high - low + 1)) + low


def uniform_date(id_column: str | Column, first: str, last: str, seed: int = 0) -> Column:
    """A day from first..last, both included."""
    days = F.datediff(F.lit(last).cast("date"), F.lit(first).cast("date")) + 1
    shift = F.pmod(F.xxhash64(F.lit(seed), _col(id_column)), days.cast("bigint")).cast("int")
    return F.date_add(F.lit(first).cast("date"), shift)


def uniform_amount(id_column: str | Column, low: float, high: float, seed: int = 0) -> Column:
    """An amount with two decimals from low..high."""
    cents = uniform_int(id_column, round(low * 100), round(high * 100), seed)
    return F.round(cents / 100, 2)


def bridge(parents: DataFrame, id_column: str, n: int, value: Column, name: str, seed: int = 0) -> DataFrame:
    """One bridge row (value, parent id) for each of n chosen parents."""
    return pick_subset(parents.select(id_column), id_column, n, seed).select(value.alias(name), id_column)
