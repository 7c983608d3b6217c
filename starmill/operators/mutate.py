"""Update-from, delete-using and dimension roll-up as new snapshots."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.joins import checked_broadcast, lookup_join
from starmill.operators.quality import ConstraintError, check_unique


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Mapping[str, str],
    assign: Mapping[str, str],
    validate: bool = True,
    skew_of: DataFrame | None = None,
) -> DataFrame:
    """Overwrite target columns from the matching source row.

    ``on`` maps target key columns to source key columns, ``assign`` maps target
    columns to source columns. A matched row takes the new value even when it is
    null; an unmatched row keeps the old one. A column the target lacks is added.
    Source keys must be unique; ``validate`` checks that. The source is read several
    times, so pass a written one. ``skew_of`` is passed on to the lookup.
    """
    keys = list(on)
    fresh = source.select(
        *[F.col(on[k]).alias(k) for k in keys], *[F.col(s).alias(f"_new_{t}") for t, s in assign.items()]
    ).na.drop(subset=keys)
    if validate and not check_unique(fresh, keys).isEmpty():
        raise ConstraintError(f"update source has several rows for one key {keys}")
    joined = lookup_join(target, fresh.withColumn("_matched", F.lit(True)), keys, "left", skew_of=skew_of)
    matched = F.col("_matched").isNotNull()
    columns = [c for c in target.columns if c not in assign]
    new = {
        t: F.when(matched, F.col(f"_new_{t}")).otherwise(
            F.col(t) if t in target.columns else F.lit(None)
        )
        for t in assign
    }
    order = target.columns + [t for t in assign if t not in target.columns]
    return joined.select(*[F.col(c) if c in columns else new[c].alias(c) for c in order])


def delete_using(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    where: Callable[[DataFrame, DataFrame], Column] | None = None,
) -> DataFrame:
    """Rows of the target that no source row with equal keys (and ``where``) matches."""
    if where is None:
        source = source.select(*on).distinct()
    other = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns])
    cond = F.lit(True)
    for c in on:
        cond = cond & (target[c] == other[f"_s_{c}"])
    if where is not None:
        cond = cond & where(target, other)
    return target.join(checked_broadcast(other), cond, "left_anti")


def group_representative(dim: DataFrame, group: str, key: str) -> DataFrame:
    """(group, smallest key of the group)."""
    return dim.groupBy(group).agg(F.min(key).alias("keep"))


def rollup_map(dim: DataFrame, group: str, key: str) -> DataFrame:
    """Every key of the dimension with its group and the group's representative key."""
    kept = group_representative(dim, group, key)
    joined = lookup_join(dim.select(F.col(key).alias(f"{key}_original"), group), kept, group, "left")
    return joined.select(f"{key}_original", group, F.col("keep").alias(f"{key}_new"))


def shrink_dimension(dim: DataFrame, group: str, key: str) -> DataFrame:
    """One row (key, group) per group, the smallest key; finer columns go.

    Deleting all but the smallest key and dropping the other columns is one
    aggregate. Rows without a group equal no group, so all of them stay.
    """
    lone = F.when(F.col(group).isNull(), F.col(key))
    return dim.groupBy(group, lone.alias("_lone")).agg(F.min(key).alias(key)).select(key, group)
