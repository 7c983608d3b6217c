"""Constraint checks as jobs. Each returns the violations as a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions import to_numeric
from starmill.schemas import Table


class ConstraintError(ValueError):
    """A declared constraint does not hold."""


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def _per_column(df: DataFrame, counts: Mapping, name: str) -> DataFrame:
    """One pass over the frame, then one row per column."""
    one = df.agg(*[expr.cast("bigint").alias(c) for c, expr in counts.items()])
    return one.unpivot([], list(counts), "column_name", name)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of nulls per column, in one pass."""
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in columns}, "n_nulls")


def check_length(df: DataFrame, lengths: Mapping[str, int]) -> DataFrame:
    """Number of texts longer than allowed per column, in one pass."""
    return _per_column(df, {c: F.count_if(F.length(c) > n) for c, n in lengths.items()}, "n_long")


def check_coercion(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of non-null texts per column that are not numbers, in one pass."""
    bad = {c: F.count_if(F.col(c).isNotNull() & to_numeric(F.col(c)).isNull()) for c in columns}
    return _per_column(df, bad, "n_bad")


def check_fk(child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None) -> DataFrame:
    """Child values without a parent, with their number of rows; nulls pass.

    Both sides are reduced to one row per value first, so a value with very many
    rows is one row by the time the sides meet.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = parent.select(F.col(parent_column or column).alias(column)).distinct()
    return values.join(parents, column, "left_anti")


def check_table(df: DataFrame, table: Table, parents: Mapping[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """All declared constraints of a table as (check_name, column_name, violations).

    ``parents`` gives the frame and key column of every table that a foreign key names; one
    that is missing there raises, so no reference goes unchecked.
    """
    absent = sorted({p for _, p in table.foreign_keys} - set(parents or {}))
    if absent:
        raise ConstraintError(f"no frame to check references to {', '.join(absent)}")

    def total(check: str, column: str, violations: DataFrame) -> DataFrame:
        counted = violations.agg(F.count(F.lit(1)).alias("violations"))
        return counted.select(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), "violations")

    def spread(check: str, counts: DataFrame, n: str) -> DataFrame:
        return counts.select(F.lit(check).alias("check_name"), "column_name", F.col(n).alias("violations"))

    parts = []
    if table.primary_key:
        parts.append(total("unique", ",".join(table.primary_key), check_unique(df, table.primary_key)))
    if table.required():
        parts.append(spread("not_null", check_not_null(df, table.required()), "n_nulls"))
    if table.lengths():
        parts.append(spread("length", check_length(df, table.lengths()), "n_long"))
    for column, parent in table.foreign_keys:
        frame, parent_column = parents[parent]
        parts.append(total("reference", column, check_fk(df, column, frame, parent_column)))
    return reduce(DataFrame.unionByName, parts)


def assert_valid(
    frames: Mapping[str, DataFrame], tables: Mapping[str, Table], others: Mapping[str, DataFrame] | None = None
) -> None:
    """Raise if any declared constraint of any given frame is violated, or cannot be checked.

    ``others`` are tables that are referred to but not checked themselves. A table is referred
    to by its key of one column.
    """
    known = {**(others or {}), **frames}
    keyed = {n: (f, tables[n].primary_key[0]) for n, f in known.items() if n in tables and len(tables[n].primary_key) == 1}
    checks = [
        check_table(frames[n], tables[n], keyed).select(F.lit(n).alias("table_name"), "*")
        for n in frames
        if n in tables
    ]
    if not checks:
        return
    broken = reduce(DataFrame.unionByName, checks).filter(F.col("violations") > 0)
    rows = broken.collect()  # at most one row per declared constraint
    if rows:
        raise ConstraintError("; ".join(f"{r.table_name}.{r.column_name}: {r.check_name} x{r.violations}" for r in rows))
