"""Dimension builders."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import as_date, date_parts, day_range
from starmill.operators.joins import lookup_join
from starmill.operators.keys import dense_key
from starmill.operators.relational import min_by_key

CALENDAR_COLUMNS = ["calendariosk", "datacompleta", "diasemana", "dia", "mes", "trimestre", "ano"]


def from_distinct(source: DataFrame, natural_key: Sequence[str], key: str) -> DataFrame:
    """Dimension with one row per distinct natural key, numbered in key order."""
    return dense_key(source.select(*natural_key).distinct(), natural_key, key)


def key_map(source: DataFrame, dim: DataFrame, natural_key: Sequence[str], source_id: str, key: str) -> DataFrame:
    """(source id, surrogate key) of every source row."""
    rows = source.select(source_id, *natural_key)
    return lookup_join(rows, dim.select(*natural_key, key), list(natural_key)).select(source_id, key)


def from_entity(source: DataFrame, source_id: str, key: str) -> DataFrame:
    """Every entity row with a surrogate key numbered by its id."""
    return dense_key(source, [source_id], key)


def with_bridge(
    entities: DataFrame,
    bridge: DataFrame,
    on: str,
    value: str,
    label: str = "Gênero Desconhecido",
) -> DataFrame:
    """Attach the smallest value of a multi-valued bridge, or the label where there is none.

    Entities and reduced bridge are both one row per key, so neither side is skewed.
    """
    smallest = min_by_key(bridge, [on], value)
    return entities.join(smallest, on, "left").withColumn(value, F.coalesce(value, F.lit(label)))


def _calendar_row(day: Column, key: Column, weekday_style: str) -> list[Column]:
    return [key.alias("calendariosk"), day.alias("datacompleta"), *date_parts(day, weekday_style)]


def calendar(
    bounds: Sequence[tuple[DataFrame, str]],
    run_date: dt.date | str | Column | None = None,
    weekday_style: str = "short",
) -> DataFrame:
    """Every day between the first and last date of the given columns.

    A source without dates contributes the run date to both bounds. Keys count the
    days, so no sort is needed.
    """
    today = as_date(run_date)
    spans = [
        df.agg(
            F.coalesce(F.min(F.col(c).cast("date")), today).alias("lo"),
            F.coalesce(F.max(F.col(c).cast("date")), today).alias("hi"),
        )
        for df, c in bounds
    ]
    span = reduce(DataFrame.unionByName, spans).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    days = span.select("lo", F.explode(day_range("lo", "hi")).alias("d"))
    key = (F.datediff("d", "lo") + 1).cast("bigint")
    return days.select(*_calendar_row(F.col("d"), key, weekday_style))


def ensure_day(
    cal: DataFrame, run_date: dt.date | str | Column | None = None, weekday_style: str = "short"
) -> DataFrame:
    """Append the run date with key max + 1 unless the calendar has it."""
    today = as_date(run_date)
    row = (
        cal.agg(F.max("calendariosk").alias("top"), F.max(F.when(F.col("datacompleta") == today, 1)).alias("seen"))
        .filter(F.col("seen").isNull())
        .select(*_calendar_row(today, (F.coalesce("top", F.lit(0)) + 1).cast("bigint"), weekday_style))
    )
    return cal.select(*CALENDAR_COLUMNS).unionByName(row)

