"""Date expressions. 'Today' is always an argument, so every result can be repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from starmill.functions.text import _col


def as_date(run_date: dt.date | str | Column | None) -> Column:
    """The run date as a date column; None means the current date."""
    if run_date is None:
        return F.current_date()
    if isinstance(run_date, Column):
        return run_date.cast("date")
    return F.lit(str(run_date)).cast("date")


def weekday_text(c: Column | str, style: str = "short") -> Column:
    """``short`` is 'Mon'; ``padded`` is the full name blank-padded to nine characters."""
    if style == "short":
        return F.date_format(_col(c), "E")
    if style == "padded":
        return F.rpad(F.date_format(_col(c), "EEEE"), 9, " ")
    raise ValueError(f"weekday style must be 'short' or 'padded', not {style!r}")


def date_parts(c: Column | str, weekday_style: str = "short") -> list[Column]:
    """The calendar attributes of a date, in warehouse column order."""
    c = _col(c)
    return [
        weekday_text(c, weekday_style).alias("diasemana"),
        F.dayofmonth(c).alias("dia"),
        F.month(c).alias("mes"),
        F.quarter(c).alias("trimestre"),
        F.year(c).alias("ano"),
    ]


def day_range(first: Column | str, last: Column | str) -> Column:
    """Array of every day from first to last, both included."""
    return F.sequence(_col(first), _col(last), F.expr("interval 1 day"))
