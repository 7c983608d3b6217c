"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.text import _col

# How the text of a number starts, and forms that a cast accepts
# although they are no numbers here ('12d', '12f', '0x1p3').
NUMBER_START = r"(?i)\A[\s\x1c-\x1f]*[+-]?(\.?\d|inf)"
CAST_ONLY_FORM = r"(?i)[\d.][df]|x"


def to_numeric(c: Column | str) -> Column:
    """Text to double; anything that is not a number gives null, never an error.

    Most bad texts fail on their first character, before the costly failed cast.
    """
    text = _col(c)
    number = text.try_cast("double")
    endless = number.isin(float("inf"), float("-inf")) & ~text.rlike(r"(?i)inf")  # beyond a double
    return F.when(
        text.rlike(NUMBER_START) & number.isNotNull() & ~text.rlike(CAST_ONLY_FORM) & ~endless, number
    )


def to_long(c: Column | str) -> Column:
    """Text to bigint; anything but an integer that fits gives null."""
    return _col(c).try_cast("bigint")


def nan_to_null(c: Column | str) -> Column:
    """NaN is larger than every number in Spark, so filters must see null instead."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Make the columns double with bad text and NaN as null, whatever type they arrive in."""
    new = {}
    for name in columns:
        kind = df.schema[name].dataType
        if isinstance(kind, T.StringType):
            new[name] = to_numeric(name)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            new[name] = nan_to_null(F.col(name).cast("double"))
        else:
            new[name] = F.col(name).cast("double")
    return df.withColumns(new)


def clip(c: Column | str, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null (``least``/``greatest`` alone would skip it)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def ordered_pair(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """The two values as (smaller, larger)."""
    return F.least(_col(a), _col(b)), F.greatest(_col(a), _col(b))
