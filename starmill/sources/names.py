"""Checks and normalisation of table and column names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Fixed value: characters allowed in a schema or table name.
ALLOWED_NAME = re.compile(r"[A-Za-z0-9_]+")


def check_name(name: str, what: str = "schema") -> str:
    if not ALLOWED_NAME.fullmatch(name):
        raise ValueError(f"Invalid {what} name {name!r}. Allowed: letters, numbers, underscore.")
    return name


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name, as after a ``SELECT *`` join."""
    seen: set[str] = set()
    kept = []
    for i, name in enumerate(df.columns):
        if name not in seen:
            seen.add(name)
            kept.append((i, name))
    by_position = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    return by_position.select(*[by_position[f"_{i}"].alias(name) for i, name in kept])
