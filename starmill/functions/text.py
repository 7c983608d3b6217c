"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as surrounding whitespace (Unicode White_Space plus
# the four ASCII separators).
LEADING_WS = r"(?U)\A[\s\x1c-\x1f]+"
TRAILING_WS = r"(?U)[\s\x1c-\x1f]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Remove all leading and trailing whitespace; ``trim`` removes blanks only."""
    return F.regexp_replace(F.regexp_replace(_col(c), LEADING_WS, ""), TRAILING_WS, "")


def null_out(c: Column | str, marker: str | None) -> Column:
    """Turn a null marker such as ``\\N`` into null; no marker keeps the text."""
    c = _col(c)
    return c if marker is None else F.nullif(c, F.lit(marker))


def first_token(
    c: Column | str,
    sep: str = ",",
    unknown: str | None = "desconhecido",
    strip: bool = True,
    null_marker: str | None = None,
) -> Column:
    """First element of a separated list. Null gives ``unknown``, empty text stays empty."""
    token = F.substring_index(null_out(c, null_marker), sep, 1)
    if strip:
        token = strip_ws(token)
    return token if unknown is None else F.coalesce(token, F.lit(unknown))
