"""Column expressions: coercion, text and date helpers. All run inside the JVM."""

from starmill.functions.dates import as_date, date_parts, day_range, weekday_text
from starmill.functions.numbers import clip, coerce_numeric, nan_to_null, ordered_pair, to_long, to_numeric
from starmill.functions.text import first_token, null_out, strip_ws

__all__ = [
    "as_date", "clip", "coerce_numeric", "date_parts", "day_range", "first_token", "nan_to_null",
    "null_out", "ordered_pair", "strip_ws", "to_long", "to_numeric", "weekday_text",
]
