"""Column functions: surrogate keys, calendar parts, text cleaning, safe casts.

All of them return ``pyspark.sql.Column`` expressions built from
``pyspark.sql.functions``, so they stay inside whole-stage codegen.
"""

from .keys import surrogate_key
from .calendar import sunday_week, hour_of, hour_key, day_of
from .text import clean_title, sanitize_columns, null_tokens, safe_double, safe_long, first_available

__all__ = [
    "surrogate_key", "sunday_week", "hour_of", "hour_key", "day_of",
    "clean_title", "sanitize_columns", "null_tokens", "safe_double", "safe_long", "first_available",
]
