"""Calendar helpers over event timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import HOUR_FORMAT


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sunday_week(c: str | Column) -> Column:
    """Week of year with weeks starting on Sunday, 0-53.

    Days before the year's first Sunday are week 0 (the ``%U`` convention).
    Not ISO ``weekofyear``, which starts weeks on Monday and has no week 0.
    """
    d = _c(c)
    return F.floor((F.dayofyear(d) + F.lit(7) - F.dayofweek(d)) / F.lit(7)).cast("bigint")


def hour_of(c: str | Column) -> Column:
    """Timestamp truncated to the hour, kept as TIMESTAMP_NTZ (UTC wall clock)."""
    return F.date_trunc("hour", _c(c)).cast("timestamp_ntz")


def day_of(c: str | Column) -> Column:
    return _c(c).cast("date")


def hour_key(c: str | Column) -> Column:
    """yyyyMMddHH as a bigint: the hour partition value of staging and fact tables."""
    return F.date_format(_c(c), HOUR_FORMAT).cast("bigint")
