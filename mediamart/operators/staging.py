"""Staging: rename and null-fill one raw feed into its staged schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import hour_key
from ..schemas import FEEDS, HOUR_COL


def stage(raw: DataFrame, feed: str, with_hour: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """One projection: each staged column is ``coalesce(raw, default)``.

    Columns come out in the staging schema's order and types, selected by
    name, so a later write can never land a value in the wrong column.
    Longitude and latitude of the auth feed pass through DECIMAL(38,9)
    first, as the reference does. ``keep`` names further raw columns to carry.
    """
    exprs = []
    for f in FEEDS[feed]:
        src = F.col(f.source)
        if f.via_decimal:
            src = src.cast("decimal(38,9)")
            value = F.coalesce(src, F.lit(f.default).cast("decimal(38,9)"))
        elif f.default is None:
            value = src
        else:
            value = F.coalesce(src.cast(f.dtype), F.lit(f.default).cast(f.dtype))
        exprs.append(value.cast(f.dtype).alias(f.name))
    out = raw.select(*exprs, *keep)
    if with_hour:
        out = out.withColumn(HOUR_COL, hour_key("ts"))
    return out
