"""Surrogate keys for dimension rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*cols: str | Column) -> Column:
    """md5 hex of the columns cast to text, nulls as '', joined with '-'.

    Same contract as the usual dbt surrogate key: deterministic, null-safe and
    computed per row, so it needs no shuffle and no sequence generator.
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))
