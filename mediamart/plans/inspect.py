"""Plan inspection helpers (used by the plan tests and for tuning)."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def operator_counts(df: DataFrame) -> dict[str, int]:
    """How often key physical operators occur in the (pre-AQE) physical plan."""
    text = explain_text(df, "simple")
    names = ["Exchange hashpartitioning", "Exchange rangepartitioning", "BroadcastExchange",
             "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
             "Window", "TakeOrderedAndProject", "FileScan parquet", "HashAggregate"]
    return {n: len(re.findall(re.escape(n), text)) for n in names}
