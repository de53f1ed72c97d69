"""Slowly changing dimension, type 2, by gaps and islands.

The textbook form is three windows over one partition per entity (``LAG`` for
a change flag, a running ``SUM`` for the run id, ``LEAD``/``RANK`` over runs).
A window puts every row of an entity into one task; if one entity holds a
third of all rows, that task holds a third of the data. Here the same values
are computed with the entity's timeline cut into time buckets:

* a bucket with many rows of one entity is cut further, at sampled places of its
  order, so that no (entity, bucket, cut) holds much more than CUT_ROWS rows;
* per (entity, bucket, cut): local ``LAG`` and running sum of local changes;
* carries over two levels, from summaries of one row each: over the cuts of a
  bucket (at most rows / CUT_ROWS), then over the buckets of an entity (at most
  span / bucket width): the value that closed the one before, and the number of
  changes before it;
* run id = changes before the bucket and the cut + changes at their heads + local
  running sum.

Runs then come from a grouped ``MIN`` (partial aggregation absorbs hot keys)
and the expiration date and current flag from run ``g`` and run ``g + 1``: run ids
are consecutive, so "next run" is an equi-key, not a window over the entity.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

OPEN_END = _dt.date(9999, 12, 31)


# Bucket of rows whose order value is null (they sort first, as in the window).
NULL_BUCKET = _dt.datetime(1, 1, 1)


# About as many rows of one entity and bucket go into a window partition at most;
# a cut is placed after every CUT_SAMPLES sampled rows.
CUT_ROWS = 500_000
CUT_SAMPLES = 32


def _placed(df: DataFrame, keys: Sequence[str], order: str, bucket: str) -> DataFrame:
    """``df`` with its entity as one struct ``_k`` (never null, and its null fields
    compare equal, like a window's partition) and its time bucket ``_bucket``."""
    return (df.withColumn("_k", F.struct(*keys))
              .withColumn("_bucket", F.coalesce(F.date_trunc(bucket, F.col(order)), F.lit(NULL_BUCKET))))


def timeline_cuts(df: DataFrame, keys: Sequence[str], order: str, value: str, carry: Sequence[str] = (),
                  bucket: str = "hour", cut_rows: int = CUT_ROWS, samples: int = CUT_SAMPLES) -> DataFrame:
    """(_k, _bucket, _bounds) of the buckets that hold more than about ``cut_rows``
    distinct rows of an entity: the places (order, value, carry...) to cut them at.

    Rows are sampled by a hash of their content, about ``samples`` for ``cut_rows``
    distinct ones whatever their number, and every ``samples``-th is a bound; so a
    cut holds ``cut_rows`` on average, and a moment with many rows is cut too.
    Write the table before giving it to ``change_runs``.
    """
    place = [order, value, *carry]
    every = max(1, cut_rows // samples)
    x = _placed(df.select(*keys, *place), keys, order, bucket)
    kept = x.where(F.pmod(F.xxhash64("_k", *place), F.lit(every)) == 0).select("_k", "_bucket", F.struct(*place).alias("_at")).distinct()
    listed = kept.groupBy("_k", "_bucket").agg(F.sort_array(F.collect_list("_at")).alias("_at"))
    bounds = F.filter("_at", lambda _, i: (i > 0) & (i % samples == 0))
    return listed.where(F.size("_at") > samples).select("_k", "_bucket", bounds.alias("_bounds"))


def _carry(chunks: DataFrame, within: Sequence[str], by: str, default: str | None) -> DataFrame:
    """``chunks`` (_first and _last value, _n changes inside) with the change at their
    heads and the changes before them, within a group ordered by ``by``."""
    w = Window.partitionBy(*within).orderBy(by)
    head = F.when(F.lag("_last", 1, default).over(w) != F.col("_first"), 1).otherwise(0)
    before = F.sum(F.col("_n") + F.col("_head")).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return (chunks.withColumn("_head", head).withColumn("_before", F.coalesce(before, F.lit(0)))
                  .withColumn("_lead", F.row_number().over(w) == 1))


def change_runs(df: DataFrame, keys: Sequence[str], order: str, value: str,
                carry: Sequence[str] = (), bucket: str = "hour", default: str = "NA",
                flag_col: str = "lagged", run_col: str = "grouped", cuts: DataFrame | None = None) -> DataFrame:
    """Distinct (keys, carry, value, order) rows with change flag and run id.

    Equal to
    ``flag = CASE WHEN LAG(value, 1, default) OVER w <> value THEN 1 ELSE 0 END``
    ``run  = SUM(flag) OVER w`` with ``w = PARTITION BY keys ORDER BY order, value,
    carry...``. Rows that differ in carried columns only have the same level, so at
    most the first of them is a change and they share a run id.

    ``cuts`` is the written ``timeline_cuts`` of the same rows and bucket; without
    it a bucket is one window partition.

    Rows are made distinct in each task before any is shuffled, and that shuffle is
    by whole rows, so a hot entity is spread. Hashing the distinct rows on
    (``_k``, bucket, cut) once then serves the local windows, the cut summary and
    the join back.
    """
    keys, carry = list(keys), list(carry)
    cols = keys + carry + [value, order]
    k, b, cut = "_k", "_bucket", "_cut"
    # The entity stays in the struct only, so that the windows and the summary need the
    # same columns and share one exchange.
    x = _placed(df.select(*cols).distinct(), keys, order, bucket).select(k, b, *carry, value, order)
    if cuts is None:
        x = x.withColumn(cut, F.lit(0))
    else:
        at = F.struct(order, value, *carry)
        x = (x.join(cuts, [k, b], "left")
              .withColumn(cut, F.coalesce(F.size(F.filter("_bounds", lambda bound: bound <= at)), F.lit(0))).drop("_bounds"))

    w = Window.partitionBy(k, b, cut).orderBy(order, value, *carry)
    x = (x.withColumn("_rn", F.row_number().over(w))
          .withColumn("_prev", F.lag(value, 1).over(w))
          .withColumn("_chg", F.when((F.col("_rn") > 1) & (F.col("_prev") != F.col(value)), 1)
                               .otherwise(0))
          .withColumn("_cum", F.sum("_chg").over(w)))

    order_value = F.struct(F.col(order), F.col(value))
    summary = x.groupBy(k, b, cut).agg(
        F.min_by(value, order_value).alias("_first"),
        F.max_by(value, order_value).alias("_last"),
        F.sum("_chg").alias("_n"))
    pieces = _carry(summary, [k, b], cut, None)
    whole = pieces.groupBy(k, b).agg(F.min_by("_first", cut).alias("_first"), F.max_by("_last", cut).alias("_last"),
                                     F.sum(F.col("_n") + F.col("_head")).alias("_n"))
    whole = _carry(whole, [k], b, default).select(F.col(k).alias("_wk"), F.col(b).alias("_wb"),
                                                  F.col("_head").alias("_whole_head"), F.col("_before").alias("_whole_before"))
    heads = (pieces.join(whole, (F.col(k) == F.col("_wk")) & (F.col(b) == F.col("_wb")))
                   .select(F.col(k).alias("_sk"), F.col(b).alias("_sb"), F.col(cut).alias("_sc"),
                           F.when(F.col("_lead"), F.col("_whole_head")).otherwise(F.col("_head")).alias("_at_head"),
                           (F.col("_whole_before") + F.col("_whole_head") + F.col("_before") + F.col("_head")).alias("_base")))

    j = x.join(heads, (F.col(k) == F.col("_sk")) & (F.col(b) == F.col("_sb")) & (F.col(cut) == F.col("_sc")), "inner")
    return j.select(
        *[F.col(k)[name].alias(name) for name in keys], *carry, value, order,
        (F.col("_chg") + F.when(F.col("_rn") == 1, F.col("_at_head")).otherwise(0)).cast("int").alias(flag_col),
        (F.col("_base") + F.col("_cum")).cast("bigint").alias(run_col),
    )


def run_starts(changes: DataFrame, keys: Sequence[str], order: str, value: str,
               carry: Sequence[str] = (), run_col: str = "grouped",
               start_col: str = "minDate") -> DataFrame:
    """One row per run: ``CAST(MIN(order) AS DATE)`` by keys, carry, value, run id."""
    return (changes.groupBy(*keys, *carry, value, run_col)
                   .agg(F.min(order).cast("date").alias(start_col)))


def close_runs(runs: DataFrame, keys: Sequence[str], run_col: str = "grouped",
               start_col: str = "minDate", ties: Sequence[str] = (),
               end_col: str = "rowExpirationDate", current_col: str = "currentRow") -> DataFrame:
    """Expiration = start of the next row (open end if none); current = last run.

    Rows of an entity follow each other by (run, start, ties...). A run has several
    rows when a carried attribute changes inside it: each but the last then
    ends where the next one starts, so intervals never overlap. Every row of the
    last run is current (they share its rank).

    No window holds a whole entity. Run ids are consecutive, so every row also
    emits a marker under ``run - 1``; one window per (entity, run) then holds
    the run's rows followed by the next run's, and the next row is the one after.
    """
    keys = list(keys)
    own = runs.withColumn("_k", F.struct(*keys)).withColumn("_marker", F.lit(False))
    first = (own.groupBy("_k", run_col).agg(F.min(start_col).alias(start_col), F.lit(True).alias("_marker"))
                .withColumn(run_col, F.col(run_col) - 1))
    both = own.unionByName(first, allowMissingColumns=True)
    run = Window.partitionBy("_k", run_col)
    order = run.orderBy("_marker", start_col, *ties)
    both = (both.withColumn("_next", F.lead(start_col).over(order))
                # a next row may start on a null day: presence is tracked apart
                .withColumn("_has_next", F.lead(F.lit(1), 1, 0).over(order))
                .withColumn("_last_run", ~F.bool_or("_marker").over(run))
                .filter(~F.col("_marker")))
    return both.select(
        *runs.columns,
        F.when(F.col("_has_next") == 1, F.col("_next")).otherwise(F.lit(OPEN_END)).alias(end_col),
        F.col("_last_run").cast("int").alias(current_col),
    )


def coalesce_intervals(rows: DataFrame, keys: Sequence[str], same: Sequence[str], start_col: str,
                       end_col: str = "rowExpirationDate", current_col: str = "currentRow") -> DataFrame:
    """The clean form of a day history: what held at the end of each day, once.

    ``rows`` are closed runs (each ends where the entity's next one starts). A row
    that ends on the day it starts is left out: a later one of that day replaced
    it. Rows that then follow each other with equal ``same`` columns (a change that
    was taken back) become one, from the first start to the last end. Only the
    open row of an entity is current. A row without a start stays only if nothing
    follows it.

    An entity has one row a day at most when the window sees it, so its partition
    is bounded by the days of the history, whatever the number of changes.
    """
    start, end = F.col(start_col), F.col(end_col)
    kept = rows.where((end > start) | (start.isNull() & (end == F.lit(OPEN_END)))).withColumn("_k", F.struct(*keys))
    w = Window.partitionBy("_k").orderBy(start_col)
    goes_on = F.lag(F.struct(*same)).over(w).eqNullSafe(F.struct(*same)) & (F.lag(end_col).over(w) == start)
    island = F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(w)
    merged = (kept.withColumn("_island", island).groupBy("_k", *keys, *same, "_island")
                  .agg(F.min(start_col).alias(start_col), F.max(end_col).alias(end_col)))
    return merged.select(*keys, *same, start_col, end_col, (end == F.lit(OPEN_END)).cast("int").alias(current_col))
