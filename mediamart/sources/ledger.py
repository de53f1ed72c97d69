"""Load ledger: the hour that each raw file of a feed is loaded as.

The raw hour folders have no year, and row times may be wrong or missing, so
neither says which run a file belongs to. The ledger does: the first run that asks
for a folder claims the files in it that no run has claimed before, and they keep
that hour for good. A file therefore belongs to one hour, with all its rows, over
any set of runs, and the stream and the hourly loads can share a table.

A ledger is a folder next to the staging table:

* ``claims``: (file, load_hour), partitioned by month and day of the raw folder, so
  that a run reads the claims of its own folders only;
* ``pending``: the claims of a run at work, written before its data. One that is
  still there when the next run starts broke off: its hours are written anew.

One run of a feed at a time writes to a ledger (as one run is scheduled at a time).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import HOUR_FORMAT, LOAD_COL
from .files import delete_path, path_exists

FILE_COL = "_file"
PARTS = ("month", "day", "hour")
CLAIM_SCHEMA = T.StructType([T.StructField(FILE_COL, T.StringType()), T.StructField(LOAD_COL, T.LongType()),
                             T.StructField("month", T.IntegerType()), T.StructField("day", T.IntegerType())])


def file_key(name: Column) -> Column:
    """A raw file by its place under the feed's root, whatever the root's spelling."""
    return F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p)) for p in PARTS], name)


def folder_hours(start: _dt.datetime, end: _dt.datetime) -> Column:
    """The hours of [start, end) that a row's folder can stand for, an array: one of
    every year the range holds. Partition values only, so a filter prunes folders."""
    zero, edge = F.lit(0), lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    years = F.array(*[F.lit(y) for y in range(start.year, end.year + 1)])
    hours = F.transform(years, lambda y: F.try_make_timestamp_ntz(y, F.col("month"), F.col("day"), F.col("hour"), zero, zero))
    return F.filter(hours, lambda h: (h >= edge(start)) & (h < edge(end)))


def as_load_hour(hour: Column) -> Column:
    return F.date_format(hour, HOUR_FORMAT).cast("bigint")


def assign_hours(rows: DataFrame, start: _dt.datetime, end: _dt.datetime, latest: bool = False,
                 time_col: str = "timestamp") -> DataFrame:
    """(file, load_hour, month, day): the hour of [start, end) for every file of
    ``rows`` (file, month, day, hour and, for more than a year, the row times).

    Within a year a folder is one hour. In a longer range the ``latest`` hour is
    taken, or else the rows of a file vote for the nearest of its folder's hours;
    on a tie the earlier one, and without any time the last one, is taken. Files
    outside the range do not appear.
    """
    hours = folder_hours(start, end)
    rows = rows.withColumn("_hours", hours).where(F.size("_hours") > 0)
    keys = [FILE_COL, "month", "day", "_hours"]
    if latest or end - start <= _dt.timedelta(days=365):
        return rows.select(*keys).distinct().select(
            FILE_COL, as_load_hour(F.element_at("_hours", -1)).alias(LOAD_COL), "month", "day")
    away = F.transform("_hours", lambda h: F.struct(F.abs(F.timestamp_diff("SECOND", F.col(time_col), h)).alias("d"), h.alias("h")))
    vote = F.when(F.col(time_col).isNotNull(), F.array_min(away)["h"])
    counted = rows.groupBy(*keys, vote.alias("_vote")).agg(F.count("*").alias("_n"))
    won = counted.groupBy(*keys).agg(F.min(F.when(F.col("_vote").isNotNull(), F.struct((-F.col("_n")).alias("n"), "_vote"))).alias("_won"))
    return won.select(FILE_COL, as_load_hour(F.coalesce("_won._vote", F.element_at("_hours", -1))).alias(LOAD_COL), "month", "day")


class Ledger:
    """The ledger in the folder ``path``; empty where the folder is missing."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, part: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{part}"):
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CLAIM_SCHEMA.fields])
        return self.spark.read.schema(CLAIM_SCHEMA).parquet(f"{self.path}/{part}")

    def claims(self, days: list[tuple[int, int]]) -> DataFrame:
        """The claims on files of the given (month, day) folders."""
        return self._read("claims").where((100 * F.col("month") + F.col("day")).isin([100 * m + d for m, d in days]))

    def pending(self) -> DataFrame:
        """Claims whose data may not be written, or only in part."""
        return self._read("pending")

    def propose(self, found: DataFrame, days: list[tuple[int, int]]) -> DataFrame:
        """Write the claims of ``found`` (file, load_hour, month, day; of ``days``) on
        files that nobody has claimed; returns them as a table."""
        known = self.claims(days).select(FILE_COL)
        (found.select(*CLAIM_SCHEMA.fieldNames()).join(known, FILE_COL, "left_anti")
              .write.mode("overwrite").parquet(f"{self.path}/pending"))
        return self.pending()

    def publish(self, again: list[tuple[int, int]] | None = None) -> None:
        """The data of the pending claims is written: keep them. With ``again`` (their
        days) claims that a run which broke off has published are left out."""
        new = self.pending()
        if again is not None:
            new = new.join(self.claims(again).select(FILE_COL), FILE_COL, "left_anti")
        new.hint("rebalance", "month", "day").write.mode("append").partitionBy("month", "day").parquet(f"{self.path}/claims")
        delete_path(self.spark, f"{self.path}/pending")
