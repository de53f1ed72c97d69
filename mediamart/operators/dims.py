"""Dimensions of the star schema: date spine, location, movies, users (SCD2)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import surrogate_key, sunday_week
from .joins import bounded_broadcast
from .scd2 import CUT_ROWS, OPEN_END, change_runs, close_runs, coalesce_intervals, run_starts, timeline_cuts

# The time spine of the date dimension and the days counted as
# weekend (EXTRACT(DAYOFWEEK) numbering, 1 = Sunday ... 7 = Saturday).
SPINE_START = _dt.datetime(2019, 10, 1, 0, 0, 0)
SPINE_END = _dt.datetime(2025, 1, 1, 0, 0, 0)
WEEKEND_DAYS = (6, 7)

# The unknown members of the location and movie dimensions.
UNKNOWN = "NA"
UNKNOWN_MOVIE_ID = "NNNNNNNNNNNNNNNNNNN"

USER_KEYS = ["userId", "firstName", "lastName", "gender", "dateOfBirth"]

# Time bucket of the windows over user levels. A bucket has one summary row that is
# carried over three more exchanges, so it should hold many events of a usual user (few
# have two in an hour); a crowded one is cut by CUT_ROWS all the same.
USER_BUCKET = "month"


def spine_hours(start: _dt.datetime = SPINE_START, end: _dt.datetime = SPINE_END) -> int:
    """Rows of the hourly spine, both ends included."""
    return int((end - start).total_seconds() // 3600) + 1


def dim_datetime(spark: SparkSession, start: _dt.datetime = SPINE_START,
                 end: _dt.datetime = SPINE_END, weekend_days: Sequence[int] = WEEKEND_DAYS,
                 partitions: int | None = None) -> DataFrame:
    """Hourly date dimension from ``spark.range``: no array is ever built."""
    n = spine_hours(start, end)
    epoch0 = int(start.replace(tzinfo=_dt.timezone.utc).timestamp())
    ids = spark.range(0, n, 1, partitions) if partitions else spark.range(0, n)
    key = (F.lit(epoch0) + F.col("id") * F.lit(3600)).cast("bigint")
    d = F.timestamp_seconds(key).cast("timestamp_ntz")
    dow = F.dayofweek(d).cast("bigint")
    return ids.select(
        key.alias("dateKey"),
        d.alias("date"),
        dow.alias("dayOfWeek"),
        F.dayofmonth(d).cast("bigint").alias("dayOfMonth"),
        sunday_week(d).alias("weekOfYear"),
        F.month(d).cast("bigint").alias("month"),
        F.year(d).cast("bigint").alias("year"),
        dow.isin(list(weekend_days)).alias("weekendFlag"),
    )


def dim_location(watch: DataFrame, state_codes: DataFrame, trim_codes: bool = False,
                 dedupe_unknown: bool = False, seed_rows: int | None = None) -> DataFrame:
    """Distinct places of the watch feed, named by the seed, plus the unknown place.

    The distinct runs *before* the seed join (places are few, events are
    many, and partial aggregation shrinks each task to its distinct places),
    then once more after it, since unmatched codes all collapse to 'NA'.
    ``seed_rows``: a proven row count of the seed (e.g. of the loaded file);
    the seed is broadcast under it, else the planner decides.
    """
    places = watch.select("city", "state", "lat", "lon").distinct()
    seed = state_codes.select(
        (F.trim("stateCode") if trim_codes else F.col("stateCode")).alias("_code"),
        F.col("stateName").alias("_name"))
    named = (places.join(bounded_broadcast(seed, seed_rows), places.state == seed._code, "left")
                   .select("city",
                           F.coalesce("_code", F.lit(UNKNOWN)).alias("stateCode"),
                           F.coalesce("_name", F.lit(UNKNOWN)).alias("stateName"),
                           F.col("lat").alias("latitude"),
                           F.col("lon").alias("longitude"))
                   .distinct())
    unknown = watch.sparkSession.range(1).select(
        F.lit(UNKNOWN).alias("city"), F.lit(UNKNOWN).alias("stateCode"),
        F.lit(UNKNOWN).alias("stateName"), F.lit(0.0).alias("latitude"), F.lit(0.0).alias("longitude"))
    both = named.unionByName(unknown)
    if dedupe_unknown:
        both = both.distinct()
    return both.select(surrogate_key("latitude", "longitude", "city", "stateName").alias("locationKey"),
                       "*")


# Catalogue column, its name in the dimension, its type, the unknown movie's value.
_MOVIE_COLUMNS = [
    ("movie_id", "movieId", "string", UNKNOWN_MOVIE_ID),
    ("movie_name", "movieName", "string", UNKNOWN),
    ("year", "year", "bigint", 0),
    ("certificate", "certificate", "string", UNKNOWN),
    ("runtime", "runtime", "string", UNKNOWN),
    ("genre", "genre", "string", UNKNOWN),
    ("rating", "rating", "double", 0.0),
    ("description", "description", "string", UNKNOWN),
    ("director", "director", "string", UNKNOWN),
    ("director_id", "directorId", "string", UNKNOWN),
    ("star", "star", "string", UNKNOWN),
    ("star_id", "starId", "string", UNKNOWN),
    ("votes", "votes", "bigint", 0),
    ("gross_in", "gross", "double", 0.0),
]


def dim_movies(movies: DataFrame) -> DataFrame:
    """Catalogue renamed to camel case, plus the unknown movie; key = md5(movieId)."""
    typed = movies.select(*[F.col(src).try_cast(kind).alias(name) for src, name, kind, _ in _MOVIE_COLUMNS])
    unknown = movies.sparkSession.range(1).select(
        *[F.lit(value).cast(kind).alias(name) for _, name, kind, value in _MOVIE_COLUMNS])
    return typed.unionByName(unknown).select(surrogate_key("movieId").alias("movieKey"), "*")


def _known_users(watch: DataFrame) -> DataFrame:
    return watch.filter(F.col("userId") != 0).withColumnRenamed("ts", "date")


def user_cuts(watch: DataFrame, bucket: str = USER_BUCKET, cut_rows: int = CUT_ROWS) -> DataFrame:
    """Where crowded hours of one user are cut for the windows over user levels."""
    return timeline_cuts(_known_users(watch), USER_KEYS, "date", "level", ["registration"], bucket, cut_rows)


def user_level_changes(watch: DataFrame, bucket: str = USER_BUCKET, cuts: DataFrame | None = None) -> DataFrame:
    """Distinct user states (users other than 0) with change flag and run id.
    ``cuts`` is the written ``user_cuts`` of the feed."""
    return change_runs(_known_users(watch), USER_KEYS, order="date", value="level",
                       carry=["registration"], bucket=bucket, cuts=cuts)


def user_level_runs(watch: DataFrame, bucket: str = USER_BUCKET, cuts: DataFrame | None = None) -> DataFrame:
    """One row per level run with its first day (``minDate``)."""
    return run_starts(user_level_changes(watch, bucket, cuts), USER_KEYS, order="date", value="level",
                      carry=["registration"])


def dim_users(watch: DataFrame, unknown_ids: Sequence[int] = (0, 1), bucket: str = USER_BUCKET,
              cuts: DataFrame | None = None, coalesce_days: bool = False, one_open_row: bool = False) -> DataFrame:
    """Users with level history as SCD2 rows, plus open rows of each unknown user id.
    ``cuts`` is the written ``user_cuts`` of the feed.

    The defaults are the reference's, kept quirks included; one argument each gives
    the clean form:

    * ``unknown_ids`` (0, 1): user 1 is in both branches (D9 in SURVEY); clean (0,);
    * ``one_open_row`` False: an unknown id has one open, current row per level and
      other attributes (D10); True: one row, as its last event says;
    * ``coalesce_days`` False: changes within a day leave rows of no length, and a
      change taken back on one day repeats a userKey (D11); True: the history by
      what held at the end of each day (``coalesce_intervals``).
    """
    runs = close_runs(user_level_runs(watch, bucket, cuts), USER_KEYS, ties=["registration"])
    if coalesce_days:
        runs = coalesce_intervals(runs, USER_KEYS, ["level", "registration"], "minDate")
    tracked = runs.select(
        F.col("userId").cast("bigint").alias("userId"), "firstName", "lastName", "gender",
        "dateOfBirth", "level", F.col("registration").cast("bigint").alias("registration"),
        F.col("minDate").alias("rowActivationDate"), "rowExpirationDate", "currentRow")
    states = ["firstName", "lastName", "gender", "dateOfBirth", "level", "registration"]
    unknown = watch.filter(F.col("userId").isin(list(unknown_ids)))
    first_day = F.min("ts").cast("date").alias("rowActivationDate")
    if one_open_row:
        last = F.max(F.struct("ts", *states)).alias("_last")
        unknown = unknown.groupBy("userId").agg(last, first_day).select("userId", "_last.*", "rowActivationDate").drop("ts")
    else:
        unknown = unknown.groupBy("userId", *states).agg(first_day)
    unknown = unknown.select(
        F.col("userId").cast("bigint").alias("userId"), "firstName", "lastName", "gender", "dateOfBirth", "level",
        F.col("registration").cast("bigint").alias("registration"), "rowActivationDate",
        F.lit(OPEN_END).alias("rowExpirationDate"), F.lit(1).alias("currentRow"))
    both = tracked.unionByName(unknown)
    return both.select(surrogate_key("userId", "rowActivationDate", "level").alias("userKey"), "*")
