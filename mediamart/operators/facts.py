"""The fact table and the wide reporting view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import clean_title, day_of, hour_key, hour_of, surrogate_key
from ..schemas import HOUR_COL
from .dims import UNKNOWN, UNKNOWN_MOVIE_ID, USER_KEYS
from .scd2 import OPEN_END
from .joins import HOT_KEY_ROWS, bounded_broadcast, hot_keys, interval_join


def _days(watch: DataFrame) -> DataFrame:
    return watch.withColumn("_day", day_of("ts"))


def hot_user_days(watch: DataFrame, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """The (user, day) pairs whose events are split in the as-of join."""
    return hot_keys(_days(watch), ["userId", "_day"], hot_rows)


def join_user_asof(days: DataFrame, dim_users: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Rows with userId and ``_day`` and the userKey of that day. The closed rows of one
    user state (USER_KEYS) follow each other, so they are swept as one chain."""
    u = dim_users.select(*USER_KEYS, "userKey", "rowActivationDate", "rowExpirationDate")
    return interval_join(days, u, ["userId"], "_day", "rowActivationDate", "rowExpirationDate", take=["userKey"],
                         how="left", hot=hot, chain=USER_KEYS[1:], open_end=OPEN_END)


def fact_streams(watch: DataFrame, dim_users: DataFrame, dim_movies: DataFrame,
                 dim_location: DataFrame, dim_datetime: DataFrame,
                 movie_rows: int | None = None, location_rows: int | None = None,
                 datetime_rows: int | None = None, with_hour: bool = False,
                 hot: DataFrame | None = None, one_movie_per_title: bool = False) -> DataFrame:
    """One row per watch event and matching dimension row (left joins).

    * user: as-of join on userId and the event day in
      [rowActivationDate, rowExpirationDate) (``interval_join``);
    * movie: cleaned title = movieName; the unknown title is the unknown movie, which
      ``dim_movies`` is taken to hold once and no catalogue row to bear;
    * location: city, state code, latitude, longitude;
    * date: the event hour = the spine hour.

    ``*_rows`` are proven row bounds of the dimensions (e.g. counts of the
    written tables); a dimension is broadcast only where they fit, else the
    planner picks the strategy from its own size estimate, and AQE splits the
    skew of a hot title or place (both sides are then bare shuffles). ``hot`` is
    the written ``hot_user_days`` of the feed.

    A title that several movies bear multiplies its events, as in the reference
    (D14 in SURVEY); with ``one_movie_per_title`` the one with most votes (ties: the
    smallest id) stands for it.
    """
    w = _days(watch).select("ts", "userId", "video", "city", "state", "lat", "lon",
                     "_day", hour_of("ts").alias("_hour"),
                     clean_title("video").alias("_title"))
    x = join_user_asof(w, dim_users, hot)

    m = dim_movies.select(F.col("movieName").alias("_title"), F.col("movieKey").alias("videoKey"))
    if one_movie_per_title:
        first = F.struct((-F.coalesce("votes", F.lit(0))).alias("votes"), "movieId")
        m = (dim_movies.groupBy(F.col("movieName").alias("_title")).agg(F.min_by("movieKey", first).alias("videoKey")))
    # The unknown title, which a third of all events may bear, has one movie by its
    # making: it takes that key as a literal, and its rows are spread over the join.
    unknown = F.col("_title") == UNKNOWN
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64("ts", "userId"), F.lit(1 << 16)).cast("string"))
    x = (x.withColumn("_asked", F.when(unknown, spread).otherwise(F.col("_title")))
          .join(bounded_broadcast(m.withColumnRenamed("_title", "_asked"), movie_rows), "_asked", "left")
          .withColumn("videoKey", F.when(unknown, surrogate_key(F.lit(UNKNOWN_MOVIE_ID))).otherwise(F.col("videoKey"))))

    loc = dim_location.select(F.col("city").alias("_city"), F.col("stateCode").alias("_code"),
                              F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"),
                              "locationKey")
    loc = bounded_broadcast(loc, location_rows)
    x = x.join(loc, (x.city == loc._city) & (x.state == loc._code) & (x.lat == loc._lat)
               & (x.lon == loc._lon), "left")

    dt = dim_datetime.select(F.col("date").alias("_hour"), "dateKey")
    x = x.join(bounded_broadcast(dt, datetime_rows),
               "_hour", "left")

    out = x.select("userKey", "videoKey", "dateKey", "locationKey", "ts")
    if with_hour:
        out = out.withColumn(HOUR_COL, hour_key("ts"))
    return out


def wide_streams(fact: DataFrame, dim_users: DataFrame, dim_movies: DataFrame,
                 dim_location: DataFrame, dim_datetime: DataFrame,
                 movie_rows: int | None = None, location_rows: int | None = None,
                 datetime_rows: int | None = None, user_rows: int | None = None,
                 within: Sequence[str] = ()) -> DataFrame:
    """Fact joined (inner) to all four dimensions on their surrogate keys.

    Facts with any null key drop out; duplicated dimension keys fan out, as
    in the reference view. ``within`` are columns that all five tables share and
    that belong to every join (the slot of a bucketed star).
    """
    within = list(within)
    u = dim_users.select(*within, "userKey", "firstName", "lastName", "gender", "level", "userId",
                         F.col("currentRow").alias("currentUserRow"))
    m = dim_movies.select(*within, F.col("movieKey").alias("videoKey"), F.col("runtime").alias("videoDuration"),
                          F.col("movieName").alias("videoName"))
    loc = dim_location.select(*within, "locationKey", "city", F.col("stateName").alias("state"),
                              "latitude", "longitude")
    dt = dim_datetime.select(*within, "dateKey", F.col("date").alias("dateHour"), "dayOfMonth", "dayOfWeek")
    x = (fact.join(bounded_broadcast(u, user_rows), [*within, "userKey"], "inner")
             .join(bounded_broadcast(m, movie_rows), [*within, "videoKey"], "inner")
             .join(bounded_broadcast(loc, location_rows), [*within, "locationKey"], "inner")
             .join(bounded_broadcast(dt, datetime_rows), [*within, "dateKey"], "inner"))
    return x.select("userKey", "videoKey", "dateKey", "locationKey", F.col("ts").alias("timestamp"),
                    "firstName", "lastName", "gender", "level", "userId", "currentUserRow",
                    "videoDuration", "videoName", "city", "state", "latitude", "longitude",
                    "dateHour", "dayOfMonth", "dayOfWeek")
