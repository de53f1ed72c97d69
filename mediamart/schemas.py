"""Feed schemas and the null-fill specification of the staging step.

Each feed is described once, as data: the staged column name, the raw column
it comes from, its Spark type and the value a null becomes. One staging
function (``operators.staging.stage``) serves all four feeds from this spec.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Event times are UTC wall clock; the session zone is pinned to UTC, so a
# TIMESTAMP_NTZ column and a zoned TIMESTAMP hold the same instant.
EVENT_TS_TYPE = T.TimestampNTZType()

S = T.StringType()
D = T.DoubleType()
L = T.LongType()
B = T.BooleanType()


@dataclass(frozen=True)
class Field:
    name: str            # staged name
    dtype: T.DataType    # staged type
    default: object      # what a null becomes; None = keep the null
    raw: str | None = None       # raw column name when it differs
    via_decimal: bool = False    # pass through DECIMAL(38,9) before the default

    @property
    def source(self) -> str:
        return self.raw or self.name


# The null replacements of the staging step.
NA = "NA"
NO_DURATION = -1.0
NO_COORD = 0.0
NO_USER = 0
NO_STATUS = 0
NO_REGISTRATION = 9999999999999
NO_SUCCESS = False

_TS = Field("ts", EVENT_TS_TYPE, None, raw="timestamp")
_VIDEO = Field("video", S, NA, raw="videoTitle")
_DURATION = Field("duration", D, NO_DURATION)


def _person(*, gender_first: bool) -> list[Field]:
    head = [
        Field("level", S, NA), Field("city", S, NA), Field("state", S, NA),
        Field("userAgent", S, NA), Field("lon", D, NO_COORD), Field("lat", D, NO_COORD),
        Field("userId", L, NO_USER), Field("lastName", S, NA), Field("firstName", S, NA),
    ]
    tail = ([Field("gender", S, NA), Field("dateOfBirth", S, NA)] if gender_first
            else [Field("dateOfBirth", S, NA), Field("gender", S, NA)])
    return head + tail + [Field("registration", L, NO_REGISTRATION)]


# Staged column order is the staging table's schema order; writes go by name.
FEEDS: dict[str, list[Field]] = {
    "watch_events": [_VIDEO, _DURATION, _TS, Field("auth", S, NA)] + _person(gender_first=False),
    "ad_events": [_VIDEO, Field("adType", S, NA), _DURATION, _TS, Field("auth", S, NA)]
    + _person(gender_first=False),
    "page_view_events": [_TS, Field("page", S, NA), Field("auth", S, NA), Field("method", S, NA),
                         Field("status", L, NO_STATUS)]
    + _person(gender_first=True)
    + [_VIDEO, Field("device", S, NA, raw="deviceType"), Field("os", S, NA, raw="deviceOs"), _DURATION],
    "auth_events": [_TS]
    + [f if f.name not in ("lon", "lat") else Field(f.name, D, NO_COORD, via_decimal=True)
       for f in _person(gender_first=True)]
    + [Field("device", S, NA, raw="deviceType"), Field("os", S, NA, raw="deviceOs"),
       Field("success", B, NO_SUCCESS)],
}

FEED_NAMES = list(FEEDS)

# Partition column of staging and fact tables: the event hour as yyyyMMddHH
# (the year is part of it, unlike the raw month/day/hour layout).
HOUR_COL = "ts_hour"
# Partition column next to it in hourly staging tables: the hour folder a row was
# loaded from. A re-run replaces its own folder's rows, wherever their times lie.
LOAD_COL = "load_hour"
HOUR_FORMAT = "yyyyMMddHH"


def staged_schema(feed: str, with_hour: bool = False, with_load: bool = False) -> T.StructType:
    fields = [T.StructField(f.name, f.dtype, True) for f in FEEDS[feed]]
    if with_load:
        fields.append(T.StructField(LOAD_COL, L, True))
    if with_hour:
        fields.append(T.StructField(HOUR_COL, L, True))
    return T.StructType(fields)


def raw_schema(feed: str) -> T.StructType:
    """Schema of the raw hourly Parquet files of a feed (raw names, staged types)."""
    return T.StructType([T.StructField(f.source, f.dtype, True) for f in FEEDS[feed]])


# Movie catalogue columns as consumed by the movie dimension (after header
# sanitising), with the types they are cast to.
MOVIE_COLUMNS: list[tuple[str, T.DataType]] = [
    ("movie_id", S), ("movie_name", S), ("year", L), ("certificate", S), ("runtime", S),
    ("genre", S), ("rating", D), ("description", S), ("director", S), ("director_id", S),
    ("star", S), ("star_id", S), ("votes", L), ("gross_in", D),
]
