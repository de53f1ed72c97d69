"""Audits of the kept reference quirks: duplicate keys, unmatched facts, user history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .dims import UNKNOWN_MOVIE_ID
from ..functions import surrogate_key


def key_audit(dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per dimension: rows, distinct keys, rows beyond one per key."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("distinct_keys"))
          .select(F.lit(name).alias("dimension"), "rows", "distinct_keys",
                  (F.col("rows") - F.col("distinct_keys")).alias("duplicate_rows"))
        for name, (df, key) in dims.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def fact_audit(fact: DataFrame) -> DataFrame:
    """Fact rows, rows per missing key, and rows on the unknown movie."""
    unknown_movie = surrogate_key(F.lit(UNKNOWN_MOVIE_ID))
    return fact.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("userKey").isNull()).alias("null_user_key"),
        F.count_if(F.col("videoKey").isNull()).alias("null_video_key"),
        F.count_if(F.col("dateKey").isNull()).alias("null_date_key"),
        F.count_if(F.col("locationKey").isNull()).alias("null_location_key"),
        F.count_if(F.col("videoKey") == unknown_movie).alias("unknown_movie_rows"),
    )


def user_history_audit(dim_users: DataFrame) -> DataFrame:
    """Per user-id class (unknown ids vs tracked users): rows, current rows,
    zero-length rows, and rows whose userKey repeats within the class."""
    cls = F.when(F.col("userId").isin(0, 1), F.lit("unknown_ids")).otherwise(F.lit("tracked"))
    per_key = dim_users.groupBy(cls.alias("users"), "userKey").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("currentRow") == 1).alias("_current"),
        F.count_if(F.col("rowActivationDate") == F.col("rowExpirationDate")).alias("_empty"))
    return per_key.groupBy("users").agg(
        F.sum("_n").alias("rows"), F.sum("_current").alias("current_rows"), F.sum("_empty").alias("zero_length_rows"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).cast("bigint").alias("rows_sharing_key"))
