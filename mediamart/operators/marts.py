"""Reports over the movie catalogue: top-rated, row counts and metrics per genre."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import first_available, safe_double


def top_rated(movies: DataFrame, n: int = 100, nan_is_null: bool = True) -> DataFrame:
    """``n`` highest ratings of one catalogue table.

    title = first of ``movie_name`` / ``title`` that the table has; rating is
    a safe cast to double (bad text becomes null; NaN too unless asked not
    to). Rows without a rating are left out. Ties at the cut are broken by
    title, so the result is deterministic. Plans as ``TakeOrderedAndProject``:
    each task keeps its own top ``n``, only those reach the final merge.
    """
    src = movies.select(first_available(movies, "movie_name", "title").alias("title"),
                        safe_double(F.col("rating"), nan_is_null).alias("rating"))
    return (src.filter(F.col("rating").isNotNull())
               .orderBy(F.col("rating").desc(), F.col("title").asc_nulls_last())
               .limit(n))


def genre_row_counts(movies: DataFrame, genre_col: str = "genre") -> DataFrame:
    """Rows per genre, largest first (the loader's summary-count artefact)."""
    return (movies.groupBy(F.col(genre_col).alias("genre"))
                  .agg(F.count(F.lit(1)).alias("rows"))
                  .orderBy(F.col("rows").desc(), F.col("genre")))


def genre_metrics(movies: DataFrame, genre_col: str = "genre") -> DataFrame:
    """Per genre: movies, rated movies, mean / max / min rating, total votes and gross."""
    rating = safe_double(F.col("rating"))
    return (movies.groupBy(F.col(genre_col).alias("genre"))
                  .agg(F.count(F.lit(1)).alias("movies"),
                       F.count(rating).alias("rated_movies"),
                       F.round(F.avg(rating), 6).alias("avg_rating"),
                       F.max(rating).alias("max_rating"),
                       F.min(rating).alias("min_rating"),
                       F.sum(F.col("votes").cast("bigint")).alias("total_votes"),
                       F.round(F.sum(safe_double(F.col("gross_in"))), 2).alias("total_gross")))
