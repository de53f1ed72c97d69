"""The registered queries: one callable per operator group, ``(spark, sf_dir) -> DataFrame``.

Each reads the driver's tables (through ``sources.bindings``) and runs the
library's operators over all of their rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import hour_of, sanitize_columns
from ..operators import audit, dims, facts, marts, staging
from ..schemas import FEED_NAMES, HOUR_COL
from ..session import BASE_CONF, materialize, scratch_path
from ..sources import bindings as bd
from ..sources import files
from ..sources.registry import Sources
from ..sources.sinks import write_table
from ..streaming.ingest import run_feed_ingest
from .bucketed import wide_of_buckets, write_bucketed_star
from .build import build_star
from .hourly import load_hours
from .views import open_views


def _watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged watch feed. Several models read it (user cuts and users, locations,
    the fact), so it is materialised once, as the staging table they would read."""
    return materialize(staging.stage(bd.sources(spark, sf_dir).load(spark, "raw.watch_events"), "watch_events"), "staged-watch")


def _stage(feed: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return staging.stage(bd.sources(spark, sf_dir).load(spark, f"raw.{feed}"), feed)
    run.__name__ = f"stage_{feed}"
    return run


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The location dimension with seed codes as they are and trimmed."""
    w, seed = _watch(spark, sf_dir), bd.sources(spark, sf_dir).load(spark, "state_codes")
    return reduce(DataFrame.unionByName, [
        dims.dim_location(w, seed, trim_codes=t).withColumn("trimmed", F.lit(t)) for t in (False, True)])


def dim_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine's hours that have events, with their number."""
    n = bd.table(spark, sf_dir, "events").groupBy(hour_of("ts").alias("date")).agg(F.count("*").alias("events"))
    return dims.dim_datetime(spark).join(n, "date")


def dim_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_movies(_loaded_catalogue(spark, sf_dir).drop("source_genre"))


def _cuts(w: DataFrame) -> DataFrame:
    return materialize(dims.user_cuts(w), "user-cuts")


def user_level_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _watch(spark, sf_dir)
    return dims.user_level_changes(w, cuts=_cuts(w))


def user_level_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _watch(spark, sf_dir)
    return dims.user_level_runs(w, cuts=_cuts(w))


def dim_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _watch(spark, sf_dir)
    return dims.dim_users(w, cuts=_cuts(w))


def asof_user_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _watch(spark, sf_dir)
    days = w.select("ts", "userId", F.col("ts").cast("date").alias("_day"))
    x = facts.join_user_asof(days, dims.dim_users(w, cuts=_cuts(w)), materialize(facts.hot_user_days(w), "hot-days"))
    return x.select("ts", "userId", "userKey")


def _star(spark: SparkSession, sf_dir: str):
    """Staged feed and the four dimensions, those from data as written tables."""
    w = _watch(spark, sf_dir)
    return (w, materialize(dims.dim_users(w, cuts=_cuts(w)), "dim-users"), materialize(dims.dim_movies(bd.movies(spark, sf_dir)), "dim-movies"),
            materialize(dims.dim_location(w, bd.state_codes(spark, sf_dir)), "dim-location"), dims.dim_datetime(spark))


def _bounds(u: DataFrame, m: DataFrame, loc: DataFrame) -> dict[str, int]:
    """Row counts of the written dimensions (from file footers) and the length of
    the spine, which its fixed ends give."""
    return {"movie_rows": m.count(), "location_rows": loc.count(), "datetime_rows": dims.spine_hours()}


def fact_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, u, m, loc, spine = _star(spark, sf_dir)
    hot = materialize(facts.hot_user_days(w), "hot-days")
    return facts.fact_streams(w, u, m, loc, spine, hot=hot, **_bounds(u, m, loc))


def wide_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, u, m, loc, spine = _star(spark, sf_dir)
    bounds = _bounds(u, m, loc)
    hot = materialize(facts.hot_user_days(w), "hot-days")
    fact = facts.fact_streams(w, u, m, loc, spine, hot=hot, **bounds)
    return facts.wide_streams(fact, u, m, loc, spine, user_rows=u.count(), **bounds)


def wide_streams_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide view over a star in buckets: the joins move nothing."""
    w, u, m, loc, spine = _star(spark, sf_dir)
    hot = materialize(facts.hot_user_days(w), "hot-days")
    fact = materialize(facts.fact_streams(w, u, m, loc, spine, hot=hot, **_bounds(u, m, loc)), "fact")
    root = scratch_path(spark, "buckets")
    star = write_bucketed_star(fact, u, m, loc, spine, root, f"star_{root[-12:]}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return wide_of_buckets(spark, star)


def sanitized_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bd.raw_movies(spark, sf_dir)
    return raw.toDF(*sanitize_columns(raw.columns))


MISSING_GENRE = "war"   # registered but never written: the loader must skip it


def _loaded_catalogue(spark: SparkSession, sf_dir: str, missing: str | None = None) -> DataFrame:
    """Catalogue, with two columns that the library does not know, -> one CSV folder
    per genre -> registry and loader -> Parquet by genre -> read back with the
    loader's schema."""
    root = scratch_path(spark, "genres")
    raw = bd.unlisted_columns(bd.raw_movies(spark, sf_dir))
    (raw.where(F.col("genre") != F.lit(missing or "")).withColumn("g", F.col("genre")).write.partitionBy("g")
        .option("header", True).option("escape", '"').csv(f"{root}/csv"))
    genres = ["film_noir" if g == "film-noir" else g for g in files.GENRES]   # the logical name
    named = Sources().add_genres(files.genre_registry(f"{root}/csv", genres, suffix="", prefix="g="))
    loaded = named.load(spark, "imdb.movies")
    write_table(loaded, f"{root}/parquet", partition_by="source_genre")
    return named.add_table("imdb.loaded", f"{root}/parquet", loaded.schema).load(spark, "imdb.loaded")


def csv_to_parquet_by_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded_catalogue(spark, sf_dir, MISSING_GENRE)


def _each(work: Callable[[str], None], names=FEED_NAMES) -> None:
    """Independent jobs, submitted together."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(work, names))


def _raw_years(spark: SparkSession, sf_dir: str, root: str):
    """For each of two years: all feeds' arrivals of the year are laid out as hour
    folders, next to those of the year before; yields the range they arrived in."""
    feeds = {feed: bd.arriving(raw) for feed, raw in bd.raw_feeds(spark, sf_dir).items()}
    # Two numbers: the time range to load.
    lo, hi = bd.table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    for year in (0, 1):
        span = [t.replace(year=t.year + year, minute=0, second=0, microsecond=0) for t in (lo, hi)]
        of_year = F.year("arrival") == span[0].year
        _each(lambda feed: files.write_raw_hours(feeds[feed].where(of_year), f"{root}/raw", feed, arrival="arrival"))
        yield span[0], span[1] + dt.timedelta(hours=3)


def _stacked(spark: SparkSession, staging_root: str) -> DataFrame:
    """The columns that all staged feeds share, feeds stacked."""
    named = Sources().add_staging(staging_root)
    tables = {feed: named.load(spark, f"staging.{feed}") for feed in FEED_NAMES}
    shared = [c for c in next(iter(tables.values())).columns if all(c in t.columns for t in tables.values())]
    return reduce(DataFrame.unionByName, [t.select(F.lit(feed).alias("feed"), *shared) for feed, t in tables.items()])


def _hourly(mode: str) -> Callable[[SparkSession, str], DataFrame]:
    """A backfill of all feeds year by year, the folders of both years being the
    same. ``append``: then both years once more, for files nobody has loaded.
    ``overwrite``: then some hours of the first year again, one by one."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = scratch_path(spark, f"hourly-{mode}")
        tables = {feed: f"{root}/staging/{feed}" for feed in FEED_NAMES}
        load = lambda feed, *a: load_hours(spark, f"{root}/raw", feed, tables[feed], *a)
        spans = []
        for start, end in _raw_years(spark, sf_dir, root):
            spans.append((start, end))
            _each(lambda feed: load(feed, start, end, mode))
        if mode == "append":
            load("watch_events", spans[0][0], spans[1][1], "once")
        else:
            for h in range(3):
                load("watch_events", spans[0][0] + dt.timedelta(hours=h), None, mode)
        return _stacked(spark, f"{root}/staging")
    run.__name__ = f"hourly_{mode}"
    return run


def stream_hourly_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feeds by streams, one run a year; each goes on where it stopped."""
    root = scratch_path(spark, "stream")
    tables = {feed: f"{root}/staging/{feed}" for feed in FEED_NAMES}
    for _, end in _raw_years(spark, sf_dir, root):
        _each(lambda feed: run_feed_ingest(spark, f"{root}/raw", feed, tables[feed], f"{root}/checkpoint/{feed}", as_of=end))
    return _stacked(spark, f"{root}/staging")


GENRE = "action"   # the catalogue table the top-rated report reads


def top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.top_rated(_loaded_catalogue(spark, sf_dir).filter(F.col("source_genre") == GENRE), 100)


def genre_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.genre_row_counts(bd.movies(spark, sf_dir))


def genre_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.genre_metrics(bd.movies(spark, sf_dir))


def key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, u, m, loc, spine = _star(spark, sf_dir)
    return audit.key_audit({"dim_location": (loc, "locationKey"), "dim_movies": (m, "movieKey"),
                            "dim_users": (u, "userKey"), "dim_datetime": (spine, "dateKey")})


def fact_key_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.fact_audit(fact_streams(spark, sf_dir))


def user_history_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the reference's form of the history and of the clean one."""
    w = _watch(spark, sf_dir)
    cuts = _cuts(w)
    forms = {"reference": {}, "clean": {"coalesce_days": True, "one_open_row": True}}
    return reduce(DataFrame.unionByName, [
        audit.user_history_audit(dims.dim_users(w, cuts=cuts, **how)).withColumn("form", F.lit(form)) for form, how in forms.items()])


# What full_build checks of each table it wrote: its key.
BUILT_KEYS = {"state_codes": "stateCode", "watch_events": HOUR_COL, "ad_events": HOUR_COL, "page_view_events": HOUR_COL,
              "auth_events": HOUR_COL, "dim_datetime": "dateKey", "dim_location": "locationKey",
              "dim_movies": "movieKey", "dim_users": "userKey", "fact_streams": "userKey", "wide_streams": "userKey"}


def full_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, distinct keys and rows without a key of every table that the full
    build wrote, and of the view over them, which a session of its own restores."""
    root = scratch_path(spark, "star")
    built = build_star(spark, bd.raw_feeds(spark, sf_dir), bd.state_codes(spark, sf_dir), bd.movies(spark, sf_dir), root)
    fresh = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", *BASE_CONF):
        if key.startswith("spark.sql."):
            fresh.conf.set(key, spark.conf.get(key))
    open_views(fresh, root)
    checks = [
        (fresh.table(name) if name == "wide_streams" else built.table(fresh, name)).agg(
            F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys"), F.count_if(F.col(key).isNull()).alias("null_keys"))
        .select(F.lit(name).alias("name"), "*") for name, key in BUILT_KEYS.items()]
    return reduce(DataFrame.unionByName, checks)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q01_sanitized_columns": sanitized_columns,
    "q02_csv_to_parquet_by_genre": csv_to_parquet_by_genre,
    "q03_hourly_append": _hourly("append"),
    "q04_hourly_overwrite": _hourly("overwrite"),
    "q05_stage_watch_events": _stage("watch_events"),
    "q06_stage_ad_events": _stage("ad_events"),
    "q07_stage_page_view_events": _stage("page_view_events"),
    "q08_stage_auth_events": _stage("auth_events"),
    "q09_dim_location": dim_location,
    "q10_dim_datetime": dim_datetime,
    "q11_dim_movies": dim_movies,
    "q12_user_level_changes": user_level_changes,
    "q13_user_level_runs": user_level_runs,
    "q14_dim_users": dim_users,
    "q15_asof_user_level": asof_user_level,
    "q16_fact_streams": fact_streams,
    "q17_wide_streams": wide_streams,
    "q18_top_rated": top_rated,
    "q19_genre_row_counts": genre_row_counts,
    "q20_genre_metrics": genre_metrics,
    "q21_key_audit": key_audit,
    "q22_full_build": full_build,
    "q23_stream_hourly_ingest": stream_hourly_ingest,
    "q24_fact_key_audit": fact_key_audit,
    "q25_user_history_audit": user_history_audit,
    "q26_wide_streams_bucketed": wide_streams_bucketed,
}
