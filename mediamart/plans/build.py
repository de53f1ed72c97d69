"""Full rebuild: seed, staging, dimensions, fact, wide view, written under one root."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, types as T

from ..operators import dims, facts
from ..operators.staging import stage
from ..schemas import FEED_NAMES, HOUR_COL, staged_schema
from ..sources.sinks import by_name, cluster_by_hour, read_table, write_table
from .views import open_views, save_view


@dataclass
class Built:
    root: str
    paths: dict[str, str] = field(default_factory=dict)

    schemas: dict[str, T.StructType] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A written table, with the schema it was written with."""
        return read_table(spark, self.paths[name], self.schemas[name])


def build_star(spark: SparkSession, raw_feeds: dict[str, DataFrame], state_codes: DataFrame,
               movies: DataFrame, out_root: str, unknown_ids=(0, 1), trim_codes: bool = False,
               dedupe_unknown: bool = False, threads: int = 4) -> Built:
    """Write every model under ``out_root`` (a folder in shared storage).

    Order follows the model graph: seed and staging first, then the four
    dimensions, each written and read back before the fact. Writing the
    dimensions cuts their lineage (the fact never recomputes the SCD2 chain)
    and gives each one an exact row count, which is the size check behind
    every broadcast in the fact and the wide view.

    Models that do not depend on each other (the four staging feeds; the
    four dimensions) are submitted together from ``threads`` driver threads,
    so their jobs share the cluster and their commits overlap.
    """
    out = Built(out_root.rstrip("/"))

    def save(name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path = f"{out.root}/{name}"
        write_table(df, path, partition_by)
        out.paths[name], out.schemas[name] = path, df.schema
        return out.table(spark, name)

    seed = save("state_codes", state_codes)

    def stage_feed(feed: str) -> None:
        path = f"{out.root}/staging/{feed}"
        staged = by_name(stage(raw_feeds[feed], feed, with_hour=True), staged_schema(feed, with_hour=True))
        write_table(cluster_by_hour(staged), path, HOUR_COL)
        out.paths[feed], out.schemas[feed] = path, staged.schema

    with ThreadPoolExecutor(max_workers=threads) as pool:
        list(pool.map(stage_feed, [f for f in FEED_NAMES if f in raw_feeds]))
    watch = read_table(spark, out.paths["watch_events"], staged_schema("watch_events", with_hour=True))

    models = {
        "dim_datetime": lambda: dims.dim_datetime(spark),
        "dim_location": lambda: dims.dim_location(watch, seed, trim_codes=trim_codes,
                                                  dedupe_unknown=dedupe_unknown, seed_rows=seed.count()),
        "dim_movies": lambda: dims.dim_movies(movies),
        "dim_users": lambda: dims.dim_users(watch, unknown_ids=unknown_ids, cuts=save("user_cuts", dims.user_cuts(watch))),
    }
    with ThreadPoolExecutor(max_workers=threads) as pool:
        done = dict(zip(models, pool.map(lambda name: save(name, models[name]()), models)))
    dt, loc, mov, usr = (done[k] for k in ("dim_datetime", "dim_location", "dim_movies", "dim_users"))

    bounds = dict(movie_rows=mov.count(), location_rows=loc.count(), datetime_rows=dt.count())   # from file footers
    hot = save("hot_user_days", facts.hot_user_days(watch))
    fact = facts.fact_streams(watch, usr, mov, loc, dt, with_hour=True, hot=hot, **bounds)
    save("fact_streams", cluster_by_hour(fact), HOUR_COL)
    tables = {"fact": "fact_streams", **{name: name for name in models}}
    save_view(spark, out.root, "wide_streams", {arg: (out.paths[t][len(out.root) + 1:], out.schemas[t]) for arg, t in tables.items()},
              {**bounds, "user_rows": usr.count()})
    open_views(spark, out.root)
    return out
