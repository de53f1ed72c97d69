"""Print the physical plans of the key operators over written tables (AQE off,
so the whole static plan shows, with exchange reuse)."""
from __future__ import annotations

import datetime as dt
import re
import sys

sys.path.insert(0, ".")
from mediamart.operators import dims, facts, marts  # noqa: E402
from mediamart.plans.bucketed import wide_of_buckets, write_bucketed_star  # noqa: E402
from mediamart.plans.build import build_star  # noqa: E402
from mediamart.plans.hourly import between_hours  # noqa: E402
from mediamart.plans.inspect import explain_text  # noqa: E402
from mediamart.session import get_spark, scratch_path  # noqa: E402
from mediamart.sources import bindings as bd  # noqa: E402


def tree(df) -> str:
    keep = []
    for line in explain_text(df, "simple").splitlines():
        if not re.search(r"(Exchange|Join|Scan|Aggregate|Window|TakeOrdered|Sort |ReusedExchange|Filter)", line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r"Location: InMemoryFileIndex\([^)]*\)\[[^\]]*\]", "Location: ...", line)
        if "FileScan" in line:
            head = line[:line.index("]") + 1]
            parts = [m.group(0) for m in re.finditer(r"(PartitionFilters|PushedFilters): \[[^\]]*\]", line)]
            line = " ".join([head] + [p[:110] for p in parts])
        keep.append(line[:240])
    return "\n".join(keep)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    b = build_star(spark, bd.raw_feeds(spark, sf), bd.state_codes(spark, sf), bd.movies(spark, sf),
                   scratch_path(spark, "plans"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    w = b.table(spark, "watch_events")
    t = lambda n: b.table(spark, n)
    bounds = dict(movie_rows=t("dim_movies").count(), location_rows=t("dim_location").count(),
                  datetime_rows=t("dim_datetime").count())
    cases = {
        "SCD2 change runs (user_level_changes)": dims.user_level_changes(w, cuts=t("user_cuts")),
        "SCD2 close runs (dim_users)": dims.dim_users(w, cuts=t("user_cuts")),
        "fact_streams": facts.fact_streams(w, t("dim_users"), t("dim_movies"), t("dim_location"),
                                           t("dim_datetime"), hot=t("hot_user_days"), **bounds),
        "top_rated": marts.top_rated(bd.movies(spark, sf).filter("genre = 'action'")),
        "between_hours": between_hours(w, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 6)),
    }
    root = scratch_path(spark, "plan-buckets")
    star = write_bucketed_star(t("fact_streams").drop("ts_hour"), t("dim_users"), t("dim_movies"), t("dim_location"), t("dim_datetime"),
                               root, f"plan_{root[-12:]}", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    wide = wide_of_buckets(spark, star)
    wide.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    cases["wide view over the star in buckets, broadcasts off"] = wide
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name, df in cases.items():
        print(f"### {name}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
