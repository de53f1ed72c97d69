"""Cut timelines against the textbook window; the as-of sweep against the plain join."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from mediamart.operators.dims import USER_KEYS
from mediamart.operators.joins import hot_keys, interval_join
from mediamart.operators.scd2 import OPEN_END, change_runs, timeline_cuts
from mediamart.session import materialize
from test_scd2 import _random_states, _window_reference

COLS = USER_KEYS + ["registration", "level", "date", "lagged", "grouped"]


def canon(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_cut_runs_equal_single_window(spark, seed):
    df = materialize(_random_states(spark, seed), "states")
    want = canon(_window_reference(df, USER_KEYS, "date", "level"), COLS)
    for bucket, cut_rows, samples in (("hour", 4, 2), ("day", 20, 4), ("year", 50, 8), ("year", 10 ** 6, 8)):
        cuts = materialize(timeline_cuts(df, USER_KEYS, "date", "level", ["registration"], bucket, cut_rows, samples), "cuts")
        assert (cuts.count() > 0) == (cut_rows < 10 ** 6)
        assert canon(change_runs(df, USER_KEYS, "date", "level", ["registration"], bucket, cuts=cuts), COLS) == want


def test_one_user_in_one_hour_is_cut(spark):
    """40,000 states of one user in one hour, 15,000 of them at one moment."""
    start = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    tick = F.when(F.col("id") < 15000, F.lit(7)).otherwise(F.col("id") % 3600)
    df = spark.range(40000).select(
        F.lit(3).cast("long").alias("userId"), *[F.lit("x").alias(k) for k in USER_KEYS[1:]], F.col("id").alias("registration"),
        F.when(F.xxhash64("id") % 3 == 0, "paid").otherwise("free").alias("level"),
        (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), tick.cast("decimal(18,6)"))).alias("date"))
    df = materialize(df, "crowded")
    cuts = materialize(timeline_cuts(df, USER_KEYS, "date", "level", ["registration"], "hour", 1000, 16), "cuts")
    bounds = cuts.first()["_bounds"]
    assert 25 <= len(bounds) <= 60
    at = F.struct("date", "level", "registration")
    place = F.size(F.filter("_bounds", lambda b: b <= at))
    sizes = [r["count"] for r in df.crossJoin(cuts.select("_bounds")).groupBy(place).count().collect()]
    assert sum(sizes) == 40000 and max(sizes) <= 2500
    got = change_runs(df, USER_KEYS, "date", "level", ["registration"], cuts=cuts)
    assert canon(got, COLS) == canon(_window_reference(df, USER_KEYS, "date", "level"), COLS)


def test_rows_are_distinct_whatever_their_number(spark):
    df = _random_states(spark, 5, 200)
    many = df.unionByName(df).unionByName(df)
    assert canon(change_runs(many, USER_KEYS, "date", "level", ["registration"]), COLS) == \
        canon(change_runs(df, USER_KEYS, "date", "level", ["registration"]), COLS)


# ---------------------------------------------------------------- as-of sweep

DAY = dt.date(2020, 1, 1)


def chains(rng, users=12, entities=3):
    """Closed intervals of an entity follow each other, with gaps, empty ones and an open end."""
    rows = []
    for u in range(users):
        for e in range(rng.randrange(entities + 1)):
            at = DAY + dt.timedelta(days=rng.randrange(400))
            for i in range(rng.randrange(8)):
                end = at + dt.timedelta(days=rng.choice([0, 0, 1, 5, 300, 900]))
                rows.append((u, None if e == 2 else f"e{e}", at, end, f"{u}-{e}-{i}"))
                at = end + dt.timedelta(days=rng.choice([0, 0, 0, 40]))
            if rng.random() < 0.7:
                rows.append((u, None if e == 2 else f"e{e}", at, OPEN_END, f"{u}-{e}-open"))
    return rows


@pytest.mark.parametrize("how", ["left", "inner"])
def test_sweep_equals_the_plain_join(spark, how):
    rng = random.Random(9)
    right = spark.createDataFrame(chains(rng) + [(3, "e0", None, OPEN_END, "null start"), (None, "e0", DAY, OPEN_END, "no user")],
                                  "userId long, entity string, s date, e date, key string")
    points = [(rng.choice([3, 3, 3, rng.randrange(14)]), DAY + dt.timedelta(days=rng.randrange(-30, 3000)), i) for i in range(1500)]
    points += [(None, DAY, -1), (3, None, -2)] + points[:50]
    left = spark.createDataFrame(points, "userId long, day date, id long")
    on = (left.userId == right.userId) & (left.day >= right.s) & (left.day < right.e)
    want = canon(left.join(right, on, how).select(left.userId, left.day, left.id, right.key), ["userId", "day", "id", "key"])
    for hot in (None, hot_keys(left, ["userId", "day"], 1)):
        got = interval_join(left, right, ["userId"], "day", "s", "e", ["key"], how, hot, chain=["entity"], open_end=OPEN_END)
        assert canon(got, ["userId", "day", "id", "key"]) == want


def test_sweep_does_not_grow_with_days_times_intervals(spark):
    """100,000 intervals of one user against 5,000 points: no join makes more rows
    than there are points and intervals."""
    first = F.lit("1700-01-01").cast("date")
    right = materialize(spark.range(100_000).select(
        F.lit(1).cast("long").alias("userId"), F.lit("e").alias("entity"), F.date_add(first, F.col("id").cast("int")).alias("s"),
        F.date_add(first, (F.col("id") + 1).cast("int")).alias("e"), F.col("id").alias("key")), "many")
    left = materialize(spark.range(5000).select(F.lit(1).cast("long").alias("userId"),
                                               F.date_add(first, (F.col("id") * 19).cast("int")).alias("day"), "id"), "points")
    got = interval_join(left, right, ["userId"], "day", "s", "e", ["key"], chain=["entity"], open_end=OPEN_END)
    rows = got.collect()
    assert sorted((r.id, r.key) for r in rows) == [(i, 19 * i) for i in range(5000)]
    plan = got._jdf.queryExecution().executedPlan()
    nodes, joined = [plan], []
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            joined.append(node.metrics().apply("numOutputRows").value())
    assert joined and max(joined) <= 105_000


def test_a_usual_user_has_a_summary_row_a_month_not_one_an_hour(spark):
    from mediamart.operators import dims
    rows = [(dt.datetime(2024, 1, 1 + h // 24, h % 24), 7, "a", "b", "F", "NA", ("free", "paid")[h % 3 == 0], 1) for h in range(200)]
    w = spark.createDataFrame(rows, "ts timestamp_ntz, userId long, firstName string, lastName string, gender string, "
                                    "dateOfBirth string, level string, registration long")
    plan = dims.user_level_changes(w)._jdf.queryExecution().optimizedPlan().toString()
    assert "date_trunc(month" in plan and "date_trunc(hour" not in plan
    by_hour = dims.user_level_changes(w, "hour")
    assert sorted(map(tuple, dims.user_level_changes(w).collect())) == sorted(map(tuple, by_hour.collect()))
