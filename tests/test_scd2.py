import datetime as dt
import random

from pyspark.sql import Window, functions as F

from conftest import T, raw_rows
from mediamart.operators.dims import USER_KEYS, dim_users
from mediamart.operators.scd2 import change_runs, close_runs, run_starts
from mediamart.operators.staging import stage

OPEN = dt.date(9999, 12, 31)


def watch(spark, rows):
    base = {"firstName": "F", "lastName": "L", "gender": "M"}
    return stage(raw_rows(spark, "watch_events", [{**base, **r} for r in rows]), "watch_events")


def users(spark, rows, **kw):
    return sorted(dim_users(watch(spark, rows), **kw).collect(),
                  key=lambda r: (r.userId, r.rowActivationDate, r.rowExpirationDate, r.level))


def test_level_flip_same_day(spark):
    rows = users(spark, [
        {"timestamp": T("2024-01-01 01:00:00"), "userId": 5, "level": "free"},
        {"timestamp": T("2024-01-01 05:00:00"), "userId": 5, "level": "paid"},
        {"timestamp": T("2024-01-01 09:00:00"), "userId": 5, "level": "free"}])
    assert len(rows) == 3
    assert sum(r.rowActivationDate == r.rowExpirationDate for r in rows) == 2
    free_keys = [r.userKey for r in rows if r.level == "free"]
    assert len(free_keys) == 2 and free_keys[0] == free_keys[1]
    assert sum(r.currentRow for r in rows) == 1


def test_level_flip_days(spark):
    rows = users(spark, [
        {"timestamp": T("2024-01-01 10:00:00"), "userId": 7, "level": "free"},
        {"timestamp": T("2024-01-03 10:00:00"), "userId": 7, "level": "paid"},
        {"timestamp": T("2024-01-07 10:00:00"), "userId": 7, "level": "free"}])
    spans = [(r.rowActivationDate, r.rowExpirationDate, r.currentRow) for r in rows]
    assert spans == [(dt.date(2024, 1, 1), dt.date(2024, 1, 3), 0),
                     (dt.date(2024, 1, 3), dt.date(2024, 1, 7), 0),
                     (dt.date(2024, 1, 7), OPEN, 1)]


def test_steady_level(spark):
    rows = users(spark, [{"timestamp": T(f"2024-01-0{d} 10:00:00"), "userId": 9, "level": "paid"}
                         for d in (1, 2, 3)])
    assert len(rows) == 1 and rows[0].rowExpirationDate == OPEN


def test_user_one_in_both_branches(spark):
    ev = [{"timestamp": T("2024-01-02 10:00:00"), "userId": 1, "level": "free"}]
    both = users(spark, ev)
    assert len(both) == 2 and both[0].userKey == both[1].userKey
    assert all(r.rowExpirationDate == OPEN and r.currentRow == 1 for r in both)
    assert len(users(spark, ev, unknown_ids=(0,))) == 1


def test_user_zero_two_levels(spark):
    rows = users(spark, [{"timestamp": T("2024-01-02 10:00:00"), "userId": None, "level": "free"},
                         {"timestamp": T("2024-01-05 10:00:00"), "userId": None, "level": "paid"}])
    assert len(rows) == 2 and all(r.userId == 0 and r.currentRow == 1 for r in rows)


def _window_reference(df, keys, order, value):
    """The textbook single-window form, for comparison."""
    w = Window.partitionBy(*keys).orderBy(order, value, "registration")
    x = df.select(*keys, "registration", value, order).distinct()
    x = x.withColumn("lagged", F.when(F.lag(value, 1, "NA").over(w) != F.col(value), 1).otherwise(0))
    return x.withColumn("grouped", F.sum("lagged").over(w).cast("bigint"))


def _random_states(spark, seed, n=3000):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for _ in range(n):
        # user 3 is hot: about a third of all rows
        uid = 3 if rnd.random() < 0.35 else rnd.randint(4, 40)
        ts = start + dt.timedelta(seconds=rnd.randint(0, 5 * 86400))
        lvl = rnd.choice(["free", "paid", "free", "paid", "NA"])
        first = None if uid % 7 == 0 else "F"          # null key fields group together
        if rnd.random() < 0.01:
            ts = None                                   # null times sort first
        rows.append((uid, first, "L", "M", "NA", rnd.choice([10, 20, 9999999999999]), lvl, ts))
    return spark.createDataFrame(rows, "userId long, firstName string, lastName string, gender string, "
                                       "dateOfBirth string, registration long, level string, "
                                       "date timestamp_ntz")


def test_bucketed_runs_equal_single_window(spark):
    df = _random_states(spark, 7)
    ref = _window_reference(df, USER_KEYS, "date", "level")
    cols = USER_KEYS + ["registration", "level", "date", "lagged", "grouped"]
    want = sorted((tuple(r) for r in ref.select(*cols).collect()), key=repr)
    for bucket in ("minute", "hour", "day"):
        got = change_runs(df, USER_KEYS, "date", "level", carry=["registration"], bucket=bucket)
        assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == want, bucket


def test_close_runs_equal_lead_and_rank(spark):
    df = _random_states(spark, 11)
    runs = run_starts(change_runs(df, USER_KEYS, "date", "level", carry=["registration"]),
                      USER_KEYS, "date", "level", carry=["registration"])
    w = Window.partitionBy(*USER_KEYS).orderBy("grouped", "minDate", "registration")
    ref = runs.select("*",
                      F.lead("minDate", 1, OPEN).over(w).alias("rowExpirationDate"),
                      F.when(F.rank().over(Window.partitionBy(*USER_KEYS).orderBy(F.desc("grouped"))) == 1, 1)
                       .otherwise(0).alias("currentRow"))
    got = close_runs(runs, USER_KEYS, ties=["registration"])
    cols = ref.columns
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == \
        sorted((tuple(r) for r in ref.select(*cols).collect()), key=repr)


def test_tracked_users_have_a_current_row_and_no_overlap(spark):
    from mediamart.plans.catalog import dim_users as q14
    from conftest import SF_SMALL
    rows = [r for r in q14(spark, SF_SMALL).collect() if r.userId > 1]
    by_user = {}
    for r in rows:
        by_user.setdefault(r.userId, []).append(r)
    for uid, rs in by_user.items():
        assert sum(r.currentRow for r in rs) >= 1, uid
        spans = sorted((r.rowActivationDate, r.rowExpirationDate) for r in rs
                       if r.rowActivationDate < r.rowExpirationDate)
        for (a0, a1), (b0, b1) in zip(spans, spans[1:]):
            assert a1 <= b0, uid


def test_hot_key_salting_keeps_the_rows(spark):
    """With a tiny hot threshold every busy (user, day) is salted; rows are unchanged."""
    from mediamart.operators.joins import hot_keys, interval_join
    rnd = random.Random(3)
    ev = [(3 if rnd.random() < 0.4 else rnd.randint(4, 9),
           dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 4)), i) for i in range(2000)]
    left = spark.createDataFrame(ev, "userId long, day date, id long")
    right = spark.createDataFrame(
        [(3, dt.date(2024, 1, 1), dt.date(2024, 1, 3), "a"), (3, dt.date(2024, 1, 3), OPEN, "b"),
         (3, dt.date(2024, 1, 2), dt.date(2024, 1, 4), "c"), (5, dt.date(2024, 1, 2), OPEN, "d"),
         (6, dt.date(2024, 1, 2), dt.date(2024, 1, 2), "empty")],
        "userId long, s date, e date, key string")
    args = (["userId"], "day", "s", "e", ["key"])
    plain = left.join(right, (left.userId == right.userId) & (left.day >= right.s) & (left.day < right.e),
                      "left").select(left.userId, left.day, left.id, right.key)
    want = sorted((tuple(r) for r in plain.collect()), key=repr)
    for rows in (1, 10, 10**9):   # 1: every key is hot
        hot = hot_keys(left, ["userId", "day"], rows)
        got = interval_join(left, right, *args, hot=hot).select("userId", "day", "id", "key")
        assert sorted((tuple(r) for r in got.collect()), key=repr) == want, rows


def test_equal_rows_of_a_hot_key_get_different_salts(spark):
    from mediamart.operators.joins import hot_key_join, hot_keys
    big = spark.range(1000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    small = spark.createDataFrame([(1, "x"), (2, "y")], "k int, w string")
    hot = hot_keys(big, ["k"], 100)
    assert hot.first()["_parts"] == 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = hot_key_join(big, small, ["k"], "inner", hot)
        parts = out.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in parts) == 1000 and len(parts) > 2


def test_registration_change_inside_a_run(spark):
    """The row before the change ends at the change, so events match one row."""
    from mediamart.operators.joins import interval_join
    w = watch(spark, [{"timestamp": T("2024-01-01 10:00:00"), "userId": 5, "level": "free", "registration": 10},
                      {"timestamp": T("2024-01-03 10:00:00"), "userId": 5, "level": "free", "registration": 20},
                      {"timestamp": T("2024-01-10 10:00:00"), "userId": 5, "level": "paid", "registration": 20},
                      {"timestamp": T("2024-01-12 10:00:00"), "userId": 5, "level": "paid", "registration": 30}])
    u = dim_users(w)
    spans = sorted((r.registration, r.level, r.rowActivationDate, r.rowExpirationDate, r.currentRow) for r in u.collect())
    day = lambda d: dt.date(2024, 1, d)
    assert spans == [(10, "free", day(1), day(3), 0), (20, "free", day(3), day(10), 0),
                     (20, "paid", day(10), day(12), 1), (30, "paid", day(12), OPEN, 1)]
    days = w.select("userId", F.col("ts").cast("date").alias("day"))
    assert interval_join(days, u, ["userId"], "day", "rowActivationDate", "rowExpirationDate", ["userKey"]).count() == 4
