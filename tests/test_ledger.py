"""The load ledger: every file is one run's, whatever its rows say."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import T, raw_rows
from mediamart.plans import hourly
from mediamart.plans.hourly import ledger_of, load_hours, read_staging
from mediamart.schemas import raw_schema
from mediamart.session import scratch_path
from mediamart.sources import files
from mediamart.streaming.ingest import run_feed_ingest

FEED = "watch_events"


def lay(spark, root, rows):
    """Raw files of (user, time, folder hour)."""
    raw = raw_rows(spark, FEED, [{"timestamp": t and T(t), "userId": u} for u, t, _ in rows])
    at = F.coalesce(*[F.when(F.col("userId") == u, F.lit(h)) for u, _, h in rows]).cast("timestamp_ntz")
    files.write_raw_hours(raw.withColumn("arrival", at), f"{root}/raw", FEED, arrival="arrival")


def loaded(spark, table):
    return sorted((r.userId, r.load_hour) for r in read_staging(spark, table, FEED).collect())


def run(spark, root, start, end=None, mode="append", table="out"):
    return load_hours(spark, f"{root}/raw", FEED, f"{root}/{table}", T(start), end and T(end), mode)


HOUR = "2025-03-05 10:00:00"
FIVE = [(1, "2025-03-05 10:20:00", HOUR), (2, None, HOUR), (3, "1970-01-01 00:00:00", HOUR),
        (4, "2024-12-31 08:00:00", HOUR), (5, "2023-03-05 10:10:00", HOUR)]


@pytest.mark.parametrize("order", [(2022, 2023, 2024, 2025), (2025, 2024, 2023, 2022), (2024,), (2023, 2023, 2025)])
@pytest.mark.parametrize("mode", ["overwrite", "once"])
def test_five_rows_are_loaded_once_over_any_runs(spark, order, mode):
    root = scratch_path(spark, "five")
    lay(spark, root, FIVE)
    for year in order:
        run(spark, root, f"{year}-03-05 10:00:00", mode=mode)
    assert loaded(spark, f"{root}/out") == [(u, order[0] * 1000000 + 30510) for u, _, _ in FIVE]


def test_years_that_share_a_folder_keep_apart(spark):
    root = scratch_path(spark, "years")
    lay(spark, root, [(1, "2024-05-21 17:10:00", "2024-05-21 17:00:00")])
    run(spark, root, "2024-05-21 17:00:00")
    lay(spark, root, [(2, "2025-05-21 17:20:00", "2025-05-21 17:00:00"), (3, "2024-05-21 17:20:00", "2025-05-21 17:00:00")])
    for _ in range(2):
        run(spark, root, "2025-05-01 00:00:00", "2025-06-01 00:00:00", "overwrite")
    want = [(1, 2024052117), (2, 2025052117), (3, 2025052117)]
    assert loaded(spark, f"{root}/out") == want
    run(spark, root, "2024-05-21 17:00:00", mode="overwrite")           # the first year again
    run(spark, root, "2023-01-01 00:00:00", "2026-01-01 00:00:00", "once")
    assert loaded(spark, f"{root}/out") == want
    run(spark, root, "2024-05-21 17:00:00")                            # appended again, by its own year only
    assert loaded(spark, f"{root}/out") == sorted(want + [(1, 2024052117)])


def test_rows_of_a_file_vote_in_a_range_of_years(spark):
    root = scratch_path(spark, "vote")
    lay(spark, root, [(1, "2024-02-03 05:10:00", "2024-02-03 05:00:00"), (2, "2024-02-03 04:50:00", "2024-02-03 05:00:00"),
                      (3, "2025-02-03 05:00:00", "2024-02-03 05:00:00"), (4, None, "2024-02-03 05:00:00")])
    lay(spark, root, [(5, None, "2024-02-29 05:00:00"), (6, None, "2024-03-01 00:00:00")])
    run(spark, root, "2023-01-01 00:00:00", "2026-01-01 00:00:00", "once")
    assert loaded(spark, f"{root}/out") == [(u, 2024020305) for u in (1, 2, 3, 4)] + [(5, 2024022905), (6, 2025030100)]


def test_random_runs_load_each_file_once(spark):
    rng = random.Random(1)
    root = scratch_path(spark, "random")
    rows = []
    for u in range(1, 25):
        hour = f"2024-03-{rng.randrange(1, 4):02}"
        time = rng.choice([None, "1970-01-01 00:00:00", f"{hour} 05:00:00", "2031-01-01 00:00:00"])
        rows.append((u, time, f"{hour} {rng.randrange(3):02}:00:00"))
    for part in (rows[:8], rows[8:16], rows[16:]):
        lay(spark, root, part)
        for _ in range(3):
            start = T(f"{rng.choice([2023, 2024, 2025])}-03-0{rng.randrange(1, 4)} 0{rng.randrange(3)}:00:00")
            load_hours(spark, f"{root}/raw", FEED, f"{root}/out", start, start + rng.choice([1, 5, 30]) * (T(HOUR) - T("2025-03-05 09:00:00")),
                       rng.choice(["once", "overwrite"]))
    run(spark, root, "2024-03-01 00:00:00", "2024-03-04 00:00:00", "once")
    users = [u for u, _ in loaded(spark, f"{root}/out")]
    assert users == list(range(1, 25))


@pytest.mark.parametrize("written", ["nothing", "part", "all"])
def test_a_run_that_broke_off_is_finished(spark, monkeypatch, written):
    root = scratch_path(spark, "broken")
    lay(spark, root, [(1, None, "2024-03-01 10:00:00"), (2, None, "2024-03-01 11:00:00")])
    run(spark, root, "2024-03-01 10:00:00", mode="once")
    lay(spark, root, [(3, None, "2024-03-01 10:00:00"), (4, None, "2024-03-01 11:00:00")])
    write = hourly._write

    def fails(raw, feed, table, mode):
        if written != "nothing":
            write(raw if written == "all" else raw.where("userId = 3"), feed, table, mode)
        raise OSError("lost")
    monkeypatch.setattr(hourly, "_write", fails)
    with pytest.raises(OSError):
        run(spark, root, "2024-03-01 10:00:00", "2024-03-01 12:00:00", "once")
    monkeypatch.undo()
    run(spark, root, "2024-03-02 10:00:00", mode="once")                # any next run
    assert loaded(spark, f"{root}/out") == [(1, 2024030110), (2, 2024030111), (3, 2024030110), (4, 2024030111)]


def test_claims_published_by_a_broken_run_stay_single(spark, monkeypatch):
    root = scratch_path(spark, "publish")
    lay(spark, root, [(1, None, "2024-03-01 10:00:00")])
    from mediamart.sources import ledger
    monkeypatch.setattr(ledger, "delete_path", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        run(spark, root, "2024-03-01 10:00:00", mode="once")
    monkeypatch.undo()
    run(spark, root, "2024-03-01 10:00:00", mode="once")
    assert loaded(spark, f"{root}/out") == [(1, 2024030110)]
    assert ledger_of(spark, f"{root}/out").claims([(3, 1)]).count() == 1


def test_stream_replays_and_shares_the_ledger(spark):
    root = scratch_path(spark, "replay")
    lay(spark, root, FIVE[:3])
    go = lambda ckpt: run_feed_ingest(spark, f"{root}/raw", FEED, f"{root}/out", f"{root}/{ckpt}", as_of=T("2025-04-01 00:00:00"))
    go("a")
    want = [(u, 2025030510) for u in (1, 2, 3)]
    assert loaded(spark, f"{root}/out") == want
    go("b")                                                             # every batch once more
    run(spark, root, "2025-03-05 10:00:00", mode="once")                # and by the hourly load
    assert loaded(spark, f"{root}/out") == want
    lay(spark, root, FIVE[3:])
    run(spark, root, "2025-03-05 10:00:00", mode="once")
    go("a")                                                             # seen by the load already
    assert loaded(spark, f"{root}/out") == want + [(u, 2025030510) for u in (4, 5)]


def test_stream_takes_a_leap_day(spark):
    root = scratch_path(spark, "leap")
    lay(spark, root, [(1, None, "2024-02-29 10:00:00")])
    run_feed_ingest(spark, f"{root}/raw", FEED, f"{root}/out", f"{root}/c", as_of=T("2026-04-01 00:00:00"))
    assert loaded(spark, f"{root}/out") == [(1, 2024022910)]


def test_many_files_of_an_hour_share_tasks(spark):
    claims = spark.range(100).selectExpr("concat('f', id) AS _file", "2024030110L AS load_hour")
    raw = claims.selectExpr("_file", "load_hour", *[f"CAST(NULL AS string) AS {f.name}" for f in raw_schema(FEED).fields])
    spread = hourly.by_hour(raw, claims).select("_file", F.spark_partition_id().alias("p")).collect()
    assert len(spread) == 100 and 1 < len({r.p for r in spread}) <= 7


def test_a_batch_is_read_for_its_files_and_for_its_rows(spark):
    root = scratch_path(spark, "passes")
    lay(spark, root, FIVE)
    rows = files.read_folders(spark, f"{root}/raw", FEED, [f"{root}/raw/{FEED}/month=3"])
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch
    hourly.load_batch(rows.mapInArrow(counted, rows.schema), f"{root}/raw", FEED, f"{root}/out",
                      T("2025-01-01 00:00:00"), T("2025-04-01 00:00:00"))
    assert loaded(spark, f"{root}/out") == [(u, 2025030510) for u in (1, 2, 3, 4, 5)]
    assert read.value == 2 * len(FIVE)
