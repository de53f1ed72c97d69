from pyspark.sql import functions as F

from conftest import T, raw_rows
from mediamart.operators.staging import stage
from mediamart.plans.hourly import load_hours, read_staging
from mediamart.schemas import FEEDS, staged_schema
from mediamart.session import scratch_path
from mediamart.sources import files
from mediamart.sources.sinks import write_hours
from mediamart.streaming.ingest import run_feed_ingest


def test_writes_go_by_name(spark):
    """A select order that differs from the table order cannot shift values."""
    raw = raw_rows(spark, "page_view_events", [{"timestamp": T("2024-01-01 03:00:00"),
                                                "gender": "F", "dateOfBirth": "1990-02-03"}])
    staged = stage(raw, "page_view_events", with_hour=True)
    shuffled = staged.select(*reversed(staged.columns))
    path = scratch_path(spark, "by-name")
    write_hours(shuffled, path, "append", staged_schema("page_view_events", with_hour=True))
    r = read_staging(spark, path, "page_view_events").first()
    assert r.gender == "F" and r.dateOfBirth == "1990-02-03"
    assert r.ts_hour == 2024010103


def test_stream_stages_each_file_once_including_late_ones(spark):
    root = scratch_path(spark, "stream-late")
    table, ckpt = f"{root}/staging", f"{root}/checkpoint"
    first = raw_rows(spark, "watch_events", [{"timestamp": T("2024-02-01 10:05:00"), "userId": 1},
                                             {"timestamp": T("2024-02-01 11:05:00"), "userId": 2}])
    files.write_raw_hours(first, f"{root}/raw", "watch_events")
    run_feed_ingest(spark, f"{root}/raw", "watch_events", table, ckpt)
    assert read_staging(spark, table, "watch_events").count() == 2
    # a late file lands in the folder of an hour that was already ingested
    late = raw_rows(spark, "watch_events", [{"timestamp": T("2024-02-01 10:59:00"), "userId": 3}])
    files.write_raw_hours(late, f"{root}/raw", "watch_events")
    run_feed_ingest(spark, f"{root}/raw", "watch_events", table, ckpt)
    out = read_staging(spark, table, "watch_events")
    assert out.count() == 3
    assert sorted(r.userId for r in out.filter(F.col("ts_hour") == 2024020110).collect()) == [1, 3]
    assert out.filter(F.col("city") != "NA").count() == 0        # null-filled on the way in
    assert [f.name for f in out.schema.fields][:len(FEEDS["watch_events"])] == \
        [f.name for f in FEEDS["watch_events"]]


def test_genre_registry_alias():
    reg = files.genre_registry("/data/imdb", ["action", "film_noir"])
    assert reg == {"action": "/data/imdb/action.csv", "film_noir": "/data/imdb/film-noir.csv"}


def _arrivals(spark):
    """Rows of three folders; one is late, one early, one has no time."""
    raw = raw_rows(spark, "watch_events", [
        {"timestamp": T("2024-03-01 10:10:00"), "userId": 1}, {"timestamp": T("2024-03-01 09:50:00"), "userId": 2},
        {"timestamp": None, "userId": 3}, {"timestamp": T("2024-03-01 12:00:00"), "userId": 4},
        {"timestamp": T("2024-03-02 10:30:00"), "userId": 5}])
    hours = {1: "2024-03-01 10:00:00", 2: "2024-03-01 10:00:00", 3: "2024-03-01 10:00:00", 4: "2024-03-01 11:00:00",
             5: "2024-03-02 10:00:00"}
    at = F.coalesce(*[F.when(F.col("userId") == k, F.lit(v)) for k, v in hours.items()]).cast("timestamp_ntz")
    return raw.withColumn("arrival", at)


def _loaded(spark, path):
    return sorted((r.userId, r.load_hour) for r in read_staging(spark, path, "watch_events").collect())


def test_every_row_of_a_folder_is_loaded(spark):
    root = scratch_path(spark, "lossless")
    files.write_raw_hours(_arrivals(spark), f"{root}/raw", "watch_events", arrival="arrival")

    def users(a, b, name, at=f"{root}/raw"):
        load_hours(spark, at, "watch_events", f"{root}/{name}", T(a), T(b))
        return _loaded(spark, f"{root}/{name}")
    first = [(1, 2024030110), (2, 2024030110), (3, 2024030110)]
    assert users("2024-03-01 10:00:00", "2024-03-01 11:00:00", "hour") == first
    day, more = ("2024-03-01 10:00:00", "2024-03-02 10:00:00"), ("2024-03-01 10:00:00", "2024-03-02 11:00:00")
    assert users(*day, "day") == first + [(4, 2024030111)]                                     # 24 hours
    want = first + [(4, 2024030111), (5, 2024030210)]
    assert users(*more, "more") == want                                                        # 25 hours
    assert users(*more, "slashes", at=f"{root}//raw/") == want
    assert users(*more, "scheme", at=f"file://{root}/raw".replace("file://file:", "file:")) == want
    assert not load_hours(spark, f"{root}/raw", "watch_events", f"{root}/none", T("2024-04-01 10:00:00"))


def test_relative_root(spark, tmp_path, monkeypatch):
    files.write_raw_hours(_arrivals(spark), f"{tmp_path}/raw", "watch_events", arrival="arrival")
    import os
    relative = os.path.relpath(f"{tmp_path}/raw", os.getcwd())
    load_hours(spark, relative, "watch_events", f"{tmp_path}/out", T("2024-03-01 00:00:00"), T("2024-03-03 00:00:00"))
    assert len(_loaded(spark, f"{tmp_path}/out")) == 5


def test_load_equals_stream_and_late_rows_replace_only_their_load(spark):
    root = scratch_path(spark, "load-stream")
    files.write_raw_hours(_arrivals(spark), f"{root}/raw", "watch_events", arrival="arrival")
    start, end = T("2024-03-01 00:00:00"), T("2024-03-03 00:00:00")
    load_hours(spark, f"{root}/raw", "watch_events", f"{root}/loaded", start, end, "overwrite")
    run_feed_ingest(spark, f"{root}/raw", "watch_events", f"{root}/streamed", f"{root}/ckpt", as_of=end)
    key = lambda df: sorted((r.userId, str(r.ts)) for r in df.collect())
    loaded = key(read_staging(spark, f"{root}/loaded", "watch_events"))
    streamed = read_staging(spark, f"{root}/streamed", "watch_events")
    assert loaded == key(streamed) and len(loaded) == 5
    assert _loaded(spark, f"{root}/loaded") == _loaded(spark, f"{root}/streamed")          # load hours too
    # hour 11 holds a row of hour 12; re-running 10 and 11 changes nothing
    for h in (10, 11):
        assert load_hours(spark, f"{root}/raw", "watch_events", f"{root}/loaded", T(f"2024-03-01 {h}:00:00"), mode="overwrite")
    assert key(read_staging(spark, f"{root}/loaded", "watch_events")) == loaded


def test_genres_of_one_header_are_one_read(spark, tmp_path):
    for name, text in (("action", "movie_id,votes\n1,204835.0\n2,\n"), ("film-noir", "movie_id,votes\n3,7\n4,7.5\n"),
                       ("war", "movie_id,title,votes\n5,T,8\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    df = files.load_genres(spark, files.genre_registry(f"{tmp_path}//", ["action", "film_noir", "war", "crime"]))
    got = sorted((r.movie_id, r.votes, r.source_genre) for r in df.collect())
    assert got == [("1", 204835, "action"), ("2", None, "action"), ("3", 7, "film_noir"), ("4", None, "film_noir"), ("5", 8, "war")]


def test_no_shared_folder_on_a_cluster_is_an_error(spark, monkeypatch):
    import pytest
    from types import SimpleNamespace as N
    from mediamart import session
    context = N(master="spark://host:7077", getConf=lambda: N(get=lambda *a: None), getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError):
        session.shared_root(N(sparkContext=context, conf=N(get=lambda *a: None)))
