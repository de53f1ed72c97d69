import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import T, raw_rows
from mediamart.operators import dims, facts, marts
from mediamart.operators.staging import stage
from mediamart.schemas import FEEDS
from mediamart.session import scratch_path
from mediamart.sources import files

HERE = os.path.dirname(os.path.abspath(__file__))


def seed(spark):
    return spark.createDataFrame([("S1", "State One"), ("S2", "State Two")], "stateCode string, stateName string")


def movies(spark, rows):
    cols = ["movie_id", "movie_name", "year", "certificate", "runtime", "genre", "rating", "description",
            "director", "director_id", "star", "star_id", "votes", "gross_in"]
    full = [(mid, name, 2000, "PG", "90 min", "drama", 7.0, "d", "x", "x1", "s", "s1", 10, 1.0)
            for mid, name in rows]
    return spark.createDataFrame(full, cols)


def test_all_null_event_gets_every_default(spark):
    for feed, spec in FEEDS.items():
        raw = raw_rows(spark, feed, [{"timestamp": T("2024-01-01 00:30:00")}])
        r = stage(raw, feed).first().asDict()
        for f in spec:
            if f.default is None:
                assert r[f.name] == dt.datetime(2024, 1, 1, 0, 30)
            else:
                assert r[f.name] == f.default, (feed, f.name)


def test_staged_columns_in_schema_order(spark):
    raw = raw_rows(spark, "page_view_events", [{"timestamp": T("2024-01-01 00:30:00"),
                                                "gender": "F", "dateOfBirth": "2000-01-01"}])
    r = stage(raw, "page_view_events").first()
    assert r.gender == "F" and r.dateOfBirth == "2000-01-01"
    assert list(stage(raw, "page_view_events").columns) == [f.name for f in FEEDS["page_view_events"]]


def _watch(spark, rows):
    base = {"userId": 5, "level": "free", "firstName": "F", "lastName": "L", "gender": "M",
            "videoTitle": '"m1"'}
    return stage(raw_rows(spark, "watch_events", [{**base, **r} for r in rows]), "watch_events")


def test_unknown_place_joins_the_unknown_row_twice(spark):
    w = _watch(spark, [{"timestamp": T("2024-01-01 10:00:00")}])
    loc = dims.dim_location(w, seed(spark))
    assert loc.count() == 2 and loc.select("locationKey").distinct().count() == 1
    assert dims.dim_location(w, seed(spark), dedupe_unknown=True).count() == 1


def test_unmatched_state(spark):
    w = _watch(spark, [{"timestamp": T("2024-01-01 10:00:00"), "city": "C", "state": "ZZ",
                        "lat": 1.0, "lon": 2.0}])
    loc = dims.dim_location(w, seed(spark))
    assert loc.filter("city = 'C'").first().stateCode == "NA"
    u, m, dt_ = dims.dim_users(w), dims.dim_movies(movies(spark, [("1", "m1")])), dims.dim_datetime(spark)
    f = facts.fact_streams(w, u, m, loc, dt_)
    assert f.first().locationKey is None
    assert facts.wide_streams(f, u, m, loc, dt_).count() == 0


def test_seed_dc_trailing_space(spark):
    codes = files.read_seed(spark, os.path.join(HERE, "fixtures", "state_codes_sample.csv"))
    assert codes.columns == ["stateCode", "stateName"]          # BOM dropped
    w = _watch(spark, [{"timestamp": T("2024-01-01 10:00:00"), "city": "W", "state": "DC",
                        "lat": 1.0, "lon": 2.0}])
    plain = dims.dim_location(w, codes).filter("city = 'W'").first()
    trimmed = dims.dim_location(w, codes, trim_codes=True).filter("city = 'W'").first()
    assert plain.stateName == "NA" and trimmed.stateName == "Washington DC"


def test_duplicate_title_multiplies_facts(spark):
    w = _watch(spark, [{"timestamp": T("2024-01-01 10:00:00")}])
    m = dims.dim_movies(movies(spark, [("1", "m1"), ("2", "m1")]))
    f = facts.fact_streams(w, dims.dim_users(w), m, dims.dim_location(w, seed(spark)), dims.dim_datetime(spark))
    assert f.select("videoKey").distinct().count() == 2


def test_out_of_spine_has_no_date_key(spark):
    w = _watch(spark, [{"timestamp": T("2026-03-01 10:00:00")}])
    f = facts.fact_streams(w, dims.dim_users(w), dims.dim_movies(movies(spark, [("1", "m1")])),
                           dims.dim_location(w, seed(spark)), dims.dim_datetime(spark))
    assert f.first().dateKey is None


def test_spine_edges(spark):
    d = dims.dim_datetime(spark)
    assert d.count() == 46057
    got = {r.date: r for r in d.filter(F.col("date").isin(
        T("2019-10-01 00:00:00"), T("2025-01-01 00:00:00"), T("2024-01-06 12:00:00"),
        T("2024-01-07 12:00:00"))).collect()}
    assert len(got) == 4
    sat, sun = got[T("2024-01-06 12:00:00")], got[T("2024-01-07 12:00:00")]
    assert (sat.weekOfYear, sun.weekOfYear) == (0, 1)
    assert sat.weekendFlag is True and sun.weekendFlag is False
    assert sat.dayOfWeek == 7 and sun.dayOfWeek == 1


def test_rating_ties_broken_by_title(spark):
    df = spark.createDataFrame([("z", "9"), ("c", "8"), ("b", "8"), ("a", "8"), ("n", "NaN")],
                               "movie_name string, rating string")
    assert [r.title for r in marts.top_rated(df, 2).collect()] == ["z", "a"]


def test_title_column_fallback(spark):
    df = spark.createDataFrame([("t1", "5.0")], "title string, rating string")
    assert marts.top_rated(df).first().title == "t1"


def test_multiline_csv(spark):
    df = files.conform_movies(files.read_text_csv(spark, os.path.join(HERE, "fixtures", "multiline.csv")))
    rows = df.collect()
    assert len(rows) == 1
    assert rows[0].movie_name == 'The "Long" Night' and rows[0].description == "line one\nline two"
    assert rows[0].rating == 7.5


def test_missing_genre_is_skipped(spark):
    reg = {"drama": os.path.join(HERE, "fixtures", "multiline.csv"),
           "film-noir": os.path.join(HERE, "fixtures", "absent.csv")}
    df = files.load_genres(spark, reg)
    assert [r.source_genre for r in df.collect()] == ["drama"]


def test_hour_twice_append_vs_overwrite(spark):
    from mediamart.plans.hourly import between_hours, load_hours, read_staging
    root = scratch_path(spark, "test-hours")
    raw = raw_rows(spark, "watch_events", [{"timestamp": T("2024-05-21 17:10:00"), "userId": 3},
                                           {"timestamp": T("2024-05-21 17:50:00"), "userId": 4},
                                           {"timestamp": T("2024-05-21 18:05:00"), "userId": 4}])
    files.write_raw_hours(raw, f"{root}/raw", "watch_events")
    h = T("2024-05-21 17:00:00")
    for mode, want in (("append", 4), ("overwrite", 2)):
        table = f"{root}/{mode}"
        assert load_hours(spark, f"{root}/raw", "watch_events", table, h, mode=mode)
        assert load_hours(spark, f"{root}/raw", "watch_events", table, h, mode=mode)
        assert read_staging(spark, table, "watch_events").count() == want
    missing = load_hours(spark, f"{root}/raw", "watch_events", f"{root}/x", T("2024-05-22 03:00:00"))
    assert missing is False
    t = read_staging(spark, f"{root}/overwrite", "watch_events")
    assert between_hours(t, h, h + dt.timedelta(hours=1)).count() == 2
