"""Sources by name and views that outlive their session."""

import pytest

from conftest import SF_SMALL, T, raw_rows
from mediamart.plans.build import build_star
from mediamart.plans.hourly import load_hours
from mediamart.plans.views import FOLDER, open_views, save_view
from mediamart.session import scratch_path
from mediamart.sources import bindings as bd, files
from mediamart.sources.registry import Sources
from mediamart.sources.sinks import write_table


def test_feeds_staging_seed_and_genres_by_name(spark, tmp_path):
    raw = raw_rows(spark, "watch_events", [{"timestamp": T("2024-03-01 10:10:00"), "userId": 4}])
    files.write_raw_hours(raw, f"{tmp_path}/raw", "watch_events")
    load_hours(spark, f"{tmp_path}/raw", "watch_events", f"{tmp_path}/staging/watch_events", T("2024-03-01 10:00:00"))
    (tmp_path / "codes.csv").write_text("stateCode,stateName\nDC ,District\n")
    for genre in ("action", "film-noir"):
        (tmp_path / f"{genre}.csv").write_text(f"movie_id,movie_name\n1,{genre}\n")
    named = (Sources().add_raw_feeds(f"{tmp_path}/raw").add_staging(f"{tmp_path}/staging").add_seed("seeds.codes", f"{tmp_path}/codes.csv")
             .add_genres(files.genre_registry(str(tmp_path), ["action", "film_noir", "war"])))
    assert named.load(spark, "raw.watch_events").first().userId == 4
    assert named.load(spark, "staging.watch_events").first().load_hour == 2024030110
    assert named.load(spark, "codes").first().stateCode == "DC "
    assert named.load(spark, "film_noir").first().movie_name == named.load(spark, "imdb.film-noir").first().movie_name == "film-noir"
    assert {r.source_genre for r in named.load(spark, "movies").collect()} == {"action", "film_noir"}
    for name in ("watch_events", "nothing"):           # two namespaces have it; none has it
        with pytest.raises(KeyError, match="raw.watch_events"):
            named.load(spark, name)
    with pytest.raises(FileNotFoundError):
        named.load(spark, "imdb.war")
    with pytest.raises(ValueError):
        named.add("plain", None)


def test_a_rebuilt_table_is_found_anew(spark):
    path = scratch_path(spark, "named")
    named = Sources().add_table("a.b", path)
    for n in (2, 3):
        write_table(spark.range(n), path)
        assert named.load(spark, "a.b").count() == n


def test_view_is_restored_in_another_session(spark):
    root = scratch_path(spark, "views")
    build_star(spark, bd.raw_feeds(spark, SF_SMALL), bd.state_codes(spark, SF_SMALL), bd.movies(spark, SF_SMALL), root)
    want = sorted(map(tuple, spark.table("wide_streams").collect()), key=repr)
    fresh = spark.newSession()
    assert not fresh.catalog.tableExists("wide_streams")
    assert open_views(fresh, root) == ["wide_streams"]
    got = fresh.table("wide_streams")
    assert sorted(map(tuple, got.collect()), key=repr) == want and len(want) > 100
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_views_of_an_empty_root_and_unknown_names(spark):
    root = scratch_path(spark, "none")
    assert open_views(spark, root) == []
    with pytest.raises(KeyError):
        save_view(spark, root, "no_such_view", {})
    assert not files.path_exists(spark, f"{root}/{FOLDER}")
