import re

import pytest

from conftest import SF_SMALL, T
import __spark_entry__ as E
from mediamart.operators import dims
from mediamart.plans.inspect import explain_text, operator_counts
from mediamart.schemas import staged_schema
from mediamart.session import materialize, scratch_path
from mediamart.sources import bindings as bd
from mediamart.sources.sinks import cluster_by_hour, read_table, write_table
from mediamart.operators.staging import stage


@pytest.fixture(scope="module")
def staged_watch(spark):
    """The watch feed written as an hour-partitioned staging table."""
    path = scratch_path(spark, "plan-watch")
    w = stage(bd.raw_feed(spark, SF_SMALL, "watch_events"), "watch_events", with_hour=True)
    write_table(cluster_by_hour(w), path, "ts_hour")
    return read_table(spark, path, staged_schema("watch_events", with_hour=True))


LAZY = [n for n in E.queries() if n.startswith("q") and not any(k in n for k in ("q02", "q03", "q04", "q22", "q23"))]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_or_nested_loop_joins(spark, name):
    c = operator_counts(E.queries()[name](spark, SF_SMALL))
    assert c["CartesianProduct"] == 0 and c["BroadcastNestedLoopJoin"] == 0


def test_top_rated_is_take_ordered(spark):
    assert operator_counts(E.queries()["q18_top_rated"](spark, SF_SMALL))["TakeOrderedAndProject"] == 1


def test_between_hours_prunes_partitions(spark, staged_watch):
    from mediamart.plans.hourly import between_hours
    text = explain_text(between_hours(staged_watch, T("2024-01-02 00:00:00"), T("2024-01-02 06:00:00")))
    m = re.search(r"PartitionFilters: \[([^\]]*)\]", text)
    assert m and "ts_hour" in m.group(1)
    assert "PushedFilters" in text and "ts" in text


def test_location_scan_reads_four_columns(spark, staged_watch):
    text = explain_text(dims.dim_location(staged_watch, bd.state_codes(spark, SF_SMALL)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    watch_schema = [s for s in schemas if "city" in s][0]
    assert sorted(f.split(":")[0] for f in watch_schema.split(",")) == ["city", "lat", "lon", "state"]


def test_scd2_chain_makes_rows_distinct_first_and_shuffles_them_once(spark, staged_watch):
    """Rows are distinct in each task before the first shuffle; local windows, the cut
    summary and the join back then share one exchange of the distinct rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cuts = materialize(dims.user_cuts(staged_watch), "cuts")
        plans = [explain_text(dims.user_level_changes(staged_watch, cuts=c), "simple") for c in (None, cuts)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for text, places in zip(plans, (r"_k#\d+, _bucket#\d+", r"_k#\d+, _bucket#\d+, _cut#\d+")):
        rows = [m for m in re.finditer(rf"(.*)Exchange hashpartitioning\({places}, \d+\).*\n(.*)\n(.*)", text)
                if "Reused" not in m[1] and "min_by" not in m[0]]
        assert len(rows) == 1, text                                       # windows and summary share it
        assert "ReusedExchange" in text
        assert not re.search(r"Exchange hashpartitioning\(coalesce", text)
        distinct = re.findall(r"Exchange hashpartitioning\([^)]*userId#\d+L[^)]*\)[^\n]*\n[^\n]*HashAggregate", text)
        assert distinct                                                   # partial distinct below its exchange


def test_asof_join_sweeps_closed_intervals(spark):
    """Only the start of open rows is a join condition; closed ones are never held
    against days."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = explain_text(E.queries()["q15_asof_user_level"](spark, SF_SMALL), "formatted")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    conditions = re.findall(r"Join condition: ([^\n]*_start[^\n]*)", text)
    assert len(conditions) <= 1
    assert "last(_open" in text


def test_registered_fact_does_not_shuffle_the_feed_on_places(spark):
    """Places, titles and hours are counted written tables, broadcast by bytes."""
    text = explain_text(E.queries()["q16_fact_streams"](spark, SF_SMALL), "simple")
    assert re.search(r"BroadcastHashJoin \[_hour#\d+\], \[_hour#\d+\]", text)
    assert re.search(r"BroadcastHashJoin \[city#\d+", text)
    assert not re.search(r"Exchange hashpartitioning\(city#\d+", text)


def test_broadcast_bound_is_in_bytes(spark):
    from mediamart.operators.joins import bounded_broadcast, row_bytes
    df = spark.range(3).selectExpr("id", "cast(id as string) s")
    assert row_bytes(df) == 72
    assert "broadcast" in bounded_broadcast(df, 100)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in bounded_broadcast(df, 100, max_bytes=7199)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in bounded_broadcast(df, None)._jdf.queryExecution().logical().toString()


def test_nothing_stays_cached_after_the_fact(spark):
    E.queries()["q16_fact_streams"](spark, SF_SMALL).count()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0
