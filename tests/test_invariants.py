"""Invariants of the modelled tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
import __spark_entry__ as E
from mediamart.plans import catalog


def test_fact_user_keys_exist_in_dim_users(spark):
    w, u, m, loc, dt = catalog._star(spark, SF_SMALL)
    from mediamart.operators.facts import fact_streams
    f = fact_streams(w, u, m, loc, dt).filter(F.col("userKey").isNotNull())
    assert f.join(u, "userKey", "left_anti").count() == 0
    assert f.join(m.withColumnRenamed("movieKey", "videoKey"), "videoKey", "left_anti").count() == 0


def test_staging_keeps_every_input_row(spark):
    from mediamart.sources import bindings as bd
    staged = {"watch_events": "q05_stage_watch_events", "ad_events": "q06_stage_ad_events",
              "page_view_events": "q07_stage_page_view_events", "auth_events": "q08_stage_auth_events"}
    for feed, query in staged.items():
        assert E.queries()[query](spark, SF_SMALL).count() == bd.raw_feed(spark, SF_SMALL, feed).count()
