import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mediamart.schemas import raw_schema  # noqa: E402
from mediamart.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", app="mediamart-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def raw_rows(spark, feed, rows):
    """Raw feed DataFrame from dicts; missing columns are null."""
    schema = raw_schema(feed)
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def T(s):
    return dt.datetime.fromisoformat(s)
