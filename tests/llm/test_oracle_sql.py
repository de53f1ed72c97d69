import duckdb
import pytest

from mediamart.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", ["op1_near_duplicates", "op11_periodic_runs", "op13_spelling_variants"])
def test_rows_equal_those_of_the_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, folder).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
