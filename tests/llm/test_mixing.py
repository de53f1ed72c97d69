from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from mediamart.llm import mixing, queries


def test_sql_draws_the_same(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    got = Counter((r.doc_id, r["copy"]) for r in mixing.poisson_mixture(spark.read.parquet(path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = Counter((r[0], r[5]) for r in con.execute(queries.MIXING_SQL).fetchall())
    assert got == want


def test_target_weights_and_poisson_law(spark):
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, "rare").otherwise("other").alias("source"),
        F.lit(1).alias("n_chars"))
    n = Counter(r.source for r in docs.collect())
    out = mixing.poisson_mixture(docs, weights={"hot": 1, "rare": 1, "absent": 3}, epochs=0.5).collect()
    got = Counter(r.source for r in out)
    assert set(got) == {"hot", "rare"}
    assert abs(got["hot"] - 7500) < 5 * 7500 ** 0.5 and abs(got["rare"] - 7500) < 5 * 7500 ** 0.5
    copies = Counter(r.doc_id for r in out if r.source == "rare")
    rate = 7500 / n["rare"]
    assert rate > mixing.PIECE_RATE  # drawn in pieces
    counts = np.array([copies.get(i, 0) for i in range(30_000) if i % 100 == 1 and i % 3])
    assert abs(counts.mean() - rate) < 0.9 and abs(counts.var() / rate - 1) < 0.35
    per = [r["copy"] for r in out if r.doc_id == out[0].doc_id]
    assert sorted(per) == list(range(1, len(per) + 1))


def test_layout_and_salting_do_not_matter(small_docs, monkeypatch):
    draw = lambda df: Counter((r.doc_id, r["copy"]) for r in mixing.poisson_mixture(df).collect())
    want = draw(small_docs)
    assert draw(small_docs.repartition(5)) == want
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert draw(small_docs) == want


def test_nulls_names_and_empty(documents):
    df = documents([(None, None, None, None), (1, "", "en", "s"), (1, "", "en", "s"), (2, "x", "en", None)], extra=True)
    out = mixing.poisson_mixture(df, epochs=50.0)
    assert out.columns == df.columns + ["copy"]
    got = Counter((r.doc_id, r.text) for r in out.collect())
    assert set(got) == {(None, None), (1, ""), (2, "x")} and got[1, ""] % 2 == 0
    assert mixing.poisson_mixture(documents([]).limit(0)).collect() == []
