import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
TEXT_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents table from a list of texts or (doc_id, text, lang, source)."""
    def make(rows, extra=False):
        full = []
        for i, r in enumerate(rows):
            r = r if isinstance(r, tuple) else (i, r)
            r = r + ("en", "src0")[len(r) - 2:] if len(r) < 4 else r
            full.append(r + (None if r[1] is None else len(r[1]),))
        df = spark.createDataFrame(full, TEXT_SCHEMA)
        if extra:  # columns whose names the operators use themselves
            from pyspark.sql import functions as F
            for name in ("node", "cluster", "component", "kept", "score", "slot", "shard", "u", "v", "block", "left", "size"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")
