"""Spelling variants against a brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from mediamart.llm import queries, spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def expected_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def expected_rows(n, factor=10):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def got(df):
    return sorted(tuple(r[x] for x in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


@pytest.fixture(scope="module")
def crowded():
    """Words made of few syllables, edited over and over, with very uneven counts."""
    rng = random.Random(1)
    words = {"".join(rng.choices(["an", "na", "ba", "é", "ss", "q"], k=rng.randrange(3, 6))) for _ in range(150)}
    words |= {"a" * k for k in (7, 8, 9, 30, 31, 80, 81)} | {"b" * 3000, "b" * 2999, "b" * 1500 + "c" + "b" * 1499}
    for _ in range(3):
        for w in sorted(words):
            i = rng.randrange(len(w) + 1)
            words.add(rng.choice([w[:i] + "x" + w[i:], w[:i] + w[i + 1:], w[:i] + "n" + w[i + 1:]]))
    words = sorted(w for w in words if len(w) >= 4)
    return {w: rng.choice([2, 2, 3, 25, 300, 4000, 10 ** 12]) for w in rng.sample(words, min(700, len(words)))}


def test_forms_against_all_pairs(spark, crowded):
    words = spark.createDataFrame(list(crowded.items()) + [(None, 3)], "word string, n long").withColumn("id", F.lit("x"))
    for factor in (2, 10):
        rows = got(spelling.variant_forms(words, factor))
        assert rows == expected_rows(crowded, factor)
    assert sum(r[1] is not None for r in rows) > 100 and any(r[1] not in (None, r[2]) for r in rows)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(2)
    base = ["".join(rng.choices("abcdeé", k=rng.randrange(5, 11))) for _ in range(40)]
    rows = [(i, " ".join(rng.choice([w, w.upper(), w[:3] + "-" + w, w + "ÀÈ"]) for w in rng.choices(base, k=60)))
            for i in range(120)]
    rows += [(5, rows[7][1]), (7, rows[7][1]), (None, rows[8][1]), (900, None), (901, ""), (902, "x" * 50000 + " " + "x" * 50000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("word", "n", "key", "id", "form", "root"):  # clashing names
        docs = docs.withColumn(name, F.lit("x"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = expected_rows(expected_words(rows))
    assert got(queries.op13_spelling_variants(spark, str(tmp_path))) == want
    assert sum(r[1] is not None for r in want) > 20


def test_small_table_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    n = expected_words([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert got(queries.op13_spelling_variants(spark, "/root/testdata/sf0.001")) == expected_rows(n)


def test_pivots_are_the_best_disjoint_pair():
    rng = np.random.default_rng(3)
    weight = rng.integers(1, 30, (200, 9))
    left, right = spelling.choose_pivots(weight)
    best = [min(row[i] + row[j] for i in range(9) for j in range(i + 2, 9)) for row in weight]
    assert (right - left >= 2).all() and (weight[np.arange(200), left] + weight[np.arange(200), right] == best).all()


def test_empty_tables_and_arguments(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert got(spelling.group_spellings(docs)) == []
    one = spark.createDataFrame([(1, "spelling spelling")], docs.schema)
    assert got(spelling.group_spellings(one)) == [("spelling", None, "spelling", 2, 0, None)]
    with pytest.raises(ValueError):
        spelling.group_spellings(one, least_length=3)
    with pytest.raises(ValueError):
        spelling.variant_forms(one, factor=1)
