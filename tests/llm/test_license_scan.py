"""Licence scan against brute force over words; expressions by hand and at random."""

import random
import re

import pytest

from mediamart.llm import license_scan, queries
from mediamart.llm.license_expression import DUTY, evaluate, postfix

# The base phrases and labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base_columns(text):
    """Every place of every phrase, tried word by word."""
    lower = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    places = [(i, label) for phrase, label in BASE.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    pieces = ["gnu", "GNU General Public License", "general", "public", "License", "license", "Apache", "Apache-License",
              "CC BY", "cc", "by", "CC-BY-NC 4.0", "MIT", "mit License", "license mit", "é", "İ", "ß", "x1", "a_b", "\x00",
              "\x7f", "SPDX-License-Identifier: MIT OR GPL-2.0", "license", "apachelicense", "cc by cc by"]
    out = [rng.choice([" ", ", ", "\n", "--", "", "\t"]).join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(300)]
    return out + [None, "", " \n", "CC BY " * 20000, "x" * 200000 + " mit license"]


def test_base_against_brute_force(spark, tmp_path, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.union(docs.where("doc_id < 5")).union(spark.createDataFrame([(None, "MIT License")], docs.schema))
    for name in ("matches", "duty", "score", "label", "n_words"):  # clashing names
        docs = docs.selectExpr("*", f"'x' AS {name}")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_license_scan(spark, str(tmp_path)).collect()
    assert len(got) == len(texts) + 6
    for r in got:
        text = "MIT License" if r.doc_id is None else texts[r.doc_id]
        assert tuple(r[1:6]) == base_columns(text)
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
        assert r.labels.split(",") == sorted(set(r.labels.split(","))) and 0 <= r.score <= 1
        assert (r.score > 0) == bool(r.labels)


def test_on_the_small_table(spark, small_docs):
    want = sorted((r.doc_id, *base_columns(r.text)) for r in small_docs.select("doc_id", "text").collect())
    got = queries.op12_license_scan(spark, "/root/testdata/sf0.001").collect()
    assert sorted(tuple(r[:6]) for r in got) == want


@pytest.mark.parametrize("text, form, duty", [
    ("mit", "mit", 1), ("gpl-2.0+", "gpl-2.0+", 3), ("mit or gpl-2.0", "mit gpl-2.0 or", 1),
    ("mit and gpl-2.0", "mit gpl-2.0 and", 3), ("mit or apache-2.0 and gpl-2.0", "mit apache-2.0 gpl-2.0 and or", 1),
    ("(mit or apache-2.0) and gpl-2.0", "mit apache-2.0 or gpl-2.0 and", 3),
    ("gpl-2.0 with classpath-exception-2.0", "gpl-2.0 classpath-exception-2.0 with", 2),
    ("gpl-2.0 with classpath-exception-2.0 and mit or cc0-1.0", "gpl-2.0 classpath-exception-2.0 with mit and cc0-1.0 or", 0),
    ("licenseref-acme or mit", "licenseref-acme mit or", 1), ("licenseref-acme", "licenseref-acme", 4),
    ("mit. and more", "mit", 1), ("mit and the rest", "mit", 1), ("mit or (", "mit", 1),
    ("mit and (gpl-2.0 or", "mit gpl-2.0 and", 3), ("(mit", "mit", 1), ("mit) or gpl", "mit", 1),
    ("((mit or bsd-3-clause))", "mit bsd-3-clause or", 1), ("cc-by-nc-4.0", "cc-by-nc-4.0", 4),
    ("cc-by-4.0", "cc-by-4.0", 1), ("mit or\ngpl", "mit", 1),
    ("gpl with a-1 with b-1", "gpl a-1 with", 2)])
def test_expressions(text, form, duty):
    tokens = postfix(text)[0]
    assert " ".join(tokens) == form and evaluate(tokens).duty == duty


@pytest.mark.parametrize("text", ["", "the mit", "and mit", "((((", ")", "with x", "or", "\n"])
def test_no_expression(text):
    assert evaluate(postfix(text)[0]) is None


def test_random_expressions():
    """The value of a random tree equals that of its spelling."""
    rng = random.Random(2)
    names = sorted(DUTY)

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            name = rng.choice(names)
            if rng.random() < 0.2:
                return f"{name} with some-exception", DUTY[name] - (DUTY[name] in (2, 3)), 3
            return name, DUTY[name], 3
        op = rng.choice(["and", "or"])
        binds = {"and": 2, "or": 1}[op]
        parts = [make(depth - 1) for _ in range(2)]
        spelled = [f"({s})" if b < binds or rng.random() < 0.1 else s for s, _, b in parts]
        return f" {op} ".join(spelled), (max if op == "and" else min)(d for _, d, _ in parts), binds

    for _ in range(500):
        text, duty, _ = make(4)
        tokens, end = postfix(text)
        assert evaluate(tokens).duty == duty and end == len(text)


def test_labels_tags_and_filter(spark):
    rows = [
        (0, "# SPDX-License-Identifier: (LGPL-2.1-only OR MIT) AND Zlib", {"lgpl", "mit", "zlib"}, 1),
        (1, '{"license": "GPL-3.0-or-later"}', {"gpl"}, 3), (2, "Licensed under MPL-2.0 or Apache-2.0.", {"mpl", "apache"}, 1),
        (3, "Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc"}, 4), (4, "my license to drive: none", set(), None),
        (5, "Permission is hereby granted, free of charge, to any", {"mit"}, 1), (6, None, set(), None),
        (7, "under the GNU Lesser General Public License", {"lgpl"}, 2), (8, "é SPDX-License-Identifier:\nMIT", set(), None),
        (9, "ééé License: MIT", {"mit"}, 1)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    for got, (_, _, labels, duty) in zip(license_scan.scan_licenses(docs).orderBy("doc_id").collect(), rows):
        assert {m.label for m in got.matches} == labels and got.duty == duty
    assert [r.doc_id for r in license_scan.keep_free(docs).orderBy("doc_id").collect()] == [0, 2, 4, 5, 6, 8, 9]
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0 and license_scan.keep_free(docs.limit(0)).count() == 0
