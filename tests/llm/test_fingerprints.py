import hashlib
import random

import numpy as np
import pytest

from mediamart.llm import common as c, fingerprints as fp


def expected(rows):
    """Rows by descending doc_id (nulls last), each with its next."""
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] or "")
    order = sorted(rows, key=key)
    out = []
    for n, (i, t) in enumerate(order):
        text, nxt = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        a, b, x = (fp.sketch(s.encode()) for s in (text, edited, nxt))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.to_string(a), fp.to_string(b),
                    fp.resemblance(a, b), fp.resemblance(a, x), fp.distinct(a)))
    return sorted(out, key=str)


def check(df, rows):
    assert sorted(map(tuple, fp.fingerprint_documents(df).collect()), key=str) == expected(rows)


def test_whole_table(small_docs):
    check(small_docs.repartition(5), [(r.doc_id, r.text) for r in small_docs.collect()])


@pytest.mark.parametrize("n", [1, 2, 3, 40])
def test_few_rows_nulls_and_gaps(documents, n):
    rng = random.Random(n)
    rows = [(rng.randrange(-5, 9) * 10**9 + i, rng.choice([None, "", "é" * 7, "a b c d e f g h " * 9])) for i in range(n)]
    rows += [(None, "null id")] if n == 40 else []
    check(documents([(i, t, "en", "s") for i, t in rows], extra=True), rows)


def test_repeated_ids_and_empty_table(documents):
    rows = [(3, "b"), (3, "a a a a a a"), (1, "c"), (3, "a a a a a a")]
    check(documents([(i, t, "en", "s") for i, t in rows]), rows)
    assert fp.fingerprint_documents(documents([]).limit(0)).collect() == []


def test_estimates_and_merging():
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(3000)]
    a, b = " ".join(words[:2000]).encode(), " ".join(words[1000:]).encode()
    sa, sb = fp.sketch(a), fp.sketch(b)
    assert (fp.merge(sa, sb) == np.union1d(c.shingle_set(a), c.shingle_set(b))[:fp.K]).all()
    assert abs(fp.resemblance(sa, sb) - 1 / 3) < 0.15
    assert abs(fp.containment(sa, sb) - 1 / 2) < 0.2
    assert abs(fp.distinct(sa) / 1996 - 1) < 0.3
    small = fp.sketch(b"one two three")
    assert fp.distinct(small) == 1 and fp.resemblance(small, small) == 1
    assert (fp.from_string(fp.to_string(sa)) == sa).all()


def test_corpus_sketches_equal_those_of_all_texts(small_docs):
    got = {r.key: r.fingerprint for r in fp.corpus_sketches(small_docs.repartition(6), "lang").collect()}
    want = {}
    for r in small_docs.collect():
        want.setdefault(r.lang, []).append(c.shingle_set(r.text.encode()))
    assert got == {k: fp.to_string(np.unique(np.concatenate(v))[:fp.K]) for k, v in want.items()}
