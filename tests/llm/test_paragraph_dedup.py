import random

import numpy as np
import pytest

from mediamart.llm import paragraph_dedup as pd_


def shingles(line):
    w = line.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def brute(rows, percent=80, min_words=pd_.MIN_WORDS):
    paras = [(i, n, line.split(), shingles(line)) for i, t in rows if i is not None
             for n, line in enumerate((t or "").split("\n")) if len(line.encode().split()) >= min_words]
    comp = list(range(len(paras)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    index = {}
    for k, p in enumerate(paras):
        for s in p[3]:
            index.setdefault(s, []).append(k)
    for k, p in enumerate(paras):
        for j in {j for s in p[3] for j in index[s] if j < k}:
            q = paras[j][3]
            if 100 * len(p[3] & q) >= percent * len(p[3] | q):
                a, b = sorted((root(k), root(j)))
                comp[b] = a
    groups = {}
    for k in range(len(paras)):
        groups.setdefault(root(k), []).append(paras[k][:2])
    out = []
    for g in groups.values():
        if len(g) > 1:
            first = min(g)
            out += [(i, n, first[0], first[1], len(g), (i, n) != first) for i, n in g]
    return sorted(out)


def check(df, rows):
    got = [(r.doc_id, r.paragraph, r.first_doc_id, r.first_paragraph, r.n_copies, r.removed)
           for r in pd_.repeated_paragraphs(df).collect()]
    assert sorted(got) == brute(rows)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_planted_passages_blocks_and_edges(documents, monkeypatch):
    monkeypatch.setattr(pd_.c, "BLOCK_ROWS", 5)
    rng = random.Random(7)
    line = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    shared, common = line(60), line(12)
    rows = []
    for k in range(40):
        near = shared.split()
        near[rng.randrange(60)] = "edit"
        rows.append("\n".join([line(30), common, " ".join(near), line(9), ""]))
    rows += ["", None, shared.upper() + "\n" + shared, "short line\nshort line", line(4000)]
    rows = list(enumerate(rows)) + [(None, shared), (3, shared)]
    check(documents([(i, t, "en", "s") for i, t in rows], extra=True), rows)


def test_signatures_of_many_lines_equal_those_of_each():
    rng = random.Random(1)
    hasher = pd_.c.MinHash(pd_.BANDS, pd_.ROWS)
    lines = [[b"w%d" % rng.randrange(50) for _ in range(rng.choice([5, 6, 10, 5000]))] for _ in range(9)]
    many = pd_.line_signatures(hasher, lines)
    for words, row in zip(lines, many):
        one = hasher.signature(pd_.np.unique(pd_.c.shingle_hashes(pd_.c.word_hashes(words))))
        assert (row == one).all()


def test_cutting_and_bounds(documents):
    text = " ".join(f"w{i}" for i in range(12))
    df = documents([(1, "a\n" + text + "\nb"), (2, text + "\nlast"), (3, None), (4, text + "\n" + text)])
    got = {r.doc_id: r.text for r in pd_.drop_repeated_paragraphs(df).collect()}
    assert got == {1: "a\n" + text + "\nb", 2: "last", 3: None, 4: ""}
    assert pd_.repeated_paragraphs(documents([]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        pd_.repeated_paragraphs(df, min_words=4)


def test_passages_inside_lines_and_in_one_line_documents(documents):
    from mediamart.llm.queries import op6_paragraph_dedup
    rng = random.Random(3)
    line = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    rows, shared = [], []
    for k in range(60):
        run = line(50)
        a, b = (line(rng.randrange(3, 300)) for _ in range(2))
        wrapped = "\n".join(" ".join(run.split()[i:i + 7]) for i in range(0, 50, 7))
        first, second = [(f"{a} {run} {b}", f"{line(200)} {run.upper()}"),
                         (f"short\n{a} {run} {b}\nend", f"{run} {line(90)}"), (f"{a} {run}", f"{b}\n{wrapped}\n{a[:9]}")][k % 3]
        rows += [(2 * k, first), (2 * k + 1, second)]
        shared.append(run)
    df = documents([(i, t, "en", "s") for i, t in rows] + [(None, rows[0][1], "en", "s"), (900, None, "en", "s"), (901, line(400), "en", "s")])
    got = pd_.repeated_units(df).collect()
    texts = {i: t.lower().split() for i, t in rows}
    for r in got:
        if r.unit == "passage":
            assert texts[r.doc_id][r.paragraph:r.paragraph + r.n_words] == texts[r.first_doc_id][r.first_paragraph:r.first_paragraph + r.n_words]
    assert {(r.doc_id, r.first_doc_id) for r in got if r.removed and r.unit == "passage"} == {(2 * k + 1, 2 * k) for k in range(60)}
    clean = {r.doc_id: r.text for r in pd_.drop_repeated_units(df).collect() if r.doc_id is not None}
    assert all(clean[2 * k] == rows[2 * k][1] and len(clean[2 * k + 1].split()) <= len(texts[2 * k + 1]) - 20 for k in range(60))
    assert clean[900] is None and len(clean[901].split()) == 400
    assert pd_.repeated_units(documents([]).limit(0)).collect() == []
    assert "repeated_units" in op6_paragraph_dedup.__code__.co_names


def test_overlapping_passages_keep_what_stays():
    text = ("a b c d e f g " * 40).encode()
    at, ids = pd_.passages_of(text)
    marked = [(int(w), int(n), w != at[0]) for w, n in zip(at, ids)]
    kept = pd_.cut_passages(text, marked).split()
    assert kept[int(at[0]):int(at[0]) + pd_.PASSAGE_WORDS] == text.split()[int(at[0]):int(at[0]) + pd_.PASSAGE_WORDS]


def test_runs_under_the_stated_length_are_left_alone(documents):
    rng = random.Random(5)
    line = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    rows = []
    for k in range(40):  # 40 pairs share 49 words, 40 share 50
        for words in (49, 50):
            run = line(words)
            rows += [(len(rows), f"{line(80)} {run} {line(70)}"), (len(rows) + 1, f"{line(40)} {run} {line(90)}")]
    found = {r.doc_id for r in pd_.repeated_passages(documents([(i, t, "en", "s") for i, t in rows])).collect()}
    assert found == {i for i, _ in rows if i % 4 >= 2}


@pytest.mark.parametrize("table", ["sf0.001", "planted"])
def test_passages_against_all_runs(spark, documents, table):
    """Precision: a reported passage lies in a run of 50 words that stands elsewhere too.
    Recall: every such run, at every place, holds a reported passage."""
    if table == "planted":
        rng = random.Random(6)
        pool = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(30, 120))) for _ in range(12)]
        rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.5 else f"x{rng.random()}" for _ in range(8))) for i in range(60)]
        df = documents([(i, t, "en", "s") for i, t in rows])
    else:
        df = spark.read.parquet(f"/root/testdata/{table}/documents.parquet")
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    places = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        for s in range(len(words) - 49):
            places.setdefault(tuple(words[s:s + 50]), []).append((i, s))
    shared = {place for at in places.values() if len(at) > 1 for place in at}
    got = {(r.doc_id, r.paragraph) for r in pd_.repeated_passages(df).collect()}
    assert len(shared) > 100
    assert all(any((i, s) in shared for s in range(w - 30, w + 1)) for i, w in got)
    assert all(any((i, w) in got for w in range(s, s + 31)) for i, s in shared)


def test_run_hashes_are_those_of_each_run():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 63, 120, dtype=np.uint64)
    for k in (1, 2, 5, 20, 50, 120):
        sums = [sum(int(words[i + j]) * pd_._FOLD ** (k - 1 - j) for j in range(k)) % (1 << 64) for i in range(120 - k + 1)]
        assert pd_.run_hashes(words, k).tolist() == pd_.c.mix(np.array(sums, np.uint64)).tolist()


def test_hot_keys_stay_where_they_lie(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(pd_.c, "LEAST_HOT_ROWS", 50)
    rows = pd_.materialize(spark.range(1000).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("k"), "id"), "rows")
    small = spark.range(0, 900, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).union(spark.createDataFrame([(7, 14)], "k long, v long"))
    key = lambda df: sorted(map(tuple, df.select("k", "id", "v").collect()), key=str)
    for how in ("inner", "left"):
        counted = pd_.materialize(small.join(rows.groupBy("k").count(), "k", "left"), "counted")
        for got in (pd_.c.hot_key_join(rows, small, "k", how), pd_.c.hot_key_join(rows, counted, "k", how, counted="count")):
            assert key(got) == key(rows.join(small, "k", how))
            assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_words_of_many_texts_are_hashed_at_once(monkeypatch):
    import pyarrow as pa
    rng = random.Random(9)
    texts = ["".join(rng.choice("abÄ \n\t") for _ in range(rng.randrange(1500))) for _ in range(40)]
    texts += ["", None, " \n ", "x " * 300, "A  b\tc d e f g h i j k l\r\nno\x1cgap \x0b \x0c", " ".join("w" * k for k in range(1, 90))]
    raw = [(t or "").encode() for t in texts]
    for t in raw:
        starts, ends, hashed = pd_.c.words_in(t.lower())
        words = pd_.c.words_of(t)
        assert [t.lower()[a:b] for a, b in zip(starts, ends)] == words
        assert hashed.tolist() == pd_.c.word_hashes(words).tolist()
    lines = [(d, i, len(words), pd_.class_id(words)) for d, t in enumerate(raw) for i, _, words in pd_.long_lines(t, 10)]
    passages = []
    for d, t in enumerate(raw):
        hashed = pd_.c.word_hashes(pd_.c.words_of(t))
        if len(hashed) >= pd_.SHARED_WORDS:
            at, ids = pd_.chosen_passages(hashed)
            passages += zip([d] * len(at), at.tolist(), ids.tolist(), pd_.contexts_of(hashed, at)[0].tolist())

    class Docs:
        select = lambda self, *names: self

    def one_by_one(words):
        raise AssertionError("hashed word by word")

    monkeypatch.setattr(pd_.c, "map_arrow", lambda df, run, schema: run)
    monkeypatch.setattr(pd_.c, "word_hashes", one_by_one)
    for chunk in (1, 5000, 1 << 18):
        monkeypatch.setattr(pd_.c, "_CHUNK_BYTES", chunk)
        batches = [pa.record_batch([pa.array(range(a, b), pa.int64()), pa.array(texts[a:b], pa.string())], names=["doc_id", "text"])
                   for a, b in ((0, 17), (17, len(texts)))]
        rows = lambda step: [tuple(r.values()) for x in step(Docs())(batches) for r in x.to_pylist()]
        assert [r[:4] for r in rows(lambda d: pd_._paragraphs(d, 10))] == lines
        assert rows(pd_._passages) == passages
