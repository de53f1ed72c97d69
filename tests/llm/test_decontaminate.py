import random
import re
from collections import Counter

from pyspark.sql import functions as F

from mediamart.llm import decontaminate as dc

SPLIT = re.compile(r"[^\w]+|_", re.U)


def words(t):
    return [w for w in SPLIT.split((t or "").lower()) if w]


def grams(w):
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def brute(docs, items, least=0.8):
    """Every item-sized window of every document against every item."""
    best = {}
    for i, t in docs:
        w = words(t)
        for item, it in items:
            iw = words(it)
            ig = grams(iw)
            if not iw or not w or (len(iw) < 5 and len(w) != len(iw)):  # short items: whole documents only
                continue
            for a in range(max(1, len(w) - len(iw) + 1)):
                s = similarity(grams(w[a:a + len(iw)]), ig)
                if s >= least:
                    best[i, item] = max(best.get((i, item), 0), s)
    return best


def leaks(df, bench, **kw):
    return {(r.doc_id, r.item_id): r.similarity for r in dc.find_leaks(df, bench, **kw).collect()}


def items_df(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("start", F.lit("x")).withColumn("fp", F.lit(1))


def test_exact_edited_repeated_and_short(documents, spark):
    rng = random.Random(6)
    line = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    items = [(k, " ".join(line(rng.randrange(12, 60)))) for k in range(12)]
    items += [(50, "la la la la la la la la la la la la"), (51, "two words"), (52, None), (53, "!!!"), (54, items[0][1])]
    docs = [" ".join(line(300)) for _ in range(6)]
    for k, t in items[:12]:
        docs.append(" ".join(line(40)) + " " + t + "\n" + " ".join(line(30)))
        w = t.split()
        w[len(w) // 2] = "edited"
        docs.append(" ".join(line(7) + w + line(9)))
        docs.append(", ".join(x.upper() + "!!" for x in w[1:]) + "### " + t)
    docs += ["", None, "two words", "two words more", "la " * 40, items[3][1], " ".join(items[4][1].split()[:-1])]
    rows = list(enumerate(docs))
    got = leaks(documents(rows, extra=True), items_df(spark, items))
    want = brute(rows, items)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_whole_tables(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, r.text) for r in bench.collect()]
    vocabulary = {g for _, t in items for g in grams(words(t))}
    # Windows without a shared shingle have similarity 0: brute force looks at the other documents only.
    rows = [(r.doc_id, r.text) for r in docs.collect() if vocabulary & set(grams(words(r.text)))]
    want = brute(rows, items)
    got = leaks(docs, bench)
    assert set(got) == set(want) and len(got) > 3
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({i for i, _ in got})


def test_without_broadcast_and_empty(documents, spark, monkeypatch):
    item = " ".join(f"w{i}" for i in range(20))
    df, bench = documents([(1, "a b " + item), (None, item), (2, "x y z")]), items_df(spark, [(7, item)])
    assert set(leaks(df, bench)) == {(1, 7), (None, 7)}
    monkeypatch.setattr(dc, "BROADCAST_ITEMS", 0)
    assert set(leaks(df, bench)) == {(1, 7), (None, 7)}
    assert [r.doc_id for r in dc.drop_contaminated(df, bench).collect()] in ([2, None], [None, 2])
    assert leaks(documents([]).limit(0), bench) == {} and leaks(df, bench.limit(0)) == {}


def test_blocks_reach_every_fingerprint_within_the_radius():
    rng = random.Random(2)
    for _ in range(300):
        bits = set(rng.sample(range(64), dc.RADIUS))
        per_block = [sum(b // dc.BLOCK_BITS == k for b in bits) for k in range(dc.BLOCKS)]
        assert min(per_block) <= dc.RADIUS // dc.BLOCKS
    assert len(dc._within(2)) == 1 + 8 + 28
