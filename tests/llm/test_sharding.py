from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from mediamart.llm import sharding as sh


def rows_of(df):
    return sorted(((r.doc_id, r.shard, r.slot) for r in df.collect()), key=str)


def test_exact_sizes_gapless_slots_whole_rows(small_docs):
    out = sh.shuffle_into_shards(small_docs, shards=16)
    got = out.collect()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert sorted(r[:5] for r in got) == sorted(map(tuple, small_docs.collect()))


def test_layout_does_not_matter(small_docs):
    assert rows_of(sh.shuffle_into_shards(small_docs)) == rows_of(sh.shuffle_into_shards(small_docs.repartition(7, "source")))


def test_shuffle_width_does_not_matter(spark, small_docs):
    got = []
    for width in (8, 64):
        spark.conf.set("spark.sql.shuffle.partitions", width)
        try:
            got.append(rows_of(sh.shuffle_into_shards(small_docs)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got[0] == got[1]


def test_places_against_brute_force(spark, small_docs):
    """Blocks, matrix and permutations done by plain sorts over all ids at once."""
    rows = sh.row_ids(small_docs.union(small_docs.limit(30)), 5, ("doc_id", "text"))
    ids = rows.groupBy("first", "second").agg(F.count("*").alias("n"))
    got = sorted(map(tuple, sh.draw_places(ids, 4, 5).collect()))
    copies = [(r.first, r.second, k) for r in ids.collect() for k in range(1, r.n + 1)]
    hashed = spark.createDataFrame(copies, "first long, second long, nth long").select(
        "*", F.pmod(F.xxhash64("first", "second", "nth"), F.lit(64)).alias("block"),
        *[F.xxhash64("first", "second", "nth", F.lit(5), F.lit(s)).alias(f"mixed{s}") for s in (1, 2)]).collect()
    sizes = [n for shard in sh.even_sizes(len(copies), 4) for n in sh.even_sizes(shard, 16)]
    by_block = {}
    for r in sorted(hashed, key=lambda r: (r.block, r.mixed1, r[:3])):
        by_block.setdefault(r.block, []).append(r)
    order = sorted(by_block)
    lines = sh.communication_matrix(np.random.default_rng(5), [len(by_block[b]) for b in order], sizes)
    sent = {}
    for block, line in zip(order, lines):  # one block a group: its matrix is its own line
        line = sh.communication_matrix(np.random.default_rng([5, block]), [len(by_block[block])], line)[0]
        room = iter(by_block[block])
        for target, n in enumerate(line):
            sent.setdefault(target, []).extend(next(room) for _ in range(n))
    want, starts = [], [sum(sizes[t // 16 * 16:t]) for t in range(64)]
    for target, members in sent.items():
        assert len(members) == sizes[target]
        for i, r in enumerate(sorted(members, key=lambda r: (r.mixed2, r[:3]))):
            want.append((*r[:3], target // 16, starts[target] + i))
    assert got == sorted(want)


def test_crowds_of_copies_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sh, "COPIES_PER_TASK", 50)
    docs = spark.range(1000).select(F.when(F.col("id") < 400, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") < 400, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"))
    got = sh.shuffle_into_shards(docs, shards=4).collect()
    assert len({(r.shard, r.slot) for r in got}) == 1000 and Counter(r.shard for r in got) == {s: 250 for s in range(4)}
    assert Counter(r.doc_id for r in got)[7] == 400
    spread = Counter(r.shard for r in got if r.doc_id == 7)
    assert all(60 < spread[s] < 140 for s in range(4))


def test_long_texts_move_whole(spark):
    docs = spark.createDataFrame([(i, "x" * 3_000_000 if i == 3 else "y") for i in range(9)], "doc_id long, text string")
    got = sh.shuffle_into_shards(docs, shards=2).select("doc_id", F.length("text").alias("n")).collect()
    assert sorted(map(tuple, got)) == [(i, 3_000_000 if i == 3 else 1) for i in range(9)]


def test_matrix_margins_and_law():
    rng = np.random.default_rng(1)
    for _ in range(20):
        rows = rng.integers(0, 50, 6).tolist()
        cols = sh.even_sizes(sum(rows), 4)
        m = np.array(sh.communication_matrix(rng, rows, cols))
        assert m.sum(1).tolist() == rows and m.sum(0).tolist() == cols and (m >= 0).all()
    draws = [sh.hypergeometric(rng, 30, 70, 20) for _ in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.15 and abs(np.var(draws) - 20 * 0.3 * 0.7 * 80 / 99) < 0.3
    assert sh.hypergeometric(rng, 5, 0, 3) == 3 and sh.hypergeometric(rng, 0, 5, 3) == 0
    big = sh.hypergeometric(rng, 10**10, 15 * 10**10, 10**8)
    assert abs(big - 10**8 / 16) < 10 * (10**8 / 16) ** 0.5


def test_each_pair_of_shard_and_source_rank_is_uniform(spark):
    docs = spark.range(1600).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    first = Counter()
    for seed in range(12):
        for r in sh.shuffle_into_shards(docs, shards=4, seed=seed).where("doc_id < 100").collect():
            first[r.shard] += 1
    assert all(abs(first[s] - 300) < 5 * 15 for s in range(4))


def test_copies_spread_nulls_and_clashing_names(documents, spark):
    same = documents([(1, "a")] * 400 + [(None, None), (2, None)], extra=True)
    out = sh.shuffle_into_shards(same, shards=4)
    got = out.collect()
    assert len(got) == 402 and out.columns[-2:] == ["shard", "slot"] and out.columns.count("slot") == 1
    assert set(Counter(r.shard for r in got).values()) <= {100, 101}
    slots = [r.slot for r in got if r.doc_id == 2]
    assert len(slots) == 1
    assert sh.shuffle_into_shards(documents([]).limit(0)).collect() == []
    assert [(r.shard, r.slot) for r in sh.shuffle_into_shards(documents(["x"])).collect()] == [(0, 0)]


def test_query_shards_the_whole_documents(spark, monkeypatch):
    from mediamart.llm import queries
    seen, real = [], queries.sharding.shuffle_into_shards

    def record(docs, **more):
        seen.append((docs.columns, more))
        return real(docs, **more)
    monkeypatch.setattr(queries.sharding, "shuffle_into_shards", record)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = queries.op3_sharding(spark, "/root/testdata/sf0.001").collect()
    assert seen == [(docs.columns, {"shards": 16})]
    want = {r.doc_id: (r.shard, r.slot) for r in real(docs, shards=16).collect()}
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want
