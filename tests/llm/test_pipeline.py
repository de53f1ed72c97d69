from collections import Counter

import corpus_pipeline
from mediamart.llm import decontaminate, language_id, mixing, near_dup
from llm.test_near_dup import brute

SF = "/root/testdata/sf0.001"


def test_stages_and_their_effects(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before = docs
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "sharding":
            assert docs.columns == before.columns
        kept.append(Counter(r.doc_id for r in docs.collect()))
    langs = {r.doc_id for r in language_id.identify(before).collect() if r.lang_pred != "und" and r.score >= 0.5}
    assert set(kept[0]) == langs
    rows = [(r.doc_id, r.text) for r in before.collect() if r.doc_id in langs]
    assert set(kept[1]) == {i for i, (_, c) in brute(rows, 80).items() if i == c}
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.find_leaks(before, bench).collect()}
    assert set(kept[2]) == set(kept[1]) - leaks
    assert set(kept[3]) <= set(kept[2]) and kept[4] == kept[3]


def test_run_gives_shards(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s])) for s in sizes)


def test_empty_tables(spark, documents):
    docs = documents([]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
