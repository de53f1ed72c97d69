"""Near-duplicate documents: MinHash banding, sequential Bayesian pruning,
exact verification, connected components.

1. Equal word sequences form one class (its smallest doc_id stands for it).
2. Classes that share a MinHash band key are connected; the components of
   that graph are candidate clusters. No pair is formed for this.
3. Clusters are cut into bounded blocks. In a task, banded pairs are compared
   one signature batch at a time: after k compared values with m matches, and a
   uniform prior, P(similarity >= t | m, k) = P(Bin(k + 1, t) <= m); a pair goes
   as soon as that is below ``miss``. The rest are verified on full sets.
4. Components of the verified links.

30 bands of 5 rows miss a pair at similarity 0.8 with probability
(1 - 0.8**5)**30 = 7e-6, 24 bands of 6 rows one at 0.85 with 1e-5; higher
similarities are missed less.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mediamart.llm import common as c
from mediamart.session import materialize

BANDS, ROWS = 30, 5
MISS = 1e-5
_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("sequence", pa.binary()), ("keys", pa.binary())])


def least_matches(k: int, threshold: float, miss: float) -> int:
    """Fewest matches among k values that keep a pair: below it the posterior
    probability of reaching ``threshold`` is under ``miss``."""
    total = 0.0
    for m in range(k + 1):
        total += comb(k + 1, m) * threshold ** m * (1 - threshold) ** (k + 1 - m)
        if total >= miss:
            return m
    return k


def _features(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    def run(batches):
        hasher = c.MinHash(bands, rows)
        for batch in batches:
            sizes, sequences, signatures = [], [], []
            for text in c.texts_of(batch):
                words = c.words_of(text)
                shingles = np.unique(c.shingle_hashes(c.word_hashes(words)))
                sizes.append(len(shingles))
                sequences.append(c.sequence_key(words) if words else None)
                if words:
                    signatures.append(hasher.signature(shingles))
            packed = iter(hasher.band_keys(np.array(signatures)) if signatures else [])
            keys = [next(packed).tobytes() if n else None for n in sizes]
            yield c.record(_FEATURES, [batch.column("doc_id").cast(pa.int64()), sizes, sequences, keys])

    return c.map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, sequence binary, keys binary")


def _verified(tasks: DataFrame, bands: int, rows: int, percent: int, miss: float) -> DataFrame:
    """Links (u, v) with 100 * intersection >= percent * union, as a spanning
    forest of each task's links."""
    batch_size = 2 * rows
    steps = [(k, least_matches(k, percent / 100, miss)) for k in range(batch_size, bands * rows + 1, batch_size)]

    def links(items, left, right, hasher):
        sets = [c.shingle_set(r["body"]) for r in items]
        a, b = c.task_pairs(np.array([r["block"] for r in items]), left, right)
        signatures = np.array([hasher.signature(s) for s in sets])
        keys = hasher.band_keys(signatures)
        live = np.zeros((len(a), len(b)), bool)
        for j in range(bands):
            live |= keys[a, j][:, None] == keys[b, j][None, :]
        if left == right:
            live &= np.triu(np.ones(live.shape, bool), 1)
        i, j = np.nonzero(live)
        i, j = a[i], b[j]
        matches = np.zeros(len(i), np.int32)
        for k, least in steps:
            part = slice(k - batch_size, k)
            matches += (signatures[i, part] == signatures[j, part]).sum(1)
            on = matches >= least
            i, j, matches = i[on], j[on], matches[on]
        if not len(i):
            return None
        sizes = np.array([len(s) for s in sets])
        at = np.unique(np.r_[i, j])
        place = np.zeros(len(sets), np.int64)
        place[at] = np.arange(len(at))
        both = c.intersections([sets[x] for x in at], np.arange(len(at)), np.arange(len(at)))[place[i], place[j]]
        ok = 100 * both >= percent * (sizes[i] + sizes[j] - both)
        pairs = c.forest(np.stack([i[ok], j[ok]], 1), len(sets))
        node = np.array([r["node"] for r in items], np.int64)
        return c.record(c._EDGE, [node[pairs[:, 0]], node[pairs[:, 1]]])

    def run(batches):
        hasher = c.MinHash(bands, rows)
        for (_, left, right), items in c.groups(batches, ["cluster", "left", "right"]):
            found = links(items, left, right, hasher)
            if found is not None:
                yield found

    return c.map_arrow(tasks.select("cluster", "left", "right", "block", "node", "body"), run, "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
                    miss: float = MISS) -> DataFrame:
    """Component of near duplicates of every document.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns
    one row per input row: doc_id, n_shingles, class_id (smallest doc_id with
    the same words), component_id (smallest doc_id reachable over links with
    100 * intersection >= percent * union of shingle sets) and kept (doc_id =
    component_id).

    Null and empty texts have no shingles and link with nothing. Rows that
    repeat a doc_id are one document. A null doc_id can be no representative:
    such a row has null ids and stays kept. An empty table gives no rows.
    """
    spark = docs.sparkSession
    features = materialize(_features(docs, bands, rows), "minhash")
    known = features.where("n_shingles > 0 and doc_id is not null")
    classes = materialize(known.groupBy("sequence").agg(F.min(F.struct("doc_id", "keys")).alias("m"))
                          .select("sequence", F.col("m.doc_id").alias("class_id"), F.col("m.keys").alias("keys")), "classes")
    clusters = c.connected_components(c.collision_edges(classes.select(F.col("class_id").alias("node"), "keys")))
    body = docs.select(F.col("doc_id").alias("node"), F.col("text").cast("binary").alias("body"))
    members = clusters.withColumnRenamed("component", "cluster").join(body, "node").where("body is not null")
    links = _verified(c.comparison_blocks(members), bands, rows, percent, miss)
    components = c.connected_components(links).withColumnRenamed("node", "class_id")
    ids = classes.select("sequence", "class_id").join(components, "class_id", "left")
    out = features.drop("keys").join(ids, "sequence", "left")
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents whose component_id is their own doc_id, columns unchanged."""
    kept = near_duplicates(docs, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    keyed = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
    return keyed.unionByName(docs.where("doc_id is null"))
