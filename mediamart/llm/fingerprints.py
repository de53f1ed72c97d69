"""Document fingerprints: bottom-k sketches of five-word shingle hashes.

The sketch of a set is its k smallest hashes. The sketch of a union is the k
smallest of both sketches, so sketches merge across parts of any size. From two
sketches: resemblance (share of the union's k smallest that are in both),
containment and the number of distinct shingles. Sets smaller than k are held
whole, so their figures are exact. With k = 128 the standard error of a
resemblance is at most 0.044.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from mediamart.llm import common as c

K = 128
SPREAD = 64  # first merging step: this many tasks share a key
_LOWEST = -(1 << 63)


def sketch(text: bytes | None, k: int = K) -> np.ndarray:
    return c.shingle_set(text)[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity; 1 for two empty sets."""
    both = merge(a, b, k)
    if not len(both):
        return 1.0
    return float((np.isin(both, a, assume_unique=True) & np.isin(both, b, assume_unique=True)).sum() / len(both))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0 ** 64 / float(a[k - 1])


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k))


def to_string(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_string(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


_MERGED = pa.schema([("key", pa.string()), ("part", pa.int32()), ("sketch", pa.binary())])


def corpus_sketches(docs: DataFrame, by: str, k: int = K) -> DataFrame:
    """(key, n_distinct double, fingerprint): the sketch of all texts of each
    value of ``by``, merged in tasks, then over tasks in two steps, so that no
    task receives a key's documents. Null keys and texts count as ''."""
    spark = c.prepare(docs.sparkSession)
    parts = c.shuffle_buckets(spark)

    def folded(pairs):
        held = {}
        for key, value in pairs:
            held[key] = merge(held[key], value, k) if key in held else value
            if len(held) >= 50_000:
                yield held
                held = {}
        if held:
            yield held

    def out(held, part):
        return c.record(_MERGED, [list(held), [part(x) for x in held], [v.tobytes() for v in held.values()]])

    def local(batches):
        pairs = ((key, sketch(t, k)) for b in batches for key, t in zip(b.column("key").to_pylist(), c.texts_of(b)))
        task = TaskContext.get().partitionId()
        for held in folded(pairs):
            yield out(held, lambda key: task % SPREAD)

    def again(batches):
        pairs = ((key, np.frombuffer(v, np.uint64)) for b in batches
                 for key, v in zip(b.column("key").to_pylist(), b.column("sketch").to_pylist()))
        for held in folded(pairs):
            yield out(held, lambda key: 0)

    schema = "key string, part int, sketch binary"
    keyed = docs.select(F.coalesce(F.col(by).cast("string"), F.lit("")).alias("key"), "text")
    once = c.map_arrow(keyed, local, schema).repartition(parts, "key", "part")
    twice = c.map_arrow(once, again, schema).repartition(parts, "key")

    def report(batches):
        for batch in again(batches):
            sk = [np.frombuffer(v, np.uint64) for v in batch.column("sketch").to_pylist()]
            yield c.record(_MERGED_OUT, [batch.column("key"), [distinct(s, k) for s in sk], [to_string(s) for s in sk]])

    return c.map_arrow(twice.sortWithinPartitions("key"), report, "key string, n_distinct double, fingerprint string")


_MERGED_OUT = pa.schema([("key", pa.string()), ("n_distinct", pa.float64()), ("fingerprint", pa.string())])


def following(docs: DataFrame, parts: int) -> DataFrame:
    """``docs`` dealt by ranges of descending doc_id (columns doc_id, text) so
    that every row is followed, in its range, by the next document.

    The first document of each range is repeated at the end of the range before
    it (``lead`` = 1), and the very first at the end of the last. Only one
    doc_id per range reaches the driver. Null doc_ids come last; rows with
    equal doc_id follow each other in order of their texts.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"))
    probs = [i / parts for i in range(1, parts)]
    found = ids.stat.approxQuantile("id", probs, 0.25 / parts) if probs else []
    bounds = np.unique(np.array(found, np.float64)).astype(np.int64)

    def own(ids_: pd.Series) -> np.ndarray:
        return np.searchsorted(bounds, ids_.to_numpy(np.int64), side="right")

    @F.pandas_udf("int")
    def part(ids_: pd.Series) -> pd.Series:
        return pd.Series(own(ids_).astype("int32"))

    highest = sorted((r["part"], r["top"]) for r in
                     ids.select(part("id").alias("part"), "id").groupBy("part").agg(F.max("id").alias("top")).collect())
    after = {}
    for n, (_, top) in enumerate(highest):
        after[top] = highest[(n + 1) % len(highest)][0]

    @F.pandas_udf("array<int>")
    def places(ids_: pd.Series) -> pd.Series:
        return pd.Series([[int(p), after[x]] if x in after else [int(p)] for p, x in zip(own(ids_), ids_)])

    rows = docs.select("doc_id", "text", F.posexplode(places(F.coalesce("doc_id", F.lit(_LOWEST)))).alias("lead", "part"))
    return rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "lead", F.desc_nulls_last("doc_id"), "text")


_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                           ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                           ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_distinct", pa.float64())])


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprint of every document and of its edited text.

    ``docs`` needs doc_id and text; other columns are ignored. The edited text
    has its last floor(n_chars / 2) code points replaced by the first as many (or
    all) of the next document by descending doc_id; after the last comes the
    first. One row per input row: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_distinct. Null texts count as
    empty, whose fingerprint is the empty string; two empty sets have likeness
    1. Null doc_ids come last. An empty table gives no rows.
    """
    spark = c.prepare(docs.sparkSession)
    rows = following(docs.select("doc_id", "text"), c.shuffle_buckets(spark))

    def run(batches):
        def line(row, nxt):
            doc_id, text, own = row
            keep = len(text) - len(text) // 2
            edited = (text[:keep] + nxt[1][: len(text) // 2]).encode()
            changed = sketch(edited, k)
            return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), to_string(own), to_string(changed),
                    resemblance(own, changed, k), resemblance(own, nxt[2], k), distinct(own, k))

        part, held, lead_seen, out = None, None, False, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    part, held, lead_seen = row["part"], None, False
                if lead_seen:
                    continue
                text = row["text"] or ""
                now = (row["doc_id"], text, sketch(text.encode(), k))
                if held is not None:
                    out.append(line(held, now))
                held, lead_seen = now, row["lead"] == 1
            if out:
                yield c.record(_FINGERPRINTS, list(zip(*out)))
                out = []

    return c.map_arrow(rows, run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                       "edited_fingerprint string, near_edited double, near_next double, n_distinct double")
