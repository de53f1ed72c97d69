"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming
search, exact weighted-shingle verification. DataFrame functions only.

Words are runs of letters and digits, lower-cased. A document's windows have the
length of the item they are held against. A window that shares no five-word
shingle with any item has similarity 0, so windows are laid where a shared
shingle says the item would begin. Their 64-bit SimHash (shingles weighted by
count) is searched among the items' of that length: 64 bits in 8 blocks, and
fingerprints within RADIUS = 23 agree in some block up to 23 // 8 = 2 bits
(pigeonhole), so probing every block value within 2 bits finds them all. Pairs
within the radius are verified by sum(min) / sum(max) of shingle counts.

A pair at similarity 0.8 differs in Bin(64, 0.152) bits: 9.7 on average, over 23
with probability 1e-5.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from mediamart.llm.common import SHINGLE_WORDS
from mediamart.session import materialize

SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, RADIUS = 8, 8, 23
BROADCAST_ITEMS, BROADCAST_SHINGLES = 2000, 200_000  # rows of some 300 and 24 bytes


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(hashes: Column, k: int = SHINGLE_WORDS) -> Column:
    """Hashes of the k-word shingles in order from word hashes; of fewer words,
    one for all; none of none."""
    n = F.size(hashes)
    many = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[hashes[i + j] for j in range(k)]))
    few = F.array(F.xxhash64(F.concat_ws(" ", hashes.cast("array<string>"))))
    return F.when(n >= k, many).when(n > 0, few).otherwise(F.array().cast("array<bigint>"))


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _fingerprint(df: DataFrame, s: str) -> DataFrame:
    """``df`` with fp: the SimHash of the shingle array ``s`` as BLOCKS numbers."""
    def block(k):
        def one(b):
            votes = F.aggregate(s, F.lit(0), lambda n, h: n + F.getbit(h, F.lit(k * BLOCK_BITS + b)).cast("int") * 2 - 1)
            return F.when(votes > 0, 1 << b).otherwise(0)
        total = one(0)
        for b in range(1, BLOCK_BITS):
            total = total + one(b)
        return total
    return df.withColumn("fp", F.array(*[block(k) for k in range(BLOCKS)]))


def _tagged(df: DataFrame, s: str, name: str) -> DataFrame:
    """``df`` with the multiset ``s`` as a set: each shingle with its number among equals."""
    sorted_ = df.withColumn(name, F.array_sort(s))
    return sorted_.withColumn(name, F.transform(name, lambda h, i: F.xxhash64(h, i - F.array_position(name, h))))


def _within(bits: int) -> list[int]:
    return [sum(1 << b for b in c) for k in range(bits + 1) for c in combinations(range(BLOCK_BITS), k)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, start_word, n_words, distance): for every
    document and item, the window most similar to the item, where that is
    ``similarity`` or more.

    Needs doc_id and text of ``docs``, item_id and text of ``benchmark``; other
    columns are ignored. Null or wordless texts and items leak nothing. An item
    of fewer than five words is found only in a document that has just these. Null
    doc_ids are reported as null; rows that repeat a doc_id are one document.
    """
    items = benchmark.select("item_id", word_hashes(F.col("text")).alias("w")).where("size(w) > 0")
    items = items.select("item_id", F.size("w").alias("n_words"), shingles(F.col("w")).alias("item_shingles"))
    items = materialize(_tagged(_fingerprint(items, "item_shingles"), "item_shingles", "item_set"), "items")

    seeds = items.select("item_id", "n_words", F.posexplode_outer("item_shingles").alias("at", "shingle"))
    seeds = materialize(seeds.select("shingle", "n_words", "at").distinct(), "seeds")
    small = items.count() <= BROADCAST_ITEMS and seeds.count() <= BROADCAST_SHINGLES
    sized = F.broadcast if small else (lambda df: df)

    # Arrays used several times in an expression are columns first, and exploded by the outer form:
    # the plain one filters on the array's size, below the columns, where each use is computed anew.
    places = docs.select("doc_id", word_hashes(F.col("text")).alias("w")).select("doc_id", shingles(F.col("w")).alias("s"))
    places = places.select("doc_id", F.posexplode_outer("s").alias("pos", "shingle"))
    starts = materialize(
        places.join(sized(seeds), "shingle")
        .select("doc_id", "n_words", F.greatest(F.col("pos") - F.col("at"), F.lit(0)).alias("start")).distinct(), "windows")

    texts = docs.select(F.col("doc_id").alias("id"), "text")
    near = starts.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n_words")).alias("windows"))  # bounded by the text
    found = texts.join(near, F.col("id").eqNullSafe(F.col("doc_id"))).select("doc_id", "windows", word_hashes(F.col("text")).alias("w"))
    windows = found.select("doc_id", F.explode("windows").alias("window"), "w").select(
        "doc_id", "window.start", "window.n_words", F.slice("w", F.col("window.start") + 1, F.col("window.n_words")).alias("w"))
    windows = windows.select("doc_id", "start", "n_words", shingles(F.col("w")).alias("s"))
    windows = _tagged(_fingerprint(windows, "s"), "s", "window_set")

    probes = F.array(*[F.lit(x) for x in _within(RADIUS // BLOCKS)])
    index = (items.select("item_id", "n_words", F.col("fp").alias("item_fp"), F.posexplode_outer("fp").alias("block", "value"))
             .withColumn("value", F.explode(F.transform(probes, lambda x: x.bitwiseXOR(F.col("value"))))))
    asked = windows.select("doc_id", "start", "n_words", "window_set", "fp", F.posexplode_outer("fp").alias("block", "value"))
    pairs = asked.join(sized(index), ["n_words", "block", "value"])
    apart = F.aggregate(F.zip_with("fp", "item_fp", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, x: n + x)
    # A pair meets in several blocks: it is taken in the first in which it can.
    close = F.zip_with("fp", "item_fp", lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= RADIUS // BLOCKS)
    pairs = (pairs.withColumn("distance", apart).where(F.col("distance") <= RADIUS)
             .where(F.array_position(close, True) == F.col("block") + 1)
             .join(sized(items.select("item_id", "item_set")), "item_id"))
    pairs = pairs.withColumn("both", F.size(F.array_intersect("window_set", "item_set")))
    exact = pairs.withColumn("similarity", F.col("both") / (F.size("window_set") + F.size("item_set") - F.col("both")))
    best = (exact.where(F.col("similarity") >= similarity).groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"), "n_words", "distance")).alias("m")))
    return best.select("doc_id", "item_id", "m.similarity", (-F.col("m.start")).alias("start_word"), "m.n_words", "m.distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents in which no item leaks; columns unchanged. Rows whose
    doc_id is null are kept: they cannot be told apart."""
    leaks = find_leaks(docs.where("doc_id is not null"), benchmark, similarity).select("doc_id").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
