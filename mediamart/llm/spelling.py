"""Spelling variants: words one edit apart, found over pivotal grams.

Every word has two pivots, disjoint bigrams chosen among its rarest ones by
dynamic programming. One edit leaves a pivot of either word untouched, and that
one stands among the other word's rarest bigrams (its gram prefix) if the other
prefix reaches as far in the order of rareness. So the pivots of all words are
looked up in an index of the prefixes of all words, at the places that one edit
can move them to, and what is found is verified.

An edit on one side of a pivot leaves the other side equal, and on its own side
either the first or the second half. These equal parts belong to the index key,
so that its lists stay short however common a gram is.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mediamart.llm import common as c
from mediamart.session import materialize

LEAST_LENGTH = 7
LEAST_COUNT = 2
FACTOR = 10
GRAM_CLASSES = 1 << 13  # more than the 90 * 90 bigrams of a-z and à-ÿ; other letters share classes
CARRIED = 64  # code points of a word that travels with every key; a longer one is looked up by its id
_FLUSH = 1 << 18
_NEVER = np.int64(1) << np.int64(60)


# ---------------------------------------------------------------- vocabulary

def vocabulary(docs: DataFrame, drop_every: int | None = None, least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the letter runs of all whole texts, A-Z lower-cased, of at least
    ``least_length`` code points and ``least_count`` occurrences.

    With ``drop_every`` a run whose h = crc32("doc_id:run") it divides first loses
    its code point h % length: misspellings made for a test; a null doc_id reads
    as nothing there. Null and empty texts have no runs, repeated rows count each,
    other columns are ignored, and an empty table gives no rows. Occurrences are
    added up in each task before the shuffle.
    """
    find = re.compile("[a-zÀ-ÿ]{%d,}" % least_length).findall
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches):
        total = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), c.texts_of(batch)):
                found = Counter(find(text.lower().decode())) if text else {}
                if drop_every and found:
                    seed = zlib.crc32(b"%s:" % (b"" if doc_id is None else b"%d" % doc_id))
                    for word in list(found):
                        h = zlib.crc32(word.encode(), seed)
                        if h % drop_every == 0:
                            n, at = found.pop(word), h % len(word)
                            if len(word) > least_length:
                                total[word[:at] + word[at + 1:]] += n
                total.update(found)
                if len(total) >= _FLUSH:
                    yield c.record(schema, [list(total), list(total.values())])
                    total = Counter()
        if total:
            yield c.record(schema, [list(total), list(total.values())])

    counted = c.map_arrow(docs.select("doc_id", "text"), run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---------------------------------------------------------------- grams

def by_length(words: list[str]):
    """(rows, code points as a matrix) of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        joined = "".join([words[i] for i in rows.tolist()])
        yield rows, np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(rows), n).astype(np.int64)


def grams(points: np.ndarray) -> np.ndarray:
    """Classes of the bigrams at every position; equal bigrams share a class."""
    letter = np.where(points < 0xC0, points - 97, points - 0xC0 + 26)
    return (letter[:, :-1] * 90 + letter[:, 1:]) % GRAM_CLASSES


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often each class of bigrams occurs in ``words``: GRAM_CLASSES numbers
    whatever the table, added up in the tasks first."""
    schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        total = np.zeros(GRAM_CLASSES, np.int64)
        for batch in batches:
            for _, points in by_length(batch.column("word").to_pylist()):
                total += np.bincount(grams(points).ravel(), minlength=GRAM_CLASSES)
        seen = np.flatnonzero(total)
        yield c.record(schema, [seen, total[seen]])

    out = np.zeros(GRAM_CLASSES, np.int64)
    for gram, n in c.map_arrow(words.select("word"), run, "gram long, n long").groupBy("gram").agg(F.sum("n")).collect():
        out[gram] = n
    return out


def choose_pivots(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row the two disjoint positions with the least sum of weights, by
    dynamic programming from left to right over the best single gram so far."""
    rows, n = weight.shape
    one, one_at = np.full(rows, _NEVER), np.zeros(rows, np.int64)
    two, left, right = np.full(rows, 2 * _NEVER), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for p in range(2, n):
        better = weight[:, p - 2] < one
        one[better], one_at[better] = weight[better, p - 2], p - 2
        better = one + weight[:, p] < two
        two[better] = (one + weight[:, p])[better]
        left[better], right[better] = one_at[better], p
    return left, right


class _Keys:
    """Keys of words by gram place and equal parts: of ``x`` code points from the
    start and ``y`` from the end. ``place`` counts from the side that an edit on
    the other one does not move."""

    def __init__(self, points: np.ndarray):
        rows, n = points.shape
        self.head = np.zeros((rows, n + 1), np.uint64)
        self.tail = np.zeros((rows, n + 1), np.uint64)
        letters = c.mix(points.astype(np.uint64) + np.uint64(1))
        for i in range(n):
            self.head[:, i + 1] = self.head[:, i] * np.uint64(0x9E3779B97F4A7C15) + letters[:, i]
            self.tail[:, i + 1] = self.tail[:, i] * np.uint64(0xC2B2AE3D27D4EB4F) + letters[:, n - 1 - i]
        self.out_row, self.out_key = [], []

    def add(self, kind: int, row: np.ndarray, place: np.ndarray, x, y, where) -> None:
        row, place, x, y = (np.broadcast_to(v, row.shape)[where].astype(np.int64) for v in (row, place, x, y))
        h = c.mix(self.head[row, x] + c.mix((4 * x + kind).astype(np.uint64)))
        h = c.mix(h + self.tail[row, y] + c.mix((y << 32 | place).astype(np.uint64)))
        self.out_row.append(row)
        self.out_key.append(h.view(np.int64))

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(self.out_row), np.concatenate(self.out_key)


def prefix_keys(points: np.ndarray, row: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the grams at ``p``: an edit in the first or second half of
    what is left of the gram, or of what is right of it."""
    n, keys = points.shape[1], _Keys(points)
    half = p // 2
    keys.add(0, row, n - p, 0, n - half, half > 0)
    keys.add(1, row, n - p, half, n - p, np.ones(len(p), bool))
    rest = n - p - 2
    half = rest // 2
    keys.add(2, row, p, p + 2 + half, 0, np.ones(len(p), bool))
    keys.add(3, row, p, p + 2, rest - half, half > 0)
    return keys.found()


def pivot_keys(points: np.ndarray, row: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of pivots at ``p``: the keys that the words one edit away have
    there. Their edited side is one longer, one shorter or as long, so its halves
    have two lengths each."""
    n, keys = points.shape[1], _Keys(points)
    rest = n - p - 2
    for more in (0, 1):
        second = p // 2 + more
        keys.add(0, row, n - p, 0, n - p + second, (second > 0) & (second <= p))
        first = (p + 1) // 2 - more
        keys.add(1, row, n - p, first, n - p, first >= 0)
        first = (rest + 1) // 2 - more
        keys.add(2, row, p, p + 2 + first, 0, first >= 0)
        second = rest // 2 + more
        keys.add(3, row, p, p + 2, second, (second > 0) & (second <= rest))
    return keys.found()


def gram_index(words: DataFrame, counts: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """(key, id, word, reach) of the gram prefixes, where ``word`` is null if it is
    longer than CARRIED, and of the pivots of ``words`` (id, word). ``reach`` is the
    rank of the prefix's last gram; grams as rare as that one all belong to it."""
    order = np.lexsort((np.arange(GRAM_CLASSES), counts))
    rank = np.empty(GRAM_CLASSES, np.int64)
    rank[order] = np.arange(GRAM_CLASSES)
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("word", pa.string()), ("reach", pa.int32())])

    def reader(pivots: bool):
        def run(batches):
            for batch in c.sliced(batches, 4096):
                ids, words = batch.column("id").to_numpy(zero_copy_only=False), batch.column("word").to_pylist()
                for at, points in by_length(words):
                    gram = grams(points)
                    ranks = rank[gram]
                    reach = np.partition(ranks, 2, axis=1)[:, 2]
                    prefix = ranks <= reach[:, None]
                    carried = [words[i] for i in at.tolist()]
                    if pivots:
                        ends = choose_pivots(np.where(prefix, counts[gram], _NEVER))
                        row, key = pivot_keys(points, np.tile(np.arange(len(at)), 2), np.concatenate(ends))
                    else:
                        row, key = prefix_keys(points, *np.nonzero(prefix))
                        if points.shape[1] > CARRIED:
                            carried = [None] * len(at)
                    texts = pa.array(carried, pa.string()).take(pa.array(row))
                    yield c.record(schema, [key, ids[at[row]], texts, reach[row].astype(np.int32)])
        return run

    return tuple(c.map_arrow(words.select("id", "word"), reader(pivots), "key long, id long, word string, reach int")
                 for pivots in (False, True))


# ---------------------------------------------------------------- variants

def near_words(words: DataFrame) -> DataFrame:
    """(a, b) with a < b: all pairs of distinct words one inserted, deleted or
    replaced code point apart, each once. ``words`` has id (unique) and word, of
    at least four code points, as a table that reads the same each time."""
    prefixes, pivots = gram_index(words, gram_counts(words))
    one_edit = F.levenshtein("a", "b", 1) == 1
    met = (pivots.alias("p").join(prefixes.alias("r"), "key").where("p.reach <= r.reach AND p.id <> r.id")
           .selectExpr("p.word AS a", "r.word AS b", "CASE WHEN r.word IS NULL THEN r.id END AS id")
           .where(F.col("b").isNull() | one_edit))
    long_words = words.where(F.length("word") > CARRIED).select("id", F.col("word").alias("whole"))
    near = met.join(long_words, "id", "left").withColumn("b", F.coalesce("b", "whole")).where(one_edit)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def variant_forms(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """Spelling variants among ``words`` (word, n): their columns with form, root,
    n_near and form_n.

    ``form`` is the near word (one edit away) of largest n, ties to the smallest in
    code-point order, if its n is at least ``factor`` times the word's own; else
    null, and form_n with it. ``root`` follows the forms to the last one; a word
    without a form is its own. ``n_near`` counts the near words. Counts of repeated
    words are added up; words shorter than four code points raise an error in the
    job; nulls and an empty table give no rows; other columns are dropped.

    A form has ``factor`` times the count, so chains are at most log(n) long and
    doubling reaches their ends in as many rounds as that has bits.
    """
    if factor < 2:
        raise ValueError("a form is more frequent than its variant")
    spark = words.sparkSession
    once = words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    listed = materialize(once.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")
    near = materialize(near_words(listed), "near")
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other")).union(near.select("b", "a"))
    counts = listed.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = both.join(counts, "other").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word"))).alias("best"))
    formed = listed.join(best, "word", "left")
    is_form = -F.col("best.n") >= factor * F.col("n")
    formed = materialize(formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"),
        F.when(is_form, -F.col("best.n")).alias("form_n")), "forms")
    largest = formed.agg(F.max("n")).first()[0] or 1
    at = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(2.0, math.log(max(largest, 2), factor) + 1)))):
        step = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = materialize(at.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    c.release(spark)
    return (formed.join(at, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def group_spellings(docs: DataFrame, drop_every: int | None = None, least_length: int = LEAST_LENGTH,
                    least_count: int = LEAST_COUNT, factor: int = FACTOR) -> DataFrame:
    """Spelling variants of the words of ``docs``: see ``vocabulary`` for the words
    and ``variant_forms`` for the columns."""
    if least_length < 4:
        raise ValueError("words need three bigrams for their prefix")
    return variant_forms(vocabulary(docs, drop_every, least_length, least_count), factor)
