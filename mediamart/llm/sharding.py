"""Uniform shuffle into shards of exact sizes by a hypergeometric matrix.

Rows lie in blocks (a seeded hash of the row). How many rows of each block go
to each target is drawn from the multivariate hypergeometric law whose margins
are the block counts and the exact target sizes: that is the law a uniformly
random permutation has, so permuting within the block, sending by the drawn
counts, and permuting again within the target gives a uniform shuffle, and
the sizes are exact by construction.

What is permuted and sent are row ids (two hashes of the row), so a block or a
target is sorted in little memory however long the texts are; the rows themselves
move once, to meet their places. A target is an equal part of a shard, and the
slot where it begins is known beforehand. Blocks and targets follow from the
number of rows alone. The matrix is drawn in two levels: a bounded number of
block groups on the driver, the blocks of each group in Spark.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from mediamart.llm import common as c
from mediamart.session import materialize

ROWS_PER_BLOCK = 1_000_000  # of 40 bytes each; more where that makes over MOST_BLOCKS blocks
LEAST_BLOCKS, MOST_BLOCKS = 64, 4096
MAX_GROUPS = 256
COPIES_PER_TASK = 10_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Number of good ones among ``draws`` without replacement, by inversion
    around the mean; no bound on the population. Beyond 12 standard deviations
    the law has less mass than a double can tell."""
    lo, hi = max(0, draws - bad), min(draws, good)
    if lo >= hi:
        return lo
    total = good + bad
    mean = draws * good / total
    sd = (mean * (bad / total) * ((total - draws) / max(total - 1, 1))) ** 0.5
    a, b = max(lo, int(mean - 12 * sd) - 20), min(hi, int(mean + 12 * sd) + 20)
    k = np.arange(a, b, dtype=float)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    log_p = np.r_[0.0, np.cumsum(steps)]
    cdf = np.cumsum(np.exp(log_p - log_p.max()))
    return a + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right").clip(0, b - a))


def communication_matrix(rng: np.random.Generator, rows: list[int], columns: list[int]) -> list[list[int]]:
    """Random matrix with exactly these row and column sums (equal totals)."""
    left, out = [int(x) for x in columns], []
    for n in rows:
        n, rest, line = int(n), sum(left), []
        for j, room in enumerate(left):
            rest -= room
            x = hypergeometric(rng, room, rest, n) if n else 0
            line.append(x)
            n -= x
            left[j] -= x
        out.append(line)
    return out


def even_sizes(total: int, parts: int) -> list[int]:
    return [total // parts + (i < total % parts) for i in range(parts)]


def row_ids(docs: DataFrame, seed: int, identity: tuple[str, ...]) -> DataFrame:
    """(first, second, row): two hashes of the identity columns, and the whole row."""
    names = [x for x in docs.columns if x not in ("shard", "slot")]
    return docs.select(F.xxhash64(*identity, F.lit(seed)).alias("first"), F.xxhash64(F.lit(seed + 1), *identity).alias("second"),
                       F.struct(*names).alias("row"))


def every_copy(ids: DataFrame) -> DataFrame:
    """(first, second, nth) for nth from 1 to the ``n`` of every id, whose numbers are
    made in as many tasks as there are COPIES_PER_TASK of them."""
    few, many = ids.where(F.col("n") <= COPIES_PER_TASK), ids.where(F.col("n") > COPIES_PER_TASK)
    chunk = many.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"), F.lit(COPIES_PER_TASK).cast("long"))))
    chunk = chunk.repartition("first", "second", "from")
    number = lambda a, b: F.explode(F.sequence(a, b)).alias("nth")
    return few.select("first", "second", number(F.lit(1).cast("long"), F.col("n"))).unionByName(
        chunk.select("first", "second", number(F.col("from"), F.least("n", F.col("from") + COPIES_PER_TASK - 1))))


def draw_places(ids: DataFrame, shards: int, seed: int) -> DataFrame:
    """(first, second, nth, shard, slot): a place for each copy of each row id.
    ``ids`` is a table of (first, second, n)."""
    total = ids.agg(F.sum("n")).first()[0] or 0
    blocks = min(MOST_BLOCKS, max(LEAST_BLOCKS, -(-total // ROWS_PER_BLOCK)))
    group = -(-blocks // MAX_GROUPS)  # blocks a group
    fine = -(-blocks // shards)
    sizes = [even_sizes(n, fine) for n in even_sizes(total, shards)]
    targets = [x for s in sizes for x in s]
    starts = [x for s in sizes for x in np.r_[0, np.cumsum(s)[:-1]].astype(int).tolist()]

    rows = every_copy(ids).withColumn("block", F.pmod(F.xxhash64("first", "second", "nth"), F.lit(blocks)).cast("int"))
    counts = rows.groupBy("block").agg(F.count("*").alias("n")).withColumn("group", F.floor(F.col("block") / group).cast("int"))
    per_group = {r["group"]: r["n"] for r in counts.groupBy("group").agg(F.sum("n").alias("n")).collect()}
    order = sorted(per_group)
    drawn = communication_matrix(np.random.default_rng(seed), [per_group[g] for g in order], targets)
    share = dict(zip(order, drawn))

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        g = int(pdf["group"].iloc[0])
        matrix = communication_matrix(np.random.default_rng([seed, g]), pdf["n"].tolist(), share[g])
        return pd.DataFrame({"block": pdf["block"], "ends": [np.cumsum(line).tolist() for line in matrix]})

    ends = counts.groupBy("group").applyInPandas(split, "block int, ends array<long>")

    def permuted(by: str, salt: int) -> "F.Column":
        mixed = F.xxhash64("first", "second", "nth", F.lit(seed), F.lit(salt))
        return F.row_number().over(Window.partitionBy(by).orderBy(mixed, "first", "second", "nth")) - 1

    sent = (rows.withColumn("place", permuted("block", 1)).join(ends, "block")
                .withColumn("target", F.size(F.filter("ends", lambda e: e <= F.col("place")))))
    start = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in starts]), F.col("target") + 1)
    return sent.select("first", "second", "nth", F.floor(F.col("target") / fine).cast("int").alias("shard"),
                       (start + permuted("target", 2)).cast("long").alias("slot"))


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 11,
                        identity: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0
    within the shard); shard counts differ by one at most.

    The same rows and seed give the same result whatever their order, their
    partitions and the session's shuffle width; rows equal in the columns of
    ``identity`` are interchangeable, in any number. Nulls are hashed like values,
    all columns are moved whole and once, however long, columns of the input named
    ``shard`` or ``slot`` are replaced, and an empty table gives no rows. ``docs`` is
    read twice (its ids, then its rows) and must read the same.
    """
    spark = c.prepare(docs.sparkSession)
    rows = row_ids(docs, seed, identity)
    ids = materialize(rows.groupBy("first", "second").agg(F.count("*").alias("n")), "row-ids")
    places = materialize(draw_places(ids, shards, seed), "places")
    c.release(spark)
    key = ["first", "second"]
    crowds = materialize(ids.where(F.col("n") > COPIES_PER_TASK).select(*key, "n"), "crowds")
    crowded = not crowds.isEmpty()
    few, few_places = (x.join(crowds, key, "left_anti") if crowded else x for x in (rows, places))
    # Rows move once, by their id; copies are numbered where they meet and take a place each.
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))
    listed = few_places.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("nth", "shard", "slot"))).alias("places"))
    place = F.element_at("places", F.col("nth").cast("int"))
    found = (few.withColumn("nth", nth).join(listed, key).withColumn("place", place)
                .select("row", F.col("place.shard").alias("shard"), F.col("place.slot").alias("slot")))
    if crowded:
        # Crowds of copies are numbered in parts of bounded size, then over the parts.
        copies = (rows.withColumn("at", F.monotonically_increasing_id()).join(crowds, key)
                      .withColumn("part", F.pmod(F.xxhash64("at"), F.ceil(F.col("n") / COPIES_PER_TASK))))
        before = F.sum("m").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
        parts = copies.groupBy(*key, "part").agg(F.count("*").alias("m")).select(*key, "part", F.coalesce(before, F.lit(0)).alias("before"))
        numbered = copies.withColumn("within", F.row_number().over(Window.partitionBy(*key, "part").orderBy("at")))
        numbered = numbered.join(parts, [*key, "part"]).withColumn("nth", F.col("before") + F.col("within"))
        found = found.unionByName(numbered.join(places, [*key, "nth"]).select("row", "shard", "slot"))
    return found.select("row.*", "shard", "slot")
