"""Join building blocks: size-checked broadcast and the as-of (interval) join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# A dimension is broadcast on purpose only where its rows, at the width of its
# schema, fit into this. Above it the planner's own size check (and AQE's
# runtime conversion) decides.
BROADCAST_MAX_BYTES = 128 << 20
STRING_BYTES = 64   # assumed width of a text cell, header included

# A join key with more rows than this on the big side is split into
# ceil(rows / HOT_KEY_ROWS) salted parts.
HOT_KEY_ROWS = 2_000_000


def row_bytes(df: DataFrame) -> int:
    """Width of a row by its schema: texts at STRING_BYTES, others at 8 bytes."""
    return sum(STRING_BYTES if t == "string" else 8 for _, t in df.dtypes)


def bounded_broadcast(df: DataFrame, row_bound: int | None,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its proven row bound times its width fits.

    ``row_bound`` must be an upper bound known without running the data: the
    length of a generated spine, or the row count of an already written table.
    Without one, or beyond ``max_bytes``, the DataFrame is returned unchanged
    so that a shuffle join (sort-merge, AQE skew-split) remains the way beyond
    the limit.
    """
    if row_bound is not None and row_bound * row_bytes(df) <= max_bytes:
        return F.broadcast(df)
    return df


def hot_keys(big: DataFrame, keys: Sequence[str], hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """(keys..., ``_parts``) of every key with more than ``hot_rows`` rows, from one
    partially aggregated count. Write it before giving it to a join, so that it
    is counted once and the planner knows its size."""
    n = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    return n.select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("long").alias("_parts"))


def hot_key_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str,
                 hot: DataFrame | None) -> DataFrame:
    """``big.join(small, keys, how)`` with the ``hot`` keys of ``big`` salted.

    ``hot`` is a written ``hot_keys`` table (None: plain join, whose skew AQE
    splits where both sides are bare shuffles). A hot key's rows are dealt over
    its parts by their place in ``big``, so equal rows part too; the small side's
    rows of that key are repeated once per part. Other keys keep salt 0 and a
    single copy. There is no bound on keys or parts; whether ``hot`` is broadcast
    is the planner's choice by its size. ``big`` must be a repeatable read
    (a table), since a row's place decides its salt.
    """
    keys = list(keys)
    if hot is None:
        return big.join(small, keys, how)
    placed = big.withColumn("_place", F.monotonically_increasing_id())
    salted_big = (placed.join(hot, keys, "left")
                        .withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("_place"), F.col("_parts")), F.lit(0)))
                        .drop("_parts", "_place"))
    copies = (small.join(hot, keys, "left")
                   .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
                   .drop("_parts"))
    return salted_big.join(copies, keys + ["_salt"], how).drop("_salt")


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], point: str,
                  start: str, end: str, take: Sequence[str], how: str = "left",
                  hot: DataFrame | None = None, chain: Sequence[str] | None = None, open_end=None) -> DataFrame:
    """As-of join: ``left`` rows to ``right`` rows of the same keys whose
    half-open interval [start, end) holds ``left[point]``.

    Same rows as ``left JOIN right ON keys = keys AND start <= point < end``,
    but the range predicate is evaluated once per distinct (keys, point)
    pair, not per left row:

    1. ``pairs`` = distinct (keys, point) of the left side (partial aggregation
       first, so the shuffle is small even for a hot key);
    2. pairs to right rows -> (keys, point, take...); empty intervals are dropped
       first, they can never match;
    3. left x that mapping on the equi-key (keys, point), salted for the pairs in
       ``hot`` (a written ``hot_keys(left, keys + [point])``): the mapping
       side is not a bare shuffle, so AQE's skew split would not apply.

    With ``chain`` the caller vouches that closed intervals of the same keys and
    chain columns never overlap (the history of one entity). Step 2 is then a sweep
    (``sweep_join``) that reads points and intervals once each; only rows that stay
    open to ``open_end`` or beyond meet the pairs by their start. Without it every
    pair is held against every interval of its keys.

    Nothing runs while the plan is built and nothing stays cached.
    """
    keys = list(keys)
    pairs = left.select(*keys, point).distinct()
    r = right.filter(F.col(end) > F.col(start))
    held = [(r, [F.col(point) >= F.col("_start"), F.col(point) < F.col("_end")])]
    mapping = None
    if chain is not None:
        mapping = sweep_join(pairs, r.filter(F.col(end) < F.lit(open_end)), keys, point, start, end, take, chain)
        held = [(r.filter(F.col(end) >= F.lit(open_end)), held[0][1])]
    for rows, cond in held:
        side = rows.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
                           F.col(start).alias("_start"), F.col(end).alias("_end"), *[F.col(t) for t in take])
        equal = [F.col(k) == F.col(f"_r{i}") for i, k in enumerate(keys)]
        found = pairs.join(side, equal + cond, "inner").select(*keys, point, *take)
        mapping = found if mapping is None else mapping.unionByName(found)
    return hot_key_join(left, mapping, keys + [point], how, hot)


def sweep_join(pairs: DataFrame, intervals: DataFrame, keys: Sequence[str], point: str, start: str, end: str,
               take: Sequence[str], chain: Sequence[str], bucket: str = "year") -> DataFrame:
    """(keys, point, take...) of the intervals [start, end) that hold the distinct
    ``pairs`` (keys, point), where intervals of one chain never overlap.

    Points and interval starts of a chain are one ordered stream, in which a point
    takes the last start at or before it, if that interval has not ended. The
    stream is cut into time buckets: the last start of a bucket is carried into the
    later ones over one summary row each. A point is read once per chain of its
    keys and an interval once; none is held against all of the others. Null keys
    and null points match nothing.
    """
    keys = list(keys)
    group = [*keys, "_chain"]
    s = intervals.select(*keys, F.struct(*chain).alias("_chain"), F.col(start).alias("_at"),
                         F.struct(F.col(end).alias("_end"), *take).alias("_open"))
    p = pairs.join(s.select(*group).distinct(), keys).withColumnRenamed(point, "_at").where("_at IS NOT NULL")
    stream = (s.withColumn("_point", F.lit(0)).unionByName(p.withColumn("_point", F.lit(1)), allowMissingColumns=True)
               .withColumn("_bucket", F.date_trunc(bucket, F.col("_at"))).repartition(*keys, "_chain", "_bucket"))
    so_far = Window.partitionBy(*group, "_bucket").orderBy("_at", "_point").rowsBetween(Window.unboundedPreceding, 0)
    stream = stream.withColumn("_here", F.last("_open", ignorenulls=True).over(so_far))
    latest = F.max(F.when(F.col("_point") == 0, F.struct("_at", "_open")))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (stream.groupBy(*group, "_bucket").agg(latest.alias("_latest"))
                     .withColumn("_before", F.last("_latest", ignorenulls=True).over(before))
                     .select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(group)], F.col("_bucket").alias("_rb"), "_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(group)] + [F.col("_bucket") == F.col("_rb")]
    found = (stream.where("_point = 1").join(carried, same)
                   .withColumn("_found", F.coalesce("_here", F.col("_before._open"))).where("_at < _found._end"))
    return found.select(*keys, F.col("_at").alias(point), *[F.col(f"_found.{t}").alias(t) for t in take])
