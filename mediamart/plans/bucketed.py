"""The star in buckets: a wide join beyond broadcast that never moves the fact.

A fact has four keys and can be partitioned by one. Here it is bucketed by a
``slot`` that follows the user key, and every dimension is written where the fact
rows that need it lie: users, which are many, once in their slot (once in each of
its slots for a user whose events are split), and the others in the slots whose fact
rows name them, so their copies are no more than the fact's rows, however many slots
there are. All four joins are then on (slot, key) between tables bucketed and sorted
alike: no side is exchanged, and the rows of a hot movie or place are spread with the
users.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.facts import wide_streams
from ..operators.joins import HOT_KEY_ROWS, hot_keys
from ..session import materialize

SLOT = "slot"
KEYS = {"fact": "userKey", "users": "userKey", "movies": "movieKey", "locations": "locationKey", "hours": "dateKey"}
FACT_KEYS = {"movies": "videoKey", "locations": "locationKey", "hours": "dateKey"}


@dataclass
class BucketedStar:
    """Names of the written tables in the session's catalogue."""
    tables: dict[str, str]


def slots(spark: SparkSession, buckets: int) -> list[int]:
    """One number for each bucket that Spark's bucketing puts there (it hashes
    numbers, so 0 to n - 1 would fall unevenly)."""
    candidates = spark.range(40 * buckets).select(F.col("id").cast("int").alias(SLOT))
    found = candidates.groupBy(F.pmod(F.hash(SLOT), F.lit(buckets)).alias("b")).agg(F.min(SLOT).alias(SLOT)).collect()
    if len(found) < buckets:
        raise ValueError(f"{buckets} buckets are too many to number")
    return [r[SLOT] for r in sorted(found, key=lambda r: r["b"])]


def write_bucketed_star(fact: DataFrame, users: DataFrame, movies: DataFrame, locations: DataFrame, hours: DataFrame,
                        root: str, prefix: str, buckets: int, hot_rows: int = HOT_KEY_ROWS) -> BucketedStar:
    """Write the fact and its dimensions bucketed by slot and sorted by their keys,
    as tables ``{prefix}_fact`` and so on under ``root``.

    ``fact`` must be a repeatable read (a written table), since a row's place
    decides the slot of a hot user's event. Rows without a user key, which an
    inner join drops, lie in slots by their place. Movies, places and hours that no
    fact row names lie in one slot each, so that every row of a dimension is there.
    """
    spark = fact.sparkSession
    number = F.array(*[F.lit(s) for s in slots(spark, buckets)])
    at = lambda i: F.element_at(number, F.pmod(i, F.lit(buckets)).cast("int") + 1)
    home = F.xxhash64("userKey")
    hot = materialize(hot_keys(fact.where("userKey IS NOT NULL"), ["userKey"], hot_rows), "hot-users")
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    place = F.xxhash64(F.monotonically_increasing_id())
    written: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> None:
        written[name] = f"{prefix}_{name}"
        (df.drop("_place", "_parts", "_part").repartition(buckets, SLOT)
           .write.bucketBy(buckets, SLOT).sortBy(SLOT, KEYS[name])
           .option("path", f"{root}/{name}").mode("overwrite").saveAsTable(written[name]))

    write("fact", fact.withColumn("_place", place).join(hot, "userKey", "left")
                      .withColumn(SLOT, at(F.when(F.col("userKey").isNull(), F.col("_place")).otherwise(home + F.pmod("_place", parts)))))
    write("users", users.join(hot, "userKey", "left")
                        .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.least(parts, F.lit(buckets)) - 1)))
                        .withColumn(SLOT, at(home + F.col("_part"))))
    placed = spark.table(written["fact"])
    for name, df in (("movies", movies), ("locations", locations), ("hours", hours)):
        key = KEYS[name]
        needed = placed.select(SLOT, F.col(FACT_KEYS[name]).alias(key)).distinct()
        write(name, df.join(needed, key, "left").withColumn(SLOT, F.coalesce(SLOT, at(F.xxhash64(key)))))
    return BucketedStar(written)


def wide_of_buckets(spark: SparkSession, star: BucketedStar) -> DataFrame:
    """The wide view over a bucketed star, read by a session of its own in which a
    bucketing by slot alone serves joins on (slot, key)."""
    own = spark.newSession()
    for key, value in (("spark.sql.session.timeZone", "UTC"), ("spark.sql.requireAllClusterKeysForCoPartition", "false"),
                       ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
                       ("spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))):
        own.conf.set(key, value)
    t = {name: own.table(table) for name, table in star.tables.items()}
    return wide_streams(t["fact"], t["users"], t["movies"], t["locations"], t["hours"], within=[SLOT])
