"""Bind the driver's tables to the reference's entities.

The test tables (``events``, ``customer``, ``nation``, ``part``) hold none of
the pipeline's entities, so they are derived here, in Spark, and the DuckDB
oracle repeats the same derivation (``mediamart/plans/oracle_sql.py``):

* raw event feeds: every event is a watch event; clicks are also ad events,
  views page-view events, sign-ups and errors auth events. The user is the
  customer, the place is the customer's nation, the video is a part.
* seed ``state_codes``: one code per nation name; nations 23 and 24 are left
  out on purpose so that some event states have no code (D13 in SURVEY).
* movie catalogue: one movie per part; the sixteen genres take turns by part key, and
  vote counts are spelled ``100.0`` with gaps, as a column of integers with gaps is.
* hourly folders: events of two years; one arrives zero to two hours after its
  time, and now and then without a time or with a wild one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path
from ..schemas import FEED_NAMES
from .files import GENRES, conform_movies, read_seed
from .registry import Sources

# Binding parameter: nations at or above SEED_NATIONS have no state code.
SEED_NATIONS = 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    videos = (p.agg(F.max("p_partkey")).first()[0] or 0) + 1   # one number: the key range
    cust = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return (e.join(cust, e.user_id == cust.c_custkey, "left")
             .join(p, (e.event_id % videos) == p.p_partkey, "left"))


def _when_not(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def _common(x: DataFrame) -> list[Column]:
    et = F.col("event_type")
    no_place = F.col("c_nationkey") == 0
    return [
        F.col("ts").alias("timestamp"),
        _when_not(et == "error",
                  F.concat(F.lit('"'), F.col("p_name"), F.lit('" #'),
                           F.col("p_partkey").cast("string"))).alias("videoTitle"),
        _when_not(et == "error", F.col("value")).alias("duration"),
        F.when(et == "error", F.lit(None)).when(et == "signup", F.lit("Logged Out"))
         .otherwise(F.lit("Logged In")).alias("auth"),
        F.when(et == "purchase", F.lit("paid")).otherwise(F.lit("free")).alias("level"),
        _when_not(no_place, F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))).alias("city"),
        _when_not(no_place, F.col("n_name")).alias("state"),
        _when_not(et == "error", F.concat(F.lit("agent-"), F.col("c_mktsegment"))).alias("userAgent"),
        _when_not(no_place, (F.col("c_nationkey") * F.lit(1.5) - F.lit(20)).cast("double")).alias("lon"),
        _when_not(no_place, (F.col("c_nationkey") * F.lit(0.5) + F.lit(25)).cast("double")).alias("lat"),
        F.col("user_id").alias("userId"),
        F.col("c_name").alias("lastName"),
        F.col("c_mktsegment").alias("firstName"),
        F.lit(None).cast("string").alias("dateOfBirth"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        # Changes inside a level run, and is missing now and then.
        F.when(F.col("event_id") % 5 != 0, F.lit(1_500_000_000_000) + F.col("event_id") % 3).alias("registration"),
    ]


def _device() -> list[Column]:
    bal = F.col("c_acctbal")
    return [
        F.when(bal < 0, F.lit(None)).when(bal < 5000, F.lit("mobile")).otherwise(F.lit("desktop"))
         .alias("deviceType"),
        F.when(bal < 0, F.lit(None)).when(bal < 2500, F.lit("android")).when(bal < 5000, F.lit("ios"))
         .otherwise(F.lit("windows")).alias("deviceOs"),
    ]


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four raw feeds from one materialised enrichment of the events."""
    from ..session import materialize
    x = materialize(_enriched_events(spark, sf_dir), "enriched-events")
    return {f: raw_feed(spark, sf_dir, f, enriched=x) for f in
            ("watch_events", "ad_events", "page_view_events", "auth_events")}


def raw_feed(spark: SparkSession, sf_dir: str, feed: str, enriched: DataFrame | None = None) -> DataFrame:
    """One raw event feed (raw column names, nulls still in place)."""
    x = enriched if enriched is not None else _enriched_events(spark, sf_dir)
    et, v = F.col("event_type"), F.col("value")
    common = _common(x)
    if feed == "watch_events":
        return x.select(*common)
    if feed == "ad_events":
        ad_type = (F.when(v < 5, F.lit(None)).when(v < 20, F.lit("banner"))
                   .otherwise(F.lit("video")).alias("adType"))
        return x.filter(et == "click").select(*common, ad_type)
    if feed == "page_view_events":
        return x.filter(et == "view").select(
            *common,
            F.when(v < 5, F.lit(None)).when(v < 20, F.lit("Home")).otherwise(F.lit("Browse")).alias("page"),
            F.when(v < 2, F.lit(None)).when(v < 30, F.lit("GET")).otherwise(F.lit("PUT")).alias("method"),
            F.when(v < 2, F.lit(None)).when(v < 40, F.lit(200)).otherwise(F.lit(307)).cast("bigint")
             .alias("status"),
            *_device())
    if feed == "auth_events":
        return x.filter(et.isin("signup", "error")).select(
            *common, *_device(),
            F.when(et == "signup", v >= 5).otherwise(F.lit(None)).alias("success"))
    raise KeyError(feed)


ODD_NATION = 7   # its code has a trailing space, as one code of a real seed has


def state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed: stateCode = nation name, for nations below SEED_NATIONS; written as a
    CSV and read as a seed is."""
    n = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") < SEED_NATIONS)
    code = F.when(F.col("n_nationkey") == ODD_NATION, F.concat("n_name", F.lit(" "))).otherwise(F.col("n_name"))
    rows = n.select(code.alias("stateCode"), F.concat(F.lit("State "), "n_name").alias("stateName"))
    path = scratch_path(spark, "seed")
    rows.write.option("header", True).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_seed(spark, path)


# Raw catalogue header, as the CSV files spell it (``gross(in $)`` included).
RAW_MOVIE_HEADER = ["movie_id", "movie_name", "year", "certificate", "runtime", "genre", "rating",
                    "description", "director", "director_id", "star", "star_id", "votes", "gross(in $)"]


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movie catalogue with the raw CSV header, one movie per part."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    return p.select(
        key.alias("movie_id"),
        F.concat(F.col("p_name"), F.lit(" #"), key).alias("movie_name"),
        F.col("p_size").cast("bigint").alias("year"),
        F.col("p_brand").alias("certificate"),
        F.concat(F.col("p_size").cast("string"), F.lit(" min")).alias("runtime"),
        F.element_at(F.array(*[F.lit(g) for g in GENRES]), (F.col("p_partkey") % len(GENRES)).cast("int") + 1).alias("genre"),
        F.col("p_retailprice").alias("rating"),
        F.col("p_name").alias("description"),
        F.col("p_brand").alias("director"),
        F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("nm")).alias("director_id"),
        F.col("p_name").alias("star"),
        F.concat(F.lit("st"), F.col("p_size").cast("string")).alias("star_id"),
        F.when(F.col("p_partkey") % 7 != 0, F.concat((F.col("p_size") * 100).cast("string"), F.lit(".0"))).alias("votes"),
        (F.col("p_retailprice") * F.lit(1000.0)).alias("gross(in $)"),
    )


def unlisted_columns(raw: DataFrame) -> DataFrame:
    """Raw movies with two columns outside the known ones: whole numbers with gaps, and
    truth values."""
    key = F.col("movie_id").cast("bigint")
    return (raw.withColumn("Release Week", F.when(key % 5 == 0, "NA").otherwise((key % 53).cast("string")))
               .withColumn("in colour?", F.when(key % 3 == 0, "True").otherwise("False")))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue as consumed by the movie dimension: sanitised names, typed."""
    return conform_movies(raw_movies(spark, sf_dir))


def arriving(feed: DataFrame) -> DataFrame:
    """A raw feed over two years with the time each row arrived: zero to two hours
    after its own, by its user and minute. On the first three days of a month users
    with odd ids come a year later. Of sixty rows one has lost its time, one has the
    time of a clock never set, and one is 400 days behind."""
    late = (F.col("userId") + F.minute("timestamp")) % 60
    year_later = F.when(F.dayofmonth("timestamp") <= 3, F.col("userId") % 2).otherwise(0).cast("int")
    own = F.col("timestamp") + F.make_ym_interval(year_later, F.lit(0))
    wild = (F.when(late == 0, F.lit(None)).when(late == 1, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
             .when(late == 2, own - F.make_dt_interval(F.lit(400))).otherwise(own))
    return (feed.withColumn("arrival", own + F.make_dt_interval(F.lit(0), (late % 3).cast("int")))
                .withColumn("timestamp", wild.cast("timestamp_ntz")))


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The derived sources by name: raw feeds, the seed, the catalogue."""
    named = Sources()
    for feed in FEED_NAMES:
        named.add(f"raw.{feed}", lambda s, feed=feed: raw_feed(s, sf_dir, feed))
    return (named.add("seeds.state_codes", lambda s: state_codes(s, sf_dir))
                 .add("imdb.raw_movies", lambda s: raw_movies(s, sf_dir)).add("imdb.movies", lambda s: movies(s, sf_dir)))
