"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture, hence a mean repetition rate:
target rows / observed rows. A document's number of copies is a Poisson draw with
that mean, found by inversion from a uniform number hashed from the document and
the seed; so it needs no coordination between tasks and repeats exactly. Copies
are exploded and shuffled globally by a hashed key.

Rates over PIECE_RATE are drawn as a sum of that many smaller Poisson draws, so
any rate is exact in doubles. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mediamart.session import materialize

PIECE_RATE = 16.0
STEPS = 100  # P(Poisson(16) > 100) < 1e-45: beyond what a double can tell
BROADCAST_SOURCES = 2000
SALTS = 64


def _uniform(*parts: Column) -> Column:
    """52 bits of an md5 as a number in [0, 1)."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def _source(docs: DataFrame) -> Column:
    return F.coalesce(F.concat(F.lit("="), docs["source"].cast("string")), F.lit("null"))


def repetition_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
                     epochs: float = 1.0) -> DataFrame:
    """(source_key, n_docs, rate, pieces, cdf) of every source.

    ``weights`` gives shares by source (absent sources 0); without it a source's
    share follows n_docs ** temperature. The mixture has ``epochs`` times the
    input's rows on average.
    """
    counts = materialize(docs.groupBy(_source(docs).alias("source_key")).agg(F.count("*").alias("n_docs")), "sources")
    if weights is None:
        weight = F.pow(F.col("n_docs").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source_key") == f"={name}", float(value)).otherwise(weight)
    total = counts.select(F.sum("n_docs").alias("n")).first()["n"] or 0
    known = counts.withColumn("weight", weight)
    # Added up as decimals: a sum of doubles depends on its order.
    whole = known.select(F.sum(F.col("weight").cast("decimal(38,12)")).cast("double").alias("w")).first()["w"] or 1.0
    rate = F.col("weight") / F.lit(whole) * F.lit(float(epochs) * total) / F.col("n_docs")
    rated = known.withColumn("rate", rate).withColumn("pieces", F.greatest(F.ceil(F.col("rate") / PIECE_RATE), F.lit(1)).cast("int"))
    mean = F.col("rate") / F.col("pieces")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf"))
    law = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), start,
        lambda s, k: F.struct((s["p"] * mean / k).alias("p"),
                              F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * mean / k)).alias("cdf")))
    return materialize(rated.withColumn("cdf", law["cdf"]).drop("weight"), "rates")


def poisson_mixture(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = 0.5,
                    epochs: float = 1.0, seed: int = 7) -> DataFrame:
    """``docs`` with every row repeated by its Poisson draw and shuffled; adds
    ``copy`` (1 to the row's number of copies).

    The draw is hashed from seed, doc_id and text, nulls hashed as such, so rows
    equal in both get equal counts. A null source is a source of its own. A column
    named ``copy`` is replaced. An empty table gives no rows.
    """
    names = [x for x in docs.columns if x != "copy"]
    rates = repetition_rates(docs, weights, temperature, epochs)
    identity = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                           F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("null")))
    rows = docs.select(F.struct(*names).alias("row"), _source(docs).alias("source_key"), F.md5(identity).alias("identity"))
    rates = rates.select("source_key", "pieces", "cdf")
    if rates.count() <= BROADCAST_SOURCES:  # a row a source, about 1 kB each
        rated = rows.join(F.broadcast(rates), "source_key")
    else:  # a hot source is dealt over SALTS parts
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("identity"), F.lit(SALTS)).cast("int"))
        rated = rows.join(rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["source_key", "salt"])
    draws = F.transform(F.sequence(F.lit(1), F.col("pieces")), lambda j: _uniform(F.col("identity"), j.cast("string")))
    rated = rated.withColumn("draws", draws)
    copies = F.aggregate("draws", F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda p: p <= u)))
    mixed = (rated.withColumn("copies", copies).where("copies > 0")
             .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
             .select("row", "copy", F.md5(F.concat_ws(":", F.col("identity"), F.col("copy").cast("string"), F.lit("order"))).alias("order")))
    return mixed.repartition("order").sortWithinPartitions("order").select("row.*", "copy")
