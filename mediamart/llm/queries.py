"""The registered queries of the text operators and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mediamart.llm import (decontaminate, fingerprints, language_id, license_scan, mixing, near_dup, paragraph_dedup,
                           repetition, secret_scan, sharding, spelling, suffix_dedup, toxicity)
from mediamart.llm.common import table
from mediamart.llm.oracle_sql import NEAR_SQL, RUNS_SQL, SPELLING_SQL


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), percent=85, bands=24, rows=6)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), shards=16)
    return rows.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_dedup.repeated_units(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mixture(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """The contract's edit: in documents whose h = crc32(decimal doc_id) is a
    multiple of 10, the words from the a-th on go on with a period of p words."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    edited = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.coalesce(n > 0, F.lit(False)), edited)
                       .otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), "top.length",
        (-F.col("top.period")).alias("period"),
        F.floor(1000 * F.col("top.length") / -F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"), "n_words")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.transform(F.filter("matches", lambda m: m["kind"] == "base"), lambda m: m["word"])
    labels = license_scan.labels_of
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base).alias("first_word"),
        F.array_max(base).alias("last_word"), F.array_join(labels("matches", "base"), ",").alias("base_labels"),
        F.array_join(labels("matches"), ",").alias("labels"), "score", "duty",
        F.transform("expressions", lambda e: e["postfix"]).alias("expressions"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"), drop_every=31)


QUERIES = {f.__name__: f for f in (
    op1_near_duplicates, op2_suffix_dedup, op3_sharding, op4_secret_scan, op5_toxicity, op6_paragraph_dedup,
    op7_language_id, op8_decontamination, op9_mixing, op10_fingerprints, op11_periodic_runs,
    op12_license_scan, op13_spelling_variants)}

# The draw of operator 9, told in SQL. The shuffled order has no place in a bag of rows.
MIXING_SQL = """
WITH d AS (
  SELECT *, coalesce('=' || source, 'null') AS source_key,
         md5('7:' || coalesce(doc_id::VARCHAR, 'null') || ':' || coalesce(md5(text), 'null')) AS identity
  FROM documents
), n AS (SELECT source_key, count(*) AS n_docs FROM d GROUP BY 1),
w AS (SELECT *, pow(n_docs::DOUBLE, 0.5) AS weight FROM n),
r AS (
  SELECT source_key, weight / (SELECT sum(weight::DECIMAL(38, 12))::DOUBLE FROM w)
                     * (SELECT sum(n_docs)::DOUBLE FROM w) / n_docs AS rate
  FROM w
), l AS (SELECT *, greatest(ceil(rate / 16.0), 1)::INT AS pieces FROM r),
p AS (
  SELECT source_key, pieces, k, exp(-rate / pieces + k * ln(rate / pieces) - lgamma(k + 1)) AS p
  FROM l, generate_series(0, 100) AS g(k)
), c AS (
  SELECT source_key, pieces, k, sum(p) OVER (PARTITION BY source_key ORDER BY k) AS cdf FROM p
), cdf AS (SELECT source_key, pieces, list(cdf ORDER BY k) AS cdf FROM c GROUP BY 1, 2),
u AS (
  SELECT d.*, cdf,
         list_transform(generate_series(1, pieces),
           lambda j: ('0x' || substr(md5(identity || ':' || j), 1, 13))::BIGINT / 4503599627370496.0) AS draws
  FROM d JOIN cdf USING (source_key)
), k AS (
  SELECT *, list_sum(list_transform(draws, lambda x: len(list_filter(cdf, lambda q: q <= x)))) AS copies FROM u
)
SELECT doc_id, text, lang, source, n_chars, unnest(generate_series(1, copies::BIGINT))::INT AS "copy"
FROM k WHERE copies > 0
"""

ORACLE: dict[str, str] = {"op1_near_duplicates": NEAR_SQL, "op9_mixing": MIXING_SQL, "op11_periodic_runs": RUNS_SQL,
                          "op13_spelling_variants": SPELLING_SQL}
