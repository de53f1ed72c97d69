"""Incremental ingest of a raw feed as a Structured Streaming query."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans.hourly import load_batch
from ..schemas import raw_schema

MAX_FILES_PER_TRIGGER = 10_000
LEAP_YEARS = _dt.timedelta(days=8 * 366)   # long enough to hold every folder's hour, 29 February too


def start_feed_ingest(spark: SparkSession, raw_root: str, feed: str, table_path: str,
                      checkpoint: str, available_now: bool = True,
                      max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
                      as_of: _dt.datetime | None = None, ledger: str | None = None) -> StreamingQuery:
    """Stream new raw files of ``feed`` (hour folders under ``raw_root/feed``)
    through the null-fill into ``table_path``, laid out as the hourly loads do.

    The scheduler loop of the reference (one run per hour, each reading its
    own folder) becomes a file-source stream. The checkpoint remembers which
    files were seen, and the table's ledger which are loaded, so every file is
    staged exactly once: files that land late in a past hour's folder, batches
    given again after a failure and files an hourly load has taken included. A
    folder, which has no year, stands for its last hour up to ``as_of`` (a day after
    the batch unless given, for clocks that run ahead). ``available_now`` processes what is there, in
    batches of ``max_files_per_trigger`` files, and stops (a scheduled batch);
    otherwise it runs on. Stateless, so no watermark is needed.
    """
    schema = raw_schema(feed)
    for part in ("month", "day", "hour"):
        schema = schema.add(part, T.IntegerType())
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(f"{raw_root.rstrip('/')}/{feed}").withColumn("_name", F.col("_metadata.file_name"))

    def load(batch: DataFrame, batch_id: int) -> None:
        end = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None) + _dt.timedelta(days=1)
        load_batch(batch, raw_root, feed, table_path, end - LEAP_YEARS, end, ledger)

    writer = rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_feed_ingest(spark: SparkSession, raw_root: str, feed: str, table_path: str,
                    checkpoint: str, timeout_s: int | None = None, as_of: _dt.datetime | None = None) -> None:
    """Run one available-now ingest to completion (or for ``timeout_s`` at most)."""
    q = start_feed_ingest(spark, raw_root, feed, table_path, checkpoint, available_now=True, as_of=as_of)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"ingest of {feed} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
