"""The hourly staging run: one feed, one hour (or a backfill range) into staging."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import bounded_broadcast
from ..operators.staging import stage
from ..schemas import HOUR_COL, LOAD_COL, raw_schema, staged_schema
from ..session import materialize
from ..sources.files import day_folders, hours_between, read_folders, ts_literal
from ..sources.ledger import FILE_COL, PARTS, Ledger, assign_hours, file_key
from ..sources.sinks import ensure_table, read_table, write_hours

MODES = ("append", "overwrite", "once")
FILES_PER_TASK = 16


def ledger_of(spark: SparkSession, table_path: str, ledger: str | None = None) -> Ledger:
    """The ledger of a staging table: beside it, unless a path is given."""
    return Ledger(spark, ledger or f"{table_path.rstrip('/')}.ledger")


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.withColumn(FILE_COL, file_key(F.col("_name"))).drop("_name")


def _of_files(rows: DataFrame, feed: str, files: DataFrame) -> DataFrame:
    """Raw rows of the given files (a written table of file and load_hour, counted to
    check its size), with their load hour and file."""
    files = bounded_broadcast(files.select(FILE_COL, LOAD_COL), files.count())
    return rows.join(files, FILE_COL).select(*raw_schema(feed).fieldNames(), LOAD_COL, FILE_COL)


def _days_of(df: DataFrame) -> list[tuple[int, int]]:
    """The (month, day) folders of rows or claims: 366 at most."""
    return [tuple(r) for r in df.select("month", "day").distinct().collect()]


def _write(raw: DataFrame, feed: str, table_path: str, mode: str) -> None:
    schema = staged_schema(feed, with_hour=True, with_load=True)
    write_hours(stage(raw, feed, with_hour=True, keep=[LOAD_COL]), table_path, mode, schema, partition_by=[LOAD_COL])


def by_hour(raw: DataFrame, files: DataFrame) -> DataFrame:
    """Bring small files of an hour together before the write: FILES_PER_TASK raw
    files of an hour, whole ones, go to a task, however many the hour has."""
    tasks = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = files.groupBy(LOAD_COL).agg(F.ceil(F.count("*") / FILES_PER_TASK).alias("_parts"))
    parts = bounded_broadcast(parts, files.count())
    salt = F.pmod(F.xxhash64(FILE_COL), F.col("_parts"))
    return raw.join(parts, LOAD_COL).repartition(tasks, LOAD_COL, salt).drop("_parts")


def recover(spark: SparkSession, raw_root: str, feed: str, table_path: str, ledger: Ledger) -> bool:
    """Finish a run that broke off: the hours it had claimed files for are written
    anew with all their files. True if there was one."""
    pending = ledger.pending()
    if pending.isEmpty():
        return False
    days = _days_of(pending)
    hours = pending.select(LOAD_COL).distinct()
    files = ledger.claims(days).join(hours, LOAD_COL, "left_semi").unionByName(pending).dropDuplicates([FILE_COL])
    files = materialize(files, "claimed")
    if paths := day_folders(spark, raw_root, feed, days):
        _write(_of_files(_with_file(read_folders(spark, raw_root, feed, paths)), feed, files), feed, table_path, "overwrite")
    ledger.publish(again=days)
    return True


def load_hours(spark: SparkSession, raw_root: str, feed: str, table_path: str,
               start: _dt.datetime, end: _dt.datetime | None = None, mode: str = "append",
               ledger: str | None = None) -> bool:
    """Stage the raw hours [start, end) of ``feed`` into ``table_path``.

    With ``end`` omitted this is the reference's hourly run: one hour's
    folder. A longer range is a backfill in one job, not one job per hour.
    Steps: create the staging table if absent; claim the files of the folders that
    no run has claimed (see ``sources.ledger``); register the rows
    under a transient name ``{feed}_{MMddHH}``; null-fill; write by name into
    the partitions of the hours loaded; drop the transient name; publish the claims.

    Every row of a claimed file is loaded, whatever its time; its year is that of
    the run. ``append`` adds all files of the hours asked for, those claimed
    before too (an hour run twice is there twice); ``overwrite`` replaces the
    hours with them; ``once`` appends the newly claimed files only. Over any
    set of runs a file is loaded as one hour. The table is partitioned by the hour
    loaded (the hour of a row's time is a column, whose statistics prune). A
    run that broke off is finished first. Returns False when no folder exists.
    """
    if mode not in MODES:
        raise ValueError(mode)
    start = start.replace(minute=0, second=0, microsecond=0)
    end = end or start + _dt.timedelta(hours=1)
    ensure_table(spark, table_path, staged_schema(feed, with_hour=True, with_load=True), LOAD_COL)
    book = ledger_of(spark, table_path, ledger)
    recover(spark, raw_root, feed, table_path, book)
    days = sorted({(h.month, h.day) for h in hours_between(start, end)})
    paths = day_folders(spark, raw_root, feed, days)
    if not paths:
        return False
    rows = _with_file(read_folders(spark, raw_root, feed, paths))
    new = book.propose(assign_hours(rows, start, end), days)
    asked = new
    if mode != "once":
        lo, hi = (int(t.strftime("%Y%m%d%H")) for t in (start, end))
        before = book.claims(days).where((F.col(LOAD_COL) >= lo) & (F.col(LOAD_COL) < hi))
        asked = materialize(new.unionByName(before), "claimed")
    view = f"{feed}_{start:%m%d%H}"
    _of_files(rows, feed, asked).createOrReplaceTempView(view)
    try:
        _write(spark.table(view), feed, table_path, "overwrite" if mode == "overwrite" else "append")
    finally:
        spark.catalog.dropTempView(view)
    book.publish()
    return True


def load_batch(batch: DataFrame, raw_root: str, feed: str, table_path: str, start: _dt.datetime, end: _dt.datetime,
               ledger: str | None = None) -> None:
    """Stage the files that ``batch`` (rows with month, day, hour and ``_name``) comes
    from, each file once, as the latest hour of its folder in [start, end). A batch
    that is given again adds nothing, and one that broke off is finished. Rows are
    brought together by hour before the write. A stream's batch is read with all its
    columns each time: once for the list of its files, of which the claims are made,
    and once for the write."""
    spark = batch.sparkSession
    ensure_table(spark, table_path, staged_schema(feed, with_hour=True, with_load=True), LOAD_COL)
    book = ledger_of(spark, table_path, ledger)
    recover(spark, raw_root, feed, table_path, book)
    rows = _with_file(batch)
    found = materialize(rows.select(FILE_COL, *PARTS).distinct(), "batch-files")
    new = book.propose(assign_hours(found, start, end, latest=True), _days_of(found))
    _write(by_hour(_of_files(rows, feed, new), new), feed, table_path, "append")
    book.publish()


def read_staging(spark: SparkSession, table_path: str, feed: str) -> DataFrame:
    return read_table(spark, table_path, staged_schema(feed, with_hour=True, with_load=True))


def between_hours(df: DataFrame, start: _dt.datetime, end: _dt.datetime, ts_col: str = "ts") -> DataFrame:
    """Rows with start <= ts < end of an hour-partitioned table.

    Filters on both the partition column (so the scan prunes folders) and on
    ``ts`` (exact bounds): a filter on ``ts`` alone cannot prune partitions.
    """
    lo = int(start.strftime("%Y%m%d%H"))
    hi = int((end - _dt.timedelta(microseconds=1)).strftime("%Y%m%d%H"))
    return df.filter((F.col(HOUR_COL) >= lo) & (F.col(HOUR_COL) <= hi)
                     & (F.col(ts_col) >= ts_literal(start)) & (F.col(ts_col) < ts_literal(end)))
