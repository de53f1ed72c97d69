"""Sinks: hour-partitioned staging/fact tables, whole-table overwrite, read-back."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..schemas import HOUR_COL
from .files import delete_path, list_names, path_exists, read_text, replace_text


def by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``df`` in ``schema`` order and types, matched by name.

    Positional inserts put values in the wrong column when the select order
    differs from the table order; selecting by name first makes that
    impossible.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


SCHEMA_FILE = "_schema.json"   # hidden from reads of the folder, like the pointer
POINTER = "_current"


class SchemaMismatch(ValueError):
    """A table exists with another schema than the one asked for."""


def check_schema(stored: T.StructType, wanted: T.StructType) -> bool:
    """Whether ``wanted`` only adds nullable columns to ``stored`` (False: it has the
    same ones). Order and nullability of stored columns do not matter; a column of
    another type, one that is gone or a new one that must not be null raises."""
    old = {f.name: f.dataType for f in stored.fields}
    new = {f.name: f.dataType for f in wanted.fields}
    faults = [f"{n} is {t.simpleString()}, not {new[n].simpleString()}" for n, t in old.items() if n in new and t != new[n]]
    faults += [f"{n} is gone" for n in old if n not in new]
    faults += [f"new column {f.name} must be nullable" for f in wanted.fields if f.name not in old and not f.nullable]
    if faults:
        raise SchemaMismatch("; ".join(faults))
    return len(new) > len(old)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema a table was made with; None where that is not kept."""
    text = read_text(spark, f"{path}/{SCHEMA_FILE}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def _of_files(spark: SparkSession, path: str, partition_by: list[str]) -> T.StructType | None:
    """The schema of a folder's files, without the partition columns, whose types are
    guessed from folder names; None where there is no file."""
    try:
        found = spark.read.parquet(path).schema
    except AnalysisException:
        return None
    return T.StructType([f for f in found.fields if f.name not in partition_by])


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_by: str | list[str] | None = HOUR_COL) -> bool:
    """Create an empty table with ``schema`` unless one exists. True if created.

    An existing one must have these columns: added nullable ones are taken into its
    schema (its old rows read as null there), anything else raises.
    """
    if path_exists(spark, path):
        stored, wanted = stored_schema(spark, path), schema
        if kept := stored is not None:
            kept = not check_schema(stored, wanted)
        else:
            parts = [partition_by] if isinstance(partition_by, str) else partition_by or []
            stored = _of_files(spark, path, parts)
            if stored is not None:
                check_schema(stored, T.StructType([f for f in wanted.fields if f.name not in parts]))
        if not kept:
            replace_text(spark, f"{path}/{SCHEMA_FILE}", schema.json())
        return False
    w = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    replace_text(spark, f"{path}/{SCHEMA_FILE}", schema.json())
    return True


def cluster_by_hour(df: DataFrame) -> DataFrame:
    """Bring the rows of an hour together before an hour-partitioned write.

    Rows coming out of a join or aggregation are spread by key, so every task
    holds every hour and the write makes tasks x hours small files. A rebalance
    by hour gives each hour to one task, and splits an hour that is too large by
    its real size: file sizes follow the data, in one pass and without sampling.
    """
    return df.hint("rebalance", F.col(HOUR_COL))


def write_hours(df: DataFrame, path: str, mode: str = "append",
                schema: T.StructType | None = None, cluster: bool = False,
                partition_by: list[str] | None = None) -> None:
    """Write rows into the hour partitions of a table.

    ``append`` adds rows (a re-run duplicates its hours); ``overwrite``
    replaces only the partitions present in ``df`` (dynamic partition
    overwrite), which makes re-running an hour idempotent. Input read from hour
    folders is already grouped by hour and is written without a shuffle; pass
    ``cluster=True`` for input that is not (see ``cluster_by_hour``).
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(mode)
    out = by_name(df, schema) if schema is not None else df
    if cluster:
        out = cluster_by_hour(out)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*(partition_by or [HOUR_COL])).parquet(path))


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Full rebuild of a table (truncate and load), published when it is complete.

    The rows go into a new version folder under ``path``; then the pointer file is
    switched to it in one rename. Until then, and if the write fails, readers
    (``read_table``) see the old version. The version before the current one stays,
    for reads under way; older ones and pieces of failed writes are deleted.
    """
    spark = df.sparkSession
    before = current_version(spark, path)
    version = f"v{int(before[1:9] if before else 0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(f"{path}/{version}")
    replace_text(spark, f"{path}/{POINTER}", version)
    for name in list_names(spark, path):
        if re.fullmatch("v[0-9]{8}-[0-9a-f]{8}", name) and name not in (before, version):
            delete_path(spark, f"{path}/{name}")
    return path


def current_version(spark: SparkSession, path: str) -> str | None:
    """The version folder the pointer names; None for a plain folder."""
    return read_text(spark, f"{path}/{POINTER}")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A table written by ``write_table`` (its current version) or a plain folder."""
    version = current_version(spark, path)
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{path}/{version}" if version else path)
