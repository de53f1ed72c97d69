"""File sources: existence guard, genre CSV loader, raw hourly feed layout."""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import null_tokens, safe_double, safe_long, sanitize_columns
from ..schemas import MOVIE_COLUMNS, raw_schema

# The genre tables of the movie catalogue, and the one table
# whose physical name differs from its logical name.
GENRES = ["action", "adventure", "animation", "biography", "crime", "family", "fantasy",
          "film-noir", "history", "horror", "mystery", "romance", "scifi", "sports",
          "thriller", "war"]
GENRE_ALIASES = {"film_noir": "film-noir"}


def genre_registry(root: str, genres: Iterable[str] = GENRES, suffix: str = ".csv", prefix: str = "") -> dict[str, str]:
    """Logical genre name -> file (or folder of files) under ``root``."""
    return {g: f"{root.rstrip('/')}/{prefix}{GENRE_ALIASES.get(g, g)}{suffix}" for g in genres}


def _file_system(spark: SparkSession, path: str):
    """(path, its file system: HDFS, object store or local) on the JVM side."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists on its file system."""
    hpath, fs = _file_system(spark, path)
    return bool(fs.exists(hpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on its own file system. False when it is not there."""
    hpath, fs = _file_system(spark, path)
    return bool(fs.delete(hpath, True))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder, sorted."""
    hpath, fs = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(hpath))


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file; None where it is missing."""
    if not path_exists(spark, path):
        return None
    hpath, fs = _file_system(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place of the one at ``path`` by a rename: a reader sees
    the old text or the new one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, _, name = path.rpartition("/")
    new, fs = _file_system(spark, f"{folder}/_new-{uuid.uuid4().hex[:12]}-{name}")
    out = fs.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    old = jvm.org.apache.hadoop.fs.Path(path)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(new), fs.makeQualified(old), how)


def existing_paths(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """The paths that exist; a missing source is skipped, the others go on."""
    return [p for p in paths if path_exists(spark, p)]


def has_multiline_cells(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether a quoted cell of the CSV goes over a line end: a line with an odd number
    of quotes. One pass over the lines, split over tasks; one bit comes back."""
    odd = F.length("value") - F.length(F.replace("value", F.lit('"')))
    return not spark.read.text(path).where(odd % 2 == 1).isEmpty()


def read_text_csv(spark: SparkSession, path: str | list[str], multiline: bool | None = True) -> DataFrame:
    """CSV with a header row, every column as text, RFC-4180 quoting.

    Columns are typed afterwards with safe casts. ``multiLine`` keeps quoted
    newlines inside a field, but such a file is read by one task; None looks
    whether there are any first, and line-clean files are split over tasks.
    """
    if multiline is None:
        multiline = has_multiline_cells(spark, path)
    return (spark.read.option("header", True).option("multiLine", multiline)
                 .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
                 .csv(path))


# The lattice of inferred types, from the narrowest: a column takes the first one
# that all its cells fit, text fits all.
TYPE_TESTS = [
    ("boolean", lambda c: F.lower(c).isin("true", "false")),
    ("bigint", lambda c: c.rlike(r"^[+-]?[0-9]+$") & c.try_cast("bigint").isNotNull()),
    ("double", lambda c: c.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?[iI]nf(inity)?$")),
]


def infer_types(df: DataFrame, columns: Iterable[str]) -> dict[str, str]:
    """The narrowest type of each text column that all its cells fit: boolean, bigint,
    double or string; missing-value tokens fit each, and a column of nothing else is
    text. One aggregate over all columns at once, one row comes back."""
    columns = list(columns)
    if not columns:
        return {}
    checks = []
    for i, name in enumerate(columns):
        cell = null_tokens(F.trim(F.col(f"`{name}`")))
        checks.append(F.count(cell).alias(f"n{i}"))
        checks += [F.bool_and(F.when(cell.isNotNull(), test(cell))).alias(f"{kind}{i}") for kind, test in TYPE_TESTS]
    seen = df.agg(*checks).first()
    return {name: next((kind for kind, _ in TYPE_TESTS if seen[f"n{i}"] and seen[f"{kind}{i}"]), "string")
            for i, name in enumerate(columns)}


KNOWN_TYPES = {name: t.simpleString() for name, t in MOVIE_COLUMNS}


def conform_movies(df: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Sanitised, NA-token-cleaned catalogue cast to the consumed types.

    Missing-value tokens become null first; then numbers are safe casts (bad
    text -> null, NaN -> null, whole numbers in any spelling). Known columns
    come first in catalogue order, any others follow by their inferred type in
    ``types`` (``infer_types`` of the sanitised columns), else as text.
    """
    clean = df.toDF(*sanitize_columns(df.columns))
    casts = {"double": lambda c: safe_double(F.trim(c)), "bigint": lambda c: safe_long(F.trim(c)),
             "boolean": lambda c: F.trim(c).try_cast("boolean")}
    kinds = {**(types or {}), **KNOWN_TYPES}
    order = [n for n in KNOWN_TYPES if n in clean.columns] + [n for n in clean.columns if n not in KNOWN_TYPES]
    return clean.select(*[casts.get(kinds.get(n), lambda c: c)(null_tokens(F.col(n).cast("string"))).alias(n) for n in order])


def load_genres(spark: SparkSession, registry: Mapping[str, str], multiline: bool | None = None,
                genre_col: str = "source_genre") -> DataFrame:
    """All existing genre files as one catalogue, tagged with their genre.

    Files with the same header are one read, whatever their number; headers
    that differ (``title`` for ``movie_name``) are combined by name. A row's
    genre is that of the registered path it was read from. Columns outside the
    known ones are typed by all their cells in all files (``infer_types``).
    """
    by_header: dict[tuple, list[str]] = {}
    for genre, path in registry.items():
        if path_exists(spark, path):
            by_header.setdefault(tuple(read_text_csv(spark, path, False).columns), []).append(genre)
    if not by_header:
        raise FileNotFoundError("no genre file exists: " + ", ".join(registry.values()))
    frames = []
    for genres in by_header.values():
        raw = read_text_csv(spark, [registry[g] for g in genres], multiline)
        # The path is percent-encoded; a plus sign in it is itself.
        file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        genre = F.coalesce(*[F.when(F.contains(F.concat(file, F.lit("/")), F.lit(f"{_path_part(registry[g])}/")), g)
                             for g in genres])
        tagged = raw.select(*[F.col(f"`{c}`") for c in raw.columns], genre.alias(genre_col))
        frames.append(tagged.toDF(*sanitize_columns(tagged.columns)))
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    types = infer_types(whole, [c for c in whole.columns if c not in KNOWN_TYPES and c != genre_col])
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [conform_movies(f, types) for f in frames])


def _path_part(path: str) -> str:
    """The path without scheme, host and doubled slashes."""
    return re.sub("/+", "/", re.sub("^[a-z0-9]+:(//[^/]*)?", "", path)).rstrip("/")


def raw_hour_path(root: str, feed: str, hour: _dt.datetime) -> str:
    """Raw layout of one hour of a feed: unpadded month/day/hour, no year."""
    return f"{root.rstrip('/')}/{feed}/month={hour.month}/day={hour.day}/hour={hour.hour}"


def hours_between(start: _dt.datetime, end: _dt.datetime) -> list[_dt.datetime]:
    """Hours h with start <= h < end (start truncated to the hour)."""
    h = start.replace(minute=0, second=0, microsecond=0)
    out = []
    while h < end:
        out.append(h)
        h += _dt.timedelta(hours=1)
    return out


def day_folders(spark: SparkSession, root: str, feed: str, days: Iterable[tuple[int, int]]) -> list[str]:
    """The existing day folders of a feed, asked of their own file system, so that
    any spelling of ``root`` works."""
    return existing_paths(spark, [f"{root.rstrip('/')}/{feed}/month={m}/day={d}" for m, d in sorted(set(days))])


def read_folders(spark: SparkSession, root: str, feed: str, paths: list[str]) -> DataFrame:
    """Raw rows of folders of a feed, with month, day and hour of the folder and the
    name of the file as ``_name``. Every row is kept, whatever its time."""
    schema = raw_schema(feed)
    for part in ("month", "day", "hour"):
        schema = schema.add(part, T.IntegerType())
    rows = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/{feed}").parquet(*paths)
    return rows.withColumn("_name", F.col("_metadata.file_name"))


def ts_literal(t: _dt.datetime):
    """A UTC wall-clock TIMESTAMP_NTZ literal (independent of the Python zone)."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def write_raw_hours(raw: DataFrame, root: str, feed: str, mode: str = "append",
                    arrival: str | None = None) -> str:
    """Lay a raw feed out as hour folders (the layout the hourly loader reads).

    The folder is the hour of ``arrival``, a column that is not written, or of
    the row's own time. Dealt by folder: one file an hour, hours in parallel.
    """
    path = f"{root.rstrip('/')}/{feed}"
    hour = F.col(arrival or "timestamp")
    placed = (raw.withColumn("month", F.month(hour)).withColumn("day", F.dayofmonth(hour))
                 .withColumn("hour", F.hour(hour)))
    if arrival:
        placed = placed.drop(arrival)
    tasks = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (placed.repartition(tasks, "month", "day", "hour")
           .write.mode(mode).partitionBy("month", "day", "hour").parquet(path))
    return path


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """A seed CSV kept with the project (e.g. ``state_codes``): header row,
    text columns. A UTF-8 byte-order mark before the header is dropped by
    the reader; cell text is kept as is (a trailing space included)."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])
