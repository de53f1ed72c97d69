"""Lasting views: definitions kept next to the tables, restored in any session."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession, types as T

from ..operators import facts
from ..sources.files import list_names, path_exists, read_text, replace_text
from ..sources.sinks import read_table

# What a definition can name: the library's views, functions of tables.
VIEWS = {"wide_streams": facts.wide_streams}
FOLDER = "_views"


def save_view(spark: SparkSession, root: str, name: str, tables: Mapping[str, tuple[str, T.StructType]],
              arguments: Mapping[str, int] | None = None) -> None:
    """Keep the definition of view ``name`` under ``root``: its tables, as (path under
    ``root``, schema) by argument, and its plain arguments. It replaces an older one."""
    definition = {"view": name, "arguments": dict(arguments or {}),
                  "tables": {arg: {"path": path, "schema": schema.jsonValue()} for arg, (path, schema) in tables.items()}}
    if name not in VIEWS:
        raise KeyError(name)
    if not path_exists(spark, f"{root}/{FOLDER}"):
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{root}/{FOLDER}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    replace_text(spark, f"{root}/{FOLDER}/{name}.json", json.dumps(definition, indent=1))


def open_views(spark: SparkSession, root: str) -> list[str]:
    """Make the views kept under ``root`` known to the session; their names. A view is
    lazy and reads the versions its tables have now: open it again after a rebuild."""
    root = root.rstrip("/")
    if not path_exists(spark, f"{root}/{FOLDER}"):
        return []
    opened = []
    for file in list_names(spark, f"{root}/{FOLDER}"):
        if not file.endswith(".json") or file.startswith("_"):
            continue
        kept = json.loads(read_text(spark, f"{root}/{FOLDER}/{file}"))
        tables = {arg: read_table(spark, f"{root}/{t['path']}", T.StructType.fromJson(t["schema"])) for arg, t in kept["tables"].items()}
        VIEWS[kept["view"]](**tables, **kept["arguments"]).createOrReplaceTempView(kept["view"])
        opened.append(kept["view"])
    return opened
