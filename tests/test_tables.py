"""Typed unknown columns, published tables, schema checks."""

import pytest
from pyspark.sql import functions as F, types as T

from mediamart.session import scratch_path
from mediamart.sources import files
from mediamart.sources.sinks import (POINTER, SchemaMismatch, check_schema, ensure_table, list_names, read_table, stored_schema,
                                     write_table)


# ---------------------------------------------------------------- type inference

COLUMNS = {"truth": ["True", "false", None], "whole": ["1", " -20 ", "NA"], "gaps": ["7", None, "NULL"], "point": ["1.5", "2", "-3e4"],
           "big": ["1", "2", "92233720368547758080"], "text": ["1", "x", None], "empty": [None, "NaN", ""], "mixed": ["True", "1", None],
           "zeros": ["007", "1", "2"], "spelled": ["204835.0", "3.0", None], "inf": ["1", "inf", "2"], "one.two": ["1", "2", "3"]}
WANT = {"truth": "boolean", "whole": "bigint", "gaps": "bigint", "point": "double", "big": "double", "text": "string",
        "empty": "string", "mixed": "string", "zeros": "bigint", "spelled": "double", "inf": "double", "one.two": "bigint"}


def test_narrowest_type_that_all_cells_fit(spark):
    df = spark.createDataFrame(list(zip(*COLUMNS.values())), T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS]))
    assert files.infer_types(df, COLUMNS) == WANT
    assert set(files.infer_types(df.limit(0), COLUMNS).values()) == {"string"}
    assert files.infer_types(df, []) == {}


def test_unlisted_columns_are_typed_over_all_files(spark, tmp_path):
    (tmp_path / "action.csv").write_text("movie_id,Release Week,seen\n1,3,True\n2,NA,False\n")
    (tmp_path / "crime.csv").write_text("movie_id,Release Week,note\n3,4.5,x\n")
    df = files.load_genres(spark, files.genre_registry(str(tmp_path), ["action", "crime"]))
    assert dict(df.dtypes) == {"movie_id": "string", "release_week": "double", "seen": "boolean", "source_genre": "string", "note": "string"}
    got = sorted((r.movie_id, r.release_week, r.seen, r.note, r.source_genre) for r in df.collect())
    assert got == [("1", 3.0, True, None, "action"), ("2", None, False, None, "action"), ("3", 4.5, None, "x", "crime")]


def test_genres_of_folders_with_any_name(spark, tmp_path):
    for name in ("a+b", "a b", "a%20b", "é"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text(f"movie_id\n{name}\n")
    reg = {name: f"{tmp_path}/{name}" for name in ("a+b", "a b", "a%20b", "é")}
    assert {r.movie_id: r.source_genre for r in files.load_genres(spark, reg).collect()} == {n: n for n in reg}


def test_line_clean_files_are_split(spark, tmp_path):
    (tmp_path / "clean.csv").write_text('movie_id,description\n1,"a ""quoted"" word"\n')
    (tmp_path / "cells.csv").write_text('movie_id,description\n1,"over\ntwo lines"\n')
    assert not files.has_multiline_cells(spark, f"{tmp_path}/clean.csv")
    assert files.has_multiline_cells(spark, f"{tmp_path}/cells.csv")
    rows = files.load_genres(spark, {g: f"{tmp_path}/{g}.csv" for g in ("clean", "cells")}).collect()
    assert sorted(r.description for r in rows) == ['a "quoted" word', "over\ntwo lines"]


# ---------------------------------------------------------------- published tables

def numbers(spark, n):
    return spark.range(n).withColumn("part", F.col("id") % 2)


def test_a_rebuild_replaces_the_table(spark):
    path = scratch_path(spark, "published")
    for n in (4, 2, 7, 3):
        write_table(numbers(spark, n), path, "part")
        assert read_table(spark, path).count() == n
    versions = [x for x in list_names(spark, path) if x.startswith("v")]
    assert len(versions) == 2                                  # the current one and the one before


def test_a_failed_rebuild_leaves_the_old_table(spark):
    path = scratch_path(spark, "failed")
    write_table(numbers(spark, 4), path)
    before = read_table(spark, path)
    broken = numbers(spark, 100).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        write_table(broken, path)
    assert read_table(spark, path).count() == 4 and before.count() == 4
    write_table(numbers(spark, 5), path)                       # pieces of the failed one go
    assert read_table(spark, path).count() == 5 and before.count() == 4
    assert len([x for x in list_names(spark, path) if x.startswith("v")]) == 2


def test_a_table_can_be_rebuilt_from_itself(spark):
    path = scratch_path(spark, "itself")
    write_table(numbers(spark, 4), path)
    write_table(read_table(spark, path).where("id > 0"), path)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 2, 3]
    assert POINTER in list_names(spark, path)


# ---------------------------------------------------------------- schema check

BASE = "a bigint, b string, h bigint"


def schema(text):
    return T.StructType.fromDDL(text)


@pytest.mark.parametrize("wanted, adds", [(BASE, False), ("h bigint, b string, a bigint", False), (BASE + ", c double", True),
                                          ("a bigint NOT NULL, b string, h bigint", False)])
def test_schemas_that_fit(spark, wanted, adds):
    assert check_schema(schema(BASE), schema(wanted)) is adds
    path = scratch_path(spark, "fits")
    assert ensure_table(spark, path, schema(BASE), "h")
    assert not ensure_table(spark, path, schema(wanted), "h")
    assert {f.name for f in stored_schema(spark, path).fields} == {f.name for f in schema(wanted).fields}


@pytest.mark.parametrize("wanted", ["a int, b string, h bigint", "a bigint, h bigint", BASE + ", c double NOT NULL", "x bigint"])
def test_schemas_that_do_not_fit(spark, wanted):
    path = scratch_path(spark, "unfit")
    ensure_table(spark, path, schema(BASE), "h")
    with pytest.raises(SchemaMismatch):
        ensure_table(spark, path, schema(wanted), "h")
    assert stored_schema(spark, path) == schema(BASE)


def test_an_added_column_is_null_in_old_rows(spark):
    path = scratch_path(spark, "added")
    ensure_table(spark, path, schema(BASE), "h")
    spark.createDataFrame([(1, "x", 5)], BASE).write.mode("append").partitionBy("h").parquet(path)
    more = BASE + ", c double"
    ensure_table(spark, path, schema(more), "h")
    spark.createDataFrame([(2, "y", 5, 0.5)], more).write.mode("append").partitionBy("h").parquet(path)
    assert sorted((r.a, r.c) for r in read_table(spark, path, schema(more)).collect()) == [(1, None), (2, 0.5)]


def test_a_table_of_another_writer_is_checked_by_its_files(spark):
    path = scratch_path(spark, "foreign")
    spark.createDataFrame([(1, "x")], "a bigint, b string").write.parquet(path)
    assert not ensure_table(spark, path, schema("a bigint, b string"), None)
    with pytest.raises(SchemaMismatch):
        ensure_table(spark, path, schema("a string, b string"), None)
