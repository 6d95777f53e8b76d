"""Archives of several schemas: types that widen, columns that some files lack, one scan per schema."""

import datetime


import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorflow.sources.readers import read_archive
from sensorflow.sources.releases import common_type, files_by_schema, read_releases
from sensorflow.sources.files import data_files


def write(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def test_three_schemas_in_one_archive(spark, tmp_path):
    write(spark, tmp_path / "a b", [(1, 5, "x")], "id int, v int, only_a string")
    write(spark, tmp_path / "b", [(2, 0.5), (None, None)], "id long, v double")
    write(spark, tmp_path / "c", [("three", "p")], "id string, `dotted.name` string")
    df = read_releases(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == {
        "id": "string", "v": "double", "only_a": "string", "dotted.name": "string"}
    got = {tuple(r) for r in df.select("id", "v", "only_a", F.col("`dotted.name`")).collect()}
    assert got == {("1", 5.0, "x", None), ("2", 0.5, None, None), (None, None, None, None), ("three", None, None, "p")}


def test_one_scan_per_schema_of_the_wanted_columns(spark, tmp_path):
    for i in range(9):
        write(spark, tmp_path / f"f{i}", [(i, 1.0, i)], f"id {['int', 'long'][i % 2]}, v double, c{i} int")
    files = data_files(spark, str(tmp_path))
    assert [len(g) for g in files_by_schema(spark, files, ["id", "v"])] in ([5, 4], [4, 5])
    df = read_releases(spark, str(tmp_path), ["id", "v", "absent"])
    assert df.columns == ["id", "v"] and df.schema["id"].dataType == T.LongType()
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    assert sorted(r["id"] for r in df.collect()) == list(range(9))
    only = read_releases(spark, str(tmp_path), ["c3"])
    assert sorted(r["c3"] for r in only.collect() if r["c3"] is not None) == [3] and only.count() == 9


def test_partition_folders_are_columns_and_prune(spark, tmp_path):
    write(spark, tmp_path / "site=A", [(1,)], "v int")
    write(spark, tmp_path / "site=B", [(2.5,)], "v double")
    df = read_releases(spark, str(tmp_path))
    assert sorted(map(tuple, df.select("site", "v").collect())) == [("A", 1.0), ("B", 2.5)]
    assert [tuple(r) for r in df.where("site = 'B'").select("v").collect()] == [(2.5,)]


def test_archive_reader_takes_declared_types_from_each_release(spark, tmp_path):
    write(spark, tmp_path / "a", [("7", datetime.datetime(2020, 1, 1, 5))], "v string, t timestamp")
    write(spark, tmp_path / "b", [(8, datetime.datetime(2020, 1, 2, 5))], "v int, t timestamp_ntz")
    write(spark, tmp_path / "c", [("n/a", None)], "v string, t timestamp_ntz")
    schema = T.StructType([T.StructField("t", T.TimestampNTZType()), T.StructField("v", T.DoubleType())])
    got = {tuple(r) for r in read_archive(spark, str(tmp_path), schema).collect()}
    assert got == {(datetime.datetime(2020, 1, 1, 5), 7.0), (datetime.datetime(2020, 1, 2, 5), 8.0), (None, None)}
    with pytest.raises(ValueError, match="no column w"):
        read_archive(spark, str(tmp_path), T.StructType([T.StructField("w", T.DoubleType())]))
    with pytest.raises(ValueError, match="has no files"):
        read_releases(spark, str(tmp_path / "nowhere"))


@pytest.mark.parametrize("a,b,both", [
    ("int", "bigint", "bigint"), ("bigint", "float", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("decimal(5,2)", "int", "decimal(12,2)"), ("decimal(5,2)", "double", "double"), ("boolean", "int", "string"),
    ("decimal(38,0)", "decimal(10,9)", "decimal(38,9)")])
def test_common_types(spark, a, b, both):
    one, two, want = (T._parse_datatype_string(x) for x in (a, b, both))
    assert common_type(one, two) == want and common_type(two, one) == want


def test_types_without_a_common_one_are_an_error(spark):
    with pytest.raises(ValueError, match="no common type"):
        common_type(T._parse_datatype_string("struct<a:int>"), T.IntegerType())

