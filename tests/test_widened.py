"""Parquet files with conflicting types: the lattice, mixed folders, nested fields, pushdown."""

from __future__ import annotations

import datetime as dt
import itertools

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from weir.sources import read_parquet_widened
from weir.sources.widened import SchemaConflict, wider

PLAIN = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.NullType()]


@pytest.mark.parametrize("a, b, expected", [
    ("int", "bigint", "bigint"), ("bigint", "double", "double"), ("int", "float", "double"), ("float", "double", "double"),
    ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("int", "decimal(4,2)", "decimal(12,2)"), ("decimal(5,1)", "double", "double"),
    ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("void", "string", "string"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<int,int>", "map<bigint,double>", "map<bigint,double>"),
    ("struct<a:int,b:string>", "struct<A:bigint,c:date>", "struct<a:bigint,b:string,c:date>")])
def test_wider(spark, a, b, expected):
    parse = lambda t: T.StructType.fromDDL(f"x {t}")[0].dataType
    assert wider(parse(a), parse(b)).simpleString() == expected
    assert wider(parse(b), parse(a)).simpleString().lower().count(",") == expected.count(",")


def test_order_does_not_matter_for_numbers():
    for a, b, c in itertools.product(PLAIN, repeat=3):
        assert wider(a, b) == wider(b, a)
        if not any(isinstance(t, T.DecimalType) for t in (a, b, c)):
            assert wider(wider(a, b), c) == wider(a, wider(b, c))


def test_conflicts(spark):
    for a, b in ((T.IntegerType(), T.StringType()), (T.TimestampType(), T.TimestampNTZType()), (T.BooleanType(), T.IntegerType())):
        with pytest.raises(SchemaConflict, match="column 'x'"):
            wider(a, b, "x")
        assert wider(a, b, "x", text=True) == T.StringType()
    with pytest.raises(SchemaConflict):
        wider(T.ArrayType(T.IntegerType()), T.IntegerType(), text=True)
    with pytest.raises(SchemaConflict, match="digits"):
        wider(T.DecimalType(38, 0), T.DecimalType(38, 20))


def test_mixed_folder(spark, scratch):
    path = scratch("drift")
    spark.createDataFrame([(1, 10)], "id int, v int").write.mode("append").parquet(path)
    spark.createDataFrame([(2**40, 1.5)], "id long, v double").write.mode("append").parquet(path)
    spark.createDataFrame([(3, "x")], "id int, extra string").write.mode("append").parquet(path)
    spark.createDataFrame([], "id int, v float").write.mode("append").parquet(path)
    df = read_parquet_widened(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "v": "double", "extra": "string"}
    assert {(r["id"], r["v"], r["extra"]) for r in df.collect()} == {(1, 10.0, None), (2**40, 1.5, None), (3, None, "x")}


def test_nested_and_times(spark, scratch):
    path = scratch("nested")
    spark.createDataFrame([((1, "a"), [1], dt.date(2024, 1, 2)), (None, None, None)], "s struct<a:int,b:string>, l array<int>, t date") \
        .write.parquet(f"{path}/a")
    spark.createDataFrame([((2.5,), [2**40], dt.datetime(2024, 1, 2, 3))], "s struct<A:double>, l array<bigint>, t timestamp_ntz") \
        .write.parquet(f"{path}/b")
    rows = read_parquet_widened(spark, f"{path}/a", f"{path}/b").collect()
    got = {None if r["s"] is None else (r["s"]["a"], r["s"]["b"], tuple(r["l"]), r["t"]) for r in rows}
    assert got == {None, (1.0, "a", (1,), dt.datetime(2024, 1, 2)), (2.5, None, (2**40,), dt.datetime(2024, 1, 2, 3))}


def test_files_of_another_writer(spark, scratch, tmp_path):
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "odd name.x": pa.array([1.5], pa.float32())}), tmp_path / "a.parquet")
    pq.write_table(pa.table({"id": pa.array([2], pa.int64()), "odd name.x": pa.array([2], pa.int16())}), tmp_path / "b.parquet")
    df = read_parquet_widened(spark, str(tmp_path))
    assert sorted((r["id"], r["odd name.x"]) for r in df.collect()) == [(1, 1.5), (2, 2.0)]


def test_filters_reach_the_scans(spark, scratch):
    path = scratch("push")
    spark.createDataFrame([(1, "a")], "id int, v string").write.mode("append").parquet(path)
    spark.createDataFrame([(2, "b")], "id long, v string").write.mode("append").parquet(path)
    plan = read_parquet_widened(spark, path).where("id > 1").select("id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(id,1)") == 2 and "v#" not in plan.split("ReadSchema")[-1]


def test_no_file(spark, scratch):
    path = scratch("none")
    spark.createDataFrame([("a",)], "v string").write.text(path)
    with pytest.raises(ValueError, match="no Parquet file"):
        read_parquet_widened(spark, path)
