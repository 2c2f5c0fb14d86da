"""Multi-line JSON documents, record arrays, renames and CSV."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from weir import operators as ops
from weir import sinks, sources
from weir.schemas import RECORD, RECORD_TARGET_NAMES, WEATHER_DOCUMENT, WEATHER_DOCUMENT_TYPED_TIME

DOC = """{
  "latitude": 55.75,
  "longitude": 37.62,
  "timezone": "GMT",
  "elevation": 140.0,
  "current_weather_units": {"time": "iso8601", "temperature": "C"},
  "current_weather": {"time": "2025-07-12T08:15", "temperature": 21.4, "windspeed": 7.2, "weathercode": 3}
}
"""


def local(path: str) -> str:
    return path.split(":", 1)[1] if path.startswith("file:") else path


def write(path: str, name: str, text: str) -> None:
    os.makedirs(local(path), exist_ok=True)
    with open(os.path.join(local(path), name), "w") as fh:
        fh.write(text)


def test_weather_single_document(spark, scratch):
    p = scratch("weather")
    write(p, "weather_data.json", DOC)
    flat = ops.flatten_weather(sources.read_json_documents(spark, p, WEATHER_DOCUMENT)).collect()
    assert len(flat) == 1
    row = flat[0].asDict()
    assert row["format_time"] == "iso8601" and row["windspeed"] == 7.2
    assert str(row["time"]) == "2025-07-12 08:15:00"


def test_weather_typed_time_and_core(spark, scratch):
    p = scratch("weather")
    write(p, "a.json", DOC)
    raw = sources.read_json_documents(spark, p, WEATHER_DOCUMENT_TYPED_TIME)
    assert ops.weather_core(raw).columns == ["latitude", "longitude", "timezone"]
    assert str(ops.flatten_weather(raw).first()["time"]) == "2025-07-12 08:15:00"


def test_array_file_gives_one_row_per_element(spark, scratch):
    p = scratch("arr")
    write(p, "a.json", "[" + DOC + "," + DOC + "]")
    write(p, "b.json", DOC)
    assert sources.read_json_documents(spark, p, WEATHER_DOCUMENT).count() == 3


def test_malformed_document_is_one_null_row(spark, scratch):
    p = scratch("bad")
    write(p, "a.json", "{not json")
    rows = sources.read_json_documents(spark, p, WEATHER_DOCUMENT).collect()
    assert len(rows) == 1 and rows[0]["latitude"] is None


def test_bad_time_text_is_null_not_error(spark, scratch):
    p = scratch("badtime")
    write(p, "a.json", DOC.replace("2025-07-12T08:15", "soon"))
    assert ops.flatten_weather(sources.read_json_documents(spark, p, WEATHER_DOCUMENT)).first()["time"] is None


def test_time_can_stay_text(spark, scratch):
    p = scratch("texttime")
    write(p, "a.json", DOC)
    row = ops.flatten_weather(sources.read_json_documents(spark, p, WEATHER_DOCUMENT), time_as_text=True).first()
    assert row["time"] == "2025-07-12T08:15"


def test_partition_directories_do_not_shift_positions(spark, scratch):
    p = scratch("records")
    write(p + "/b=1", "a.json", '[{"userId": 1, "id": 2, "title": "t", "body": "x"}]')
    df = sources.read_json_documents(spark, p, RECORD)
    assert df.columns == RECORD.fieldNames()
    renamed = ops.positional_rename(df, RECORD_TARGET_NAMES)
    assert renamed.first().asDict() == {"user_id": 1, "id": 2, "title": "t", "body": "x"}


def test_positional_rename_checks_width(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        ops.positional_rename(df, ["a", "b"])


def test_csv_quotes_and_newlines_round_trip(spark, scratch):
    texts = ['plain', 'with "quotes"', 'line one\nline two', ' padded ', 'comma, here', '', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    p = scratch("csv")
    sinks.write_csv(df, p, header=True)
    back = sources.read_csv(spark, p, header=True, schema="id long, text string", multi_line=True)
    got = {r["id"]: r["text"] for r in back.collect()}
    # CSV has no distinct empty string: '' reads back as NULL, like NULL.
    assert got == {i: (t if t != "" else None) for i, t in enumerate(texts)}


def test_csv_without_header_reads_header_as_data(spark, scratch):
    p = scratch("csv")
    sinks.write_csv(spark.createDataFrame([(1, "a")], "k long, v string").coalesce(1), p, header=True)
    df = sources.read_csv(spark, p)
    assert df.columns == ["_c0", "_c1"]
    assert sorted(tuple(r) for r in df.collect()) == [("1", "a"), ("k", "v")]


def test_csv_inferred_types(spark, scratch):
    p = scratch("csv")
    sinks.write_csv(spark.createDataFrame([(1, 2.5, "x")], "a long, b double, c string"), p)
    df = sources.read_csv(spark, p, header=True, infer_schema=True)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["int", "double", "string"]


def test_parquet_merge(spark, scratch):
    a, b = scratch("a"), scratch("b")
    spark.createDataFrame([(1, "x")], "k long, s string").write.parquet(a)
    spark.createDataFrame([(2, 3.0)], "k long, d double").write.parquet(b)
    merged = sources.read_parquet_merged(spark, a, b)
    assert sorted(merged.columns) == ["d", "k", "s"]
    assert merged.count() == 2


def test_listing(spark, scratch):
    p = scratch("listing")
    write(p + "/x", "a.json", "{}")
    write(p, "b.txt", "hello")
    listed = sorted((r["key"], r["length"]) for r in sources.list_objects(spark, p).collect())
    assert listed == [("b.txt", 5), ("x/a.json", 2)]
    assert sources.list_objects(spark, p, pattern="*.json").count() == 1


def test_listing_is_complete(spark, scratch):
    p = scratch("listing")
    for name in ("_hidden.json", ".dot", "empty", "pre-1.json", "pre-2.json", "other"):
        write(p, name, "" if name == "empty" else "{}")
    keys = lambda prefix: sorted(r["key"] for r in sources.list_objects(spark, prefix).collect())
    assert keys(p) == keys(p + "/") == sorted(["_hidden.json", ".dot", "empty", "pre-1.json", "pre-2.json", "other"])
    assert keys(p + "/pre-") == keys(p + "/pre-?.json") == ["pre-1.json", "pre-2.json"]
    assert keys(p + "/other") == ["other"]


def test_reports(spark):
    df = spark.range(12).withColumn("x", F.lit(1))
    assert ops.row_count(df).first()[0] == 12
    assert tuple(ops.load_report(df).first()) == (12, 2)


def test_listing_missing_prefix_is_empty(spark, scratch):
    df = sources.list_objects(spark, scratch("nothing_here"))
    assert df.count() == 0 and df.columns == ["path", "key", "length", "modificationTime"]


def test_range_partitioned_export_has_one_header_per_file(spark, scratch, sf_small):
    from weir.plans import staging

    customer = staging.table(spark, sf_small, "customer")
    p = scratch("customer_csv")
    staging.csv_export(customer.repartitionByRange(4, "c_custkey"), p, header=True)
    df = sources.read_csv(spark, p)
    assert df.filter(F.col("_c0") == "c_custkey").count() == 4
    assert df.count() == customer.count() + 4


def test_landed_documents_parse_each_payload(spark, scratch):
    p = scratch("landed")
    payloads = spark.createDataFrame([(DOC,), ("{broken",)], "payload string")
    payloads.write.json(p)  # JSON lines: the newlines of DOC stay inside one record
    rows = sources.read_landed_documents(spark, p, WEATHER_DOCUMENT).collect()
    assert len(rows) == 2
    assert sorted(r["latitude"] is None for r in rows) == [False, True]


def test_landed_array_gives_a_row_per_element(spark, scratch):
    p = scratch("landed")
    spark.createDataFrame([(f"[{DOC}, {DOC}]",)], "payload string").write.json(p)
    rows = sources.read_landed_documents(spark, p, WEATHER_DOCUMENT).collect()
    assert len(rows) == 2 and all(r["latitude"] is not None for r in rows)


def test_conform_casts_and_checks(spark):
    from weir.schemas import SENSOR_TARGET

    df = spark.createDataFrame([("m", "2025-01-01 00:00:01", "s", 1.0, 2, 3)],
                               "message_id string, event_time string, sensor_id string, "
                               "temperature double, humidity int, pressure int")
    out = ops.conform(df, SENSOR_TARGET)
    assert out.schema == SENSOR_TARGET
    assert str(out.first()["event_time"]) == "2025-01-01 00:00:01"
    with pytest.raises(ops.MissingColumnsError):
        ops.conform(df.drop("pressure"), SENSOR_TARGET)
