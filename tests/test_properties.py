"""Property tests: the message codec round-trips arbitrary readings."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weir import operators as ops
from weir.schemas import KAFKA_SOURCE
from weir.sinks import to_kafka_records

text = st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=30)
reading = st.tuples(
    text,                                                     # id
    st.datetimes(min_value=dt.datetime(1971, 1, 1), max_value=dt.datetime(2100, 1, 1)),
    st.one_of(st.none(), text),                               # sensor_id
    st.one_of(st.none(), st.floats(allow_nan=False, allow_infinity=False, width=64)),
    st.one_of(st.none(), st.integers(-2**31, 2**31 - 1)),
    st.one_of(st.none(), st.integers(-2**31, 2**31 - 1)),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(reading, min_size=1, max_size=40))
def test_encode_then_parse_round_trips(spark, rows):
    src = spark.createDataFrame(
        [(i, f"{i}:{r[0]}", r[1].strftime("%Y-%m-%dT%H:%M:%S.%f"), (r[2], r[3], r[4], r[5]))
         for i, r in enumerate(rows)],
        "n long, id string, timestamp string, "
        "value struct<sensor_id string, temperature double, humidity int, pressure int>")
    records = to_kafka_records(src, ["id", "timestamp", "value"], key="n")
    frames = records.select(
        F.col("key"), F.col("value"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("key").cast("string").cast("long").alias("offset"),
        F.lit(dt.datetime(2025, 1, 1)).cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
    ).select(*KAFKA_SOURCE.fieldNames())
    got = {r["message_id"]: r for r in ops.sensor_readings(frames).collect()}
    expected = {f"{i}:{r[0]}": r for i, r in enumerate(rows) if r[2] is not None and r[3] is not None}
    assert set(got) == set(expected)
    for key, r in expected.items():
        row = got[key]
        assert row["sensor_id"] == r[2]
        assert row["temperature"] == r[3]
        assert row["humidity"] == r[4] and row["pressure"] == r[5]
        assert row["event_time"] == r[1].strftime("%Y-%m-%d %H:%M:%S")
