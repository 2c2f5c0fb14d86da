"""Sensor message parsing: the edge cases of FIXTURES.md section A."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from weir import operators as ops
from weir.plans import staging
from weir.schemas import KAFKA_SOURCE, SENSOR_COLUMNS

GOOD = '{"id":"m1","timestamp":"2025-07-12T08:15:30.123456","value":{"sensor_id":"sensor_1","temperature":21.5,"humidity":40,"pressure":1000}}'


def frames(spark, values):
    rows = [(None, None if v is None else v.encode(), "t", 0, i, dt.datetime(2025, 1, 1), 0)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_SOURCE)


def readings(spark, values):
    return {r["message_id"]: r.asDict() for r in ops.sensor_readings(frames(spark, values)).collect()}


def test_good_message_is_flattened(spark):
    out = ops.sensor_readings(frames(spark, [GOOD]))
    assert out.columns == SENSOR_COLUMNS
    row = out.first().asDict()
    assert row == {"message_id": "m1", "event_time": "2025-07-12 08:15:30", "sensor_id": "sensor_1",
                   "temperature": 21.5, "humidity": 40, "pressure": 1000}


def test_unusable_messages_are_dropped(spark):
    bad = ["not json", None, "null", "[" + GOOD + "]", '{"id":"x","timestamp":"2025-01-01T00:00:00"}',
           '{"id":"s","value":{"sensor_id":"a","temperature":"20.5"}}',
           '{"id":"n","value":{"temperature":20.5}}']
    assert ops.sensor_readings(frames(spark, bad)).count() == 0


def test_lenient_fields_keep_the_row(spark):
    msgs = [
        '{"id":"int_temp","value":{"sensor_id":"a","temperature":20}}',
        '{"id":"frac_hum","value":{"sensor_id":"a","temperature":1.5,"humidity":40.5}}',
        '{"id":"big_hum","value":{"sensor_id":"a","temperature":1.5,"humidity":4000000000}}',
        '{"id":7,"value":{"sensor_id":"a","temperature":1.5}}',
        '{"id":"extra","other":1,"value":{"sensor_id":"a","temperature":1.5,"x":[1]}}',
        '{"id":"bad_ts","timestamp":"yesterday","value":{"sensor_id":"a","temperature":1.5}}',
        '{"id":"offset_ts","timestamp":"2025-07-12T08:15:00+03:00","value":{"sensor_id":"a","temperature":1.5}}',
    ]
    got = readings(spark, msgs)
    assert set(got) == {"int_temp", "frac_hum", "big_hum", "7", "extra", "bad_ts", "offset_ts"}
    assert got["int_temp"]["temperature"] == 20.0
    assert got["frac_hum"]["humidity"] is None
    assert got["big_hum"]["humidity"] is None
    assert got["int_temp"]["humidity"] is None and got["int_temp"]["pressure"] is None
    assert got["bad_ts"]["event_time"] is None
    assert got["offset_ts"]["event_time"] == "2025-07-12 05:15:00"


def test_message_parsed_once(spark, capsys):
    ops.sensor_readings(frames(spark, [GOOD])).explain()
    plan = capsys.readouterr().out
    assert plan.count("from_json") == 1 and "Generate" in plan


def test_rejected_is_complement(spark):
    df = ops.parse_messages(frames(spark, [GOOD, "not json"])).transform(ops.flatten_sensor)
    assert ops.valid_readings(df).count() + ops.rejected_readings(df).count() == 2


def test_raw_view(spark):
    row = ops.raw_message_view(frames(spark, [GOOD])).first()
    assert row["offset"] == "0" and row["raw_data"] == GOOD


def test_require_columns(spark):
    df = ops.sensor_readings(frames(spark, [GOOD]))
    assert ops.require_columns(df) is df
    try:
        ops.require_columns(df.drop("pressure"))
    except ops.MissingColumnsError as exc:
        assert "pressure" in str(exc)
    else:
        raise AssertionError("missing column not detected")


def test_envelope_round_trip(spark, sf_small):
    events = staging.table(spark, sf_small, "events")
    decoded = ops.parse_messages(staging.kafka_frames(staging.sensor_envelope(events)))
    assert decoded.filter(F.col("data.id").isNull()).count() == 0
    assert decoded.count() == events.count()
