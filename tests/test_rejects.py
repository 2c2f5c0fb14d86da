"""Reasons of rejected messages: every JSON shape, and the same readings as the schema parse."""

from __future__ import annotations

import json

import pytest

from weir import operators as ops
from weir.operators.rejects import REASONS
from weir.plans import staging
from weir.sources import read_topic_files

OK = {"sensor_id": "s", "temperature": 1.5, "humidity": 3, "pressure": 950}


def _message(**value):
    return json.dumps({"id": "1", "timestamp": "2024-01-02T03:04:05.000006", "value": {**OK, **value}})


CASES = [
    (None, "not_json"), ("", "not_json"), ("{", "not_json"), ("abc", "not_json"), (_message()[:-1], "not_json"),
    ('{"id": "1", "id": "2"}', "not_json"),
    ("null", "not_an_object"), ("[1, 2]", "not_an_object"), ("5", "not_an_object"), ('"text"', "not_an_object"),
    ("{}", "no_sensor"), ('{"value": 5}', "no_sensor"), ('{"value": null}', "no_sensor"), ('{"value": []}', "no_sensor"),
    (_message(sensor_id=None), "no_sensor"), (_message(sensor_id=None, temperature="x"), "no_sensor"),
    (_message(temperature=None), "no_temperature"), ('{"value": {"sensor_id": "s"}}', "no_temperature"),
    (_message(temperature="12"), "temperature_not_a_number"), (_message(temperature="NaN"), "temperature_not_a_number"),
    (_message(temperature=True), "temperature_not_a_number"), (_message(temperature=[1]), "temperature_not_a_number"),
    (_message(temperature={"a": 1}), "temperature_not_a_number"),
    (_message(), None), (_message(temperature=0), None), (_message(temperature=-1e300), None), (_message(sensor_id=7), None),
    (_message(humidity="x"), None), (_message(humidity=None), None), (_message(sensor_id=""), None),
]


def test_reasons(spark):
    rows = [(i, None if text is None else text.encode()) for i, (text, _) in enumerate(CASES)]
    found = ops.classified_readings(spark.createDataFrame(rows, "n int, value binary"), keep=("n",)).collect()
    assert {r["n"]: r["reason"] for r in found} == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_the_json_type_of_a_field_is_taken_once(spark):
    """Once for each number; of the message as a whole it isn't spelled out."""
    fields = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(fields)
    spark.conf.set(fields, "1000")
    try:
        plan = ops.classified_readings(spark.createDataFrame([("{}",)], "value string"))._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(fields, before)
    assert plan.count("schemaOfVariant(") == 3


@pytest.mark.parametrize("space", [" ", "\n", "\t\r\n "])
def test_white_space_before_the_message(spark, space):
    row = ops.classified_readings(spark.createDataFrame([(space + _message(),)], "value string")).first()
    assert (row["reason"], row["sensor_id"]) == (None, "s")


@pytest.mark.parametrize("change, column, expected", [
    ({"humidity": 2**31}, "humidity", None), ({"humidity": 2.5}, "humidity", None), ({"humidity": "4"}, "humidity", None),
    ({"temperature": 0.1}, "temperature", 0.1), ({"temperature": 12345678901234567890}, "temperature", 1.2345678901234567e19),
    ({"sensor_id": 7}, "sensor_id", "7")])
def test_values(spark, change, column, expected):
    row = ops.classified_readings(spark.createDataFrame([(_message(**change),)], "value string")).first()
    assert row[column] == expected
    assert row["event_time"] == "2024-01-02 03:04:05"


def test_accepted_are_the_readings_of_the_schema_parse(spark, sf_small):
    messages = read_topic_files(spark, staging.sensor_topic(spark, sf_small))
    both = ops.accepted(ops.classified_readings(messages)), ops.sensor_readings(messages)
    assert both[0].schema == both[1].schema
    assert both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()


def test_no_rows(spark):
    classified = ops.classified_readings(spark.createDataFrame([], "value binary"))
    assert {(r["reason"], r["rows"]) for r in ops.reason_counts(classified).collect()} == {(r, 0) for r in REASONS}


def test_one_parse_a_message(spark):
    classified = ops.classified_readings(spark.createDataFrame([("{}",)], "value string"))
    plan = ops.accepted(classified)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json(") + plan.count("parseJson") == 1, plan
