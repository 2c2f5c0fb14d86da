"""Parse and flatten nested messages and documents into warehouse columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.json import decode_json
from weir.functions.time import format_event_time, parse_timestamp
from weir.schemas import SENSOR_ENVELOPE


def parse_messages(df: DataFrame, schema: T.StructType = SENSOR_ENVELOPE,
                   value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Message bytes -> one struct column ``data`` (plus any ``keep`` columns).

    The parse sits in a one-row generator.  A plain projection would let the
    optimizer copy ``from_json`` into every filter pushed below it, parsing
    each message two or three times; behind the generator it runs once per
    message (measured ~40% less time on the flagship job).
    """
    parsed = F.struct(decode_json(value_col, schema).alias("data"))
    return df.select(*keep, F.inline(F.array(parsed)))


def flatten_sensor(parsed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``data`` envelope -> the six warehouse columns.

    ``event_time`` is the message's own timestamp formatted to seconds; text
    that is not a timestamp gives NULL rather than failing the batch.
    """
    return parsed.select(
        *keep,
        F.col("data.id").alias("message_id"),
        format_event_time(F.col("data.timestamp")).alias("event_time"),
        F.col("data.value.sensor_id").alias("sensor_id"),
        F.col("data.value.temperature").alias("temperature"),
        F.col("data.value.humidity").alias("humidity"),
        F.col("data.value.pressure").alias("pressure"),
    )


def valid_readings(df: DataFrame) -> DataFrame:
    """Keep rows with a sensor id and a temperature.

    This also removes messages that were not JSON, were JSON ``null`` or
    carried a temperature that is not a number.
    """
    return df.filter(F.col("sensor_id").isNotNull()).filter(F.col("temperature").isNotNull())


def rejected_readings(df: DataFrame) -> DataFrame:
    """The complement of :func:`valid_readings` (for a reject landing)."""
    return df.filter(F.col("sensor_id").isNull() | F.col("temperature").isNull())


def sensor_readings(messages: DataFrame, value_col: str = "value",
                    keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka-shaped rows -> valid, flattened sensor readings."""
    return (messages
            .transform(lambda d: parse_messages(d, value_col=value_col, keep=keep))
            .transform(lambda d: flatten_sensor(d, keep=keep))
            .transform(valid_readings))


def raw_message_view(messages: DataFrame) -> DataFrame:
    """Debug view of a topic: offset as text, broker time, value as text."""
    return messages.select(
        F.col("offset").cast("string").alias("offset"),
        F.col("timestamp"),
        F.col("value").cast("string").alias("raw_data"),
    )


def flatten_weather(raw: DataFrame, time_as_text: bool = False) -> DataFrame:
    """Current-weather document -> seven flat columns.

    ``current_weather.time`` may be declared as text (parsed here, leniently,
    unless ``time_as_text`` keeps it as it came) or already as a timestamp.
    """
    time_field = raw.schema["current_weather"].dataType["time"].dataType
    time_col = F.col("current_weather.time")
    if not time_as_text and not isinstance(time_field, (T.TimestampType, T.TimestampNTZType)):
        time_col = parse_timestamp(time_col)
    return raw.select(
        F.col("latitude"),
        F.col("longitude"),
        F.col("timezone"),
        F.col("current_weather_units.time").alias("format_time"),
        time_col.alias("time"),
        F.col("current_weather.temperature").alias("temperature"),
        F.col("current_weather.windspeed").alias("windspeed"),
    )


def weather_core(raw: DataFrame) -> DataFrame:
    """Current-weather document -> location columns only."""
    return raw.select("latitude", "longitude", "timezone")
