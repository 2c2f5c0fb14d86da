"""Declared shapes: message envelopes, documents, records and target tables.

Every read in weir is schema-on-read with an explicit schema: fields not
listed are dropped, listed fields that are missing come back NULL, and no
inference pass runs over the data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Sensor reading inside a Kafka message value (JSON, nested one level).
SENSOR_READING = T.StructType([
    T.StructField("sensor_id", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("pressure", T.IntegerType()),
])

SENSOR_ENVELOPE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("value", SENSOR_READING),
])

# Columns the warehouse table expects from the flattened stream, in order.
SENSOR_COLUMNS = ["message_id", "event_time", "sensor_id", "temperature", "humidity", "pressure"]

# Warehouse target, sorted by (event_time, sensor_id) (fixed values).  The
# warehouse's unsigned 32-bit integers are LongType here; the envelope's counters
# are Integer, so a message's number beyond 2^31 - 1 is read as NULL before.
SENSOR_TARGET = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("sensor_id", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.LongType()),
    T.StructField("pressure", T.LongType()),
])
SENSOR_SORT_KEYS = ["event_time", "sensor_id"]

# The columns of Spark's Kafka source.
KAFKA_SOURCE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
])


def weather_document(time_type: T.DataType = T.StringType()) -> T.StructType:
    """Current-weather document; ``current_weather.time`` is text or typed."""
    return T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("current_weather_units", T.StructType([
            T.StructField("time", T.StringType()),
        ])),
        T.StructField("current_weather", T.StructType([
            T.StructField("time", time_type),
            T.StructField("temperature", T.DoubleType()),
            T.StructField("windspeed", T.DoubleType()),
        ])),
    ])


WEATHER_DOCUMENT = weather_document()
WEATHER_DOCUMENT_TYPED_TIME = weather_document(T.TimestampType())

# Flat records from a REST endpoint (a JSON array of objects).  Inference
# would sort the columns by name, so the order is declared here.
RECORD = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("body", T.StringType()),
])
RECORD_TARGET_NAMES = ["user_id", "id", "title", "body"]
