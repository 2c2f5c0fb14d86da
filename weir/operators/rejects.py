"""Readings with the reason for which a message is rejected, from one parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.functions.time import format_event_time

REASON = "reason"
NOT_JSON, NOT_AN_OBJECT, NO_SENSOR, NO_TEMPERATURE, TEMPERATURE_NOT_A_NUMBER = REASONS = (
    "not_json", "not_an_object", "no_sensor", "no_temperature", "temperature_not_a_number")

_NUMBERS = {"temperature": "double", "humidity": "int", "pressure": "int"}


def _kind(field: Column) -> Column:
    """The JSON type of a variant; null where there is no field, ``VOID`` for a JSON null."""
    return F.schema_of_variant(field)


def _number(field: Column, kind: Column, to: str) -> Column:
    """A JSON number, its JSON type ``kind`` known, as ``to``; null for any other JSON type, and beyond the type's range.

    A number with a fraction is no integer.
    """
    is_number = kind == "BIGINT" if to == "int" else kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return F.when(is_number, F.try_variant_get(field, "$", to))


def classified_readings(messages: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka-shaped rows -> the six reading columns and ``reason``, null for a valid reading.

    The message is parsed once, as a variant, which keeps the JSON type of each
    field: a temperature that is text is told from one that is missing.  The first
    reason that holds counts, in this order: ``not_json`` (no value, broken text, an
    object with a key twice), ``not_an_object`` (JSON null, array, number, text),
    ``no_sensor`` (also where ``value`` is no object), ``no_temperature`` (absent
    or JSON null), ``temperature_not_a_number`` (text such as ``"12"`` or ``"NaN"``,
    too).  The other columns hold what could be read.  Columns in ``keep``
    must not be named like those.
    """
    # behind generators: a plain projection would let the optimizer copy the parse, and what is taken of it, into every use
    one = lambda **columns: F.inline(F.array(F.struct(*[c.alias(f"weir_{n}") for n, c in columns.items()])))
    col = lambda n: F.col(f"weir_{n}")
    parsed = messages.select(*keep, F.col(value_col).cast("string").alias("weir_text")).select(
        *keep, one(json=F.try_parse_json("weir_text"), brace=F.ltrim("weir_text", F.lit(" \t\r\n")).startswith("{")))
    field = lambda path, kind: F.try_variant_get("weir_json", path, kind)
    parsed = parsed.select(*keep, "weir_brace", one(
        known=F.col("weir_json").isNotNull(), id=field("$.id", "string"), time=field("$.timestamp", "string"), sensor=field("$.value.sensor_id", "string"),
        **{n: field(f"$.value.{n}", "variant") for n in _NUMBERS}))
    parsed = parsed.select(*keep, *map(col, ("brace", "known", "id", "time", "sensor", *_NUMBERS)), one(**{f"{n}_kind": _kind(col(n)) for n in _NUMBERS}))
    number = {n: _number(col(n), col(f"{n}_kind"), to) for n, to in _NUMBERS.items()}
    reason = (F.when(~col("known"), NOT_JSON)
              .when(~col("brace"), NOT_AN_OBJECT)
              .when(col("sensor").isNull(), NO_SENSOR)
              .when(col("temperature").isNull() | (col("temperature_kind") == "VOID"), NO_TEMPERATURE)
              .when(number["temperature"].isNull(), TEMPERATURE_NOT_A_NUMBER))
    return parsed.select(
        *keep,
        col("id").alias("message_id"),
        format_event_time(col("time")).alias("event_time"),
        col("sensor").alias("sensor_id"),
        *[c.alias(n) for n, c in number.items()],
        reason.alias(REASON),
    )


def accepted(classified: DataFrame) -> DataFrame:
    """Valid readings, without the reason."""
    return classified.where(F.col(REASON).isNull()).drop(REASON)


def rejected(classified: DataFrame) -> DataFrame:
    """What is rejected, with its reason."""
    return classified.where(F.col(REASON).isNotNull())


def reason_counts(classified: DataFrame) -> DataFrame:
    """``(reason, rows)`` of the rejected rows, a row for each reason, also those with none."""
    spark = classified.sparkSession
    names = spark.createDataFrame([(r,) for r in REASONS], T.StructType([T.StructField(REASON, T.StringType())]))
    counted = rejected(classified).groupBy(REASON).agg(F.count(F.lit(1)).alias("rows"))
    return names.join(counted, REASON, "left").select(REASON, F.coalesce("rows", F.lit(0)).alias("rows"))
