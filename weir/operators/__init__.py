from weir.operators.flatten import (
    flatten_sensor,
    flatten_weather,
    parse_messages,
    raw_message_view,
    rejected_readings,
    sensor_readings,
    valid_readings,
    weather_core,
)
from weir.operators.conform import conform
from weir.operators.redelivery import PLACE, drop_redelivered
from weir.operators.rejects import accepted, classified_readings, reason_counts, rejected
from weir.operators.rename import positional_rename
from weir.operators.reports import load_report, row_count
from weir.operators.validate import MissingColumnsError, missing_columns, require_columns

__all__ = [
    "PLACE",
    "MissingColumnsError",
    "accepted",
    "classified_readings",
    "conform",
    "drop_redelivered",
    "flatten_sensor",
    "flatten_weather",
    "load_report",
    "missing_columns",
    "parse_messages",
    "positional_rename",
    "raw_message_view",
    "reason_counts",
    "rejected",
    "rejected_readings",
    "require_columns",
    "row_count",
    "sensor_readings",
    "valid_readings",
    "weather_core",
]
