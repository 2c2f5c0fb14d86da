from weir.sinks.files import land_raw, write_csv, write_sorted
from weir.sinks.jdbc import append_table, replace_table
from weir.sinks.layout import add_load, compact_batches, layout_manifest, read_layout
from weir.sinks.kafka import kafka_sink_options, to_kafka_records, write_kafka, write_kafka_stream

from weir.sinks.jdbc_loads import append_once, refresh_changes

__all__ = [
    "add_load",
    "append_once",
    "compact_batches",
    "layout_manifest",
    "read_layout",
    "refresh_changes",
    "append_table",
    "kafka_sink_options",
    "land_raw",
    "replace_table",
    "to_kafka_records",
    "write_csv",
    "write_kafka",
    "write_kafka_stream",
    "write_sorted",
]
