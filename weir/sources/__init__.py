from weir.sources.files import (
    current_landing,
    integer_range,
    list_objects,
    read_csv,
    read_csv_records,
    read_json_arrays,
    read_json_documents,
    read_json_lines,
    read_landed_documents,
    read_parquet_merged,
)
from weir.sources.jdbc import jdbc_options, read_table
from weir.sources.kafka import (
    kafka_options,
    read_kafka_batch,
    read_kafka_stream,
    read_topic_files,
    stream_topic_files,
)
from weir.sources.widened import SchemaConflict, file_schemas, read_parquet_widened

__all__ = [
    "SchemaConflict",
    "current_landing",
    "file_schemas",
    "integer_range",
    "jdbc_options",
    "kafka_options",
    "list_objects",
    "read_csv",
    "read_csv_records",
    "read_json_arrays",
    "read_json_documents",
    "read_json_lines",
    "read_kafka_batch",
    "read_kafka_stream",
    "read_landed_documents",
    "read_parquet_merged",
    "read_parquet_widened",
    "read_table",
    "read_topic_files",
    "stream_topic_files",
]
