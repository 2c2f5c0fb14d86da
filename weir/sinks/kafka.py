"""Kafka sinks: JSON message values, batch or streaming.

Writing needs the ``spark-sql-kafka`` package on the class path; the record
encoding (:func:`to_kafka_records`) is plain DataFrame code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.functions.json import encode_json

# Producer settings of the sensor jobs (fixed values): wait for all
# replicas, retry three times, give up on a send after ten seconds.
PRODUCER_ACKS = "all"
PRODUCER_RETRIES = 3
PRODUCER_TIMEOUT_MS = 10000


def kafka_sink_options(bootstrap_servers: str | list[str], topic: str,
                       extra: dict[str, str] | None = None) -> dict[str, str]:
    servers = bootstrap_servers if isinstance(bootstrap_servers, str) else ",".join(bootstrap_servers)
    opts = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": PRODUCER_ACKS,
        "kafka.retries": str(PRODUCER_RETRIES),
        "kafka.request.timeout.ms": str(PRODUCER_TIMEOUT_MS),
        "kafka.delivery.timeout.ms": str(PRODUCER_TIMEOUT_MS * (PRODUCER_RETRIES + 1)),
    }
    opts.update(extra or {})
    return opts


def to_kafka_records(df: DataFrame, value_fields: Sequence[str | Column] | None = None,
                     key: str | Column | None = None) -> DataFrame:
    """Rows -> ``(key, value)`` with the value a UTF-8 JSON object."""
    fields = list(value_fields) if value_fields is not None else df.columns
    cols = [encode_json(*fields).cast("binary").alias("value")]
    if key is not None:
        k = F.col(key) if isinstance(key, str) else key
        cols.insert(0, k.cast("string").cast("binary").alias("key"))
    return df.select(*cols)


def write_kafka(records: DataFrame, bootstrap_servers: str | list[str], topic: str, **extra) -> None:
    records.write.format("kafka").options(**kafka_sink_options(bootstrap_servers, topic, extra)).save()


def write_kafka_stream(records: DataFrame, bootstrap_servers: str | list[str], topic: str,
                       checkpoint: str, **extra):
    if not checkpoint:
        raise ValueError("a streaming sink needs a checkpoint location")
    return (records.writeStream.format("kafka")
            .options(**kafka_sink_options(bootstrap_servers, topic, extra))
            .option("checkpointLocation", checkpoint)
            .start())
