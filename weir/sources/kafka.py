"""Kafka topics as batch or streaming frames, and their file stand-in.

The live Kafka source needs the ``spark-sql-kafka`` package on the class
path.  Jobs are written against the Kafka column shape
(:data:`weir.schemas.KAFKA_SOURCE`), so a directory of Parquet files with
that shape drives the same transforms in tests and catch-up runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weir.schemas import KAFKA_SOURCE

# Operating settings of the reference's sensor job (fixed values).  Its cap on a
# batch is a demo's; callers that want one pass it.
DEMO_MAX_OFFSETS_PER_TRIGGER = 1000
DEFAULT_STARTING_OFFSETS = "earliest"


def kafka_options(
    bootstrap_servers: str | list[str],
    topic: str,
    *,
    starting_offsets: str = DEFAULT_STARTING_OFFSETS,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    Consumer-group offsets are not used: progress lives in the streaming
    query's checkpoint, which is what makes restarts exact.

    Spark reads one task per topic partition; ``min_partitions`` asks for at
    least that many tasks, splitting large (hot) topic partitions into
    offset ranges so one busy partition does not become one long task.
    """
    servers = bootstrap_servers if isinstance(bootstrap_servers, str) else ",".join(bootstrap_servers)
    opts = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions is not None:
        opts["minPartitions"] = str(int(min_partitions))
    opts.update(extra or {})
    return opts


KAFKA_PACKAGE_HINT = ("the Kafka connector is not on the class path: start Spark with "
                      "spark.jars.packages=org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>")


def _load(loader):
    try:
        return loader()
    except Exception as exc:  # the data source lookup fails at load time
        if "kafka" in str(exc).lower() and ("DATA_SOURCE_NOT_FOUND" in str(exc) or "Failed to find" in str(exc)):
            raise RuntimeError(KAFKA_PACKAGE_HINT) from exc
        raise


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str | list[str], topic: str,
                      **kwargs) -> DataFrame:
    """Streaming frame over a live topic (requires the Kafka package)."""
    opts = kafka_options(bootstrap_servers, topic, **kwargs)
    return _load(lambda: spark.readStream.format("kafka").options(**opts).load())


def read_kafka_batch(spark: SparkSession, bootstrap_servers: str | list[str], topic: str,
                     starting_offsets: str = "earliest", ending_offsets: str = "latest",
                     min_partitions: int | None = None) -> DataFrame:
    """Bounded batch read of a live topic (requires the Kafka package)."""
    opts = kafka_options(bootstrap_servers, topic, starting_offsets=starting_offsets,
                         max_offsets_per_trigger=None, min_partitions=min_partitions)
    opts["endingOffsets"] = ending_offsets
    return _load(lambda: spark.read.format("kafka").options(**opts).load())


def read_topic_files(spark: SparkSession, path: str) -> DataFrame:
    """Batch frame over Kafka-shaped Parquet files."""
    return spark.read.schema(KAFKA_SOURCE).parquet(path)


def stream_topic_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       max_bytes_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame over Kafka-shaped Parquet files.

    Without a limit a batch takes what is there.  ``max_bytes_per_trigger``
    sizes batches by volume, whatever the files; with files of at most N rows,
    ``max_files_per_trigger=1`` caps every batch at N rows, the counterpart of
    ``maxOffsetsPerTrigger``.
    """
    reader = spark.readStream.schema(KAFKA_SOURCE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes_per_trigger))
    return reader.parquet(path)
