"""Input shapes built from the driver tables, by Spark, in the shared scratch area.

Every registered query reads the driver tables through one of these staged
shapes (Kafka-shaped message files, multi-line JSON documents, CSV exports,
record arrays), so its work grows with the tables.  Each shape is written
once per process and reused; all writes are distributed.
"""

from __future__ import annotations

import hashlib
import math
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir import folders
from weir.functions.json import encode_json, encode_json_bytes
from weir.session import scratch_path

SENSOR_TOPIC = "sensor_metrics"
TOPIC_PARTITIONS = 3
# Message files hold at most this many rows (~25 MB of messages), so the file
# count grows with the table, no file is tiny at scale, and a batch of a stream
# has enough of them to keep the cores busy: a file of one row group is a task.
ROWS_PER_TOPIC_FILE = 250_000
# Like a topic's partitions: the main copy is spread over at least this many
# files so even a small topic is read in parallel.
MIN_TOPIC_FILES = 8
# Out-of-order copy: at least this many files, so a stream over it has
# several batches that each mix early and late events.
MIN_SHUFFLED_FILES = 4
ROWS_PER_JSON_ARRAY = 2000
# A large array: a file of several scan splits, which a single task can still write.
BYTES_PER_LARGE_ARRAY = 256 << 20

_lock = threading.Lock()
_staged: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _lock:
        if key not in _staged:
            folder = sf_dir.rstrip("/")
            tag = f"{folder.rsplit('/', 1)[-1]}-{hashlib.sha256(folder.encode()).hexdigest()[:12]}"
            path = scratch_path(spark, "staged", tag, name)
            build(path)
            _staged[key] = path
        return _staged[key]


# --- sensor messages -------------------------------------------------------

def sensor_envelope(events: DataFrame, *, as_text_temperature: bool = False) -> DataFrame:
    """events -> the sensor message fields (id, timestamp, value{...}).

    Error events carry no temperature, which the validity filter removes.
    ``as_text_temperature`` encodes every temperature as a JSON string, a
    producer bug that makes every message invalid.
    """
    temperature = F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value"))
    if as_text_temperature:
        temperature = temperature.cast("string")
    return events.select(
        F.col("event_id"),
        F.col("ts"),
        F.col("event_id").cast("string").alias("id"),
        F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.struct(
            F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("sensor_id"),
            temperature.alias("temperature"),
            F.get_json_object(F.col("props"), "$.k").cast("int").alias("humidity"),
            (F.col("event_id") % 100 + 950).cast("int").alias("pressure"),
        ).alias("value"),
    )


def kafka_frames(envelope: DataFrame, topic: str = SENSOR_TOPIC) -> DataFrame:
    """Envelope rows -> rows shaped like Spark's Kafka source."""
    return envelope.select(
        F.col("id").cast("binary").alias("key"),
        encode_json_bytes("id", "timestamp", "value").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("id"), F.lit(TOPIC_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _write_topic(frames: DataFrame, path: str, rows_per_file: int = ROWS_PER_TOPIC_FILE) -> None:
    (frames.write.mode("overwrite")
     .option("maxRecordsPerFile", rows_per_file)
     .parquet(path))


def _spread(events: DataFrame, frames: DataFrame, minimum: int) -> DataFrame:
    n = max(minimum, math.ceil(events.count() / ROWS_PER_TOPIC_FILE))
    return frames.repartition(n)


def sensor_topic(spark: SparkSession, sf_dir: str) -> str:
    """Kafka-shaped message files from ``events``, spread like topic partitions."""
    def build(path: str) -> None:
        events = table(spark, sf_dir, "events")
        _write_topic(_spread(events, kafka_frames(sensor_envelope(events)), MIN_TOPIC_FILES), path)
    return _once(spark, sf_dir, "sensor_topic", build)


def sensor_topic_capped(spark: SparkSession, sf_dir: str, rows_per_file: int) -> str:
    """The same messages in files of at most ``rows_per_file`` rows (one file = one capped batch)."""
    def build(path: str) -> None:
        _write_topic(kafka_frames(sensor_envelope(table(spark, sf_dir, "events"))), path, rows_per_file)
    return _once(spark, sf_dir, f"sensor_topic_capped_{rows_per_file}", build)


def bytes_per_batch(spark: SparkSession, path: str, batches: int) -> int:
    """Bytes of a batch that make about ``batches`` of the files at ``path``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return max(1, files.agg(F.sum("length").alias("n")).first()["n"] // batches)


def files_per_batch(spark: SparkSession, path: str, batches: int, most: int) -> int:
    """Files of a batch that make at least about ``batches`` of the files at ``path``, at most ``most``."""
    files = sum(name.endswith(".parquet") for name in folders.names(spark, path))
    return max(1, min(most, files // batches))


def sensor_topic_shuffled(spark: SparkSession, sf_dir: str) -> str:
    """Message files whose arrival order is not event-time order.

    Rows are spread over files by a hash of the id, so each micro-batch
    mixes early and late events.
    """
    def build(path: str) -> None:
        events = table(spark, sf_dir, "events")
        frames = kafka_frames(sensor_envelope(events))
        n = max(MIN_SHUFFLED_FILES, math.ceil(events.count() / ROWS_PER_TOPIC_FILE))
        _write_topic(frames.repartition(n, F.xxhash64("key")), path)
    return _once(spark, sf_dir, "sensor_topic_shuffled", build)


def _write_in_order(frames: DataFrame, path: str) -> None:
    """Files of ``frames``, a partition each, whose modification times follow the order of the partitions.

    One job writes all files side by side; then they are dated a second apart.  Where the
    file system doesn't keep such times, the files are copied one after the other.
    """
    spark = frames.sparkSession
    frames.write.mode("overwrite").parquet(path)
    if folders.date_in_order(spark, path):
        return
    dealt = f"{path}-dealt"
    frames.write.mode("overwrite").parquet(dealt)
    folders.remove(spark, path)
    for name in sorted(n for n in folders.names(spark, dealt) if n.startswith("part-")):
        spark.read.schema(frames.schema).parquet(f"{dealt}/{name}").coalesce(1).write.mode("append").parquet(path)
    folders.remove(spark, dealt)


def sensor_topic_redelivered(spark: SparkSession, sf_dir: str) -> str:
    """Each message delivered one to three times within 50 s, in files that come in order but are not ordered inside.

    A copy has a later broker time and an offset of its own.  Files are dated
    one after the other, as a topic's messages arrive: a file stream reads
    the oldest first.
    """
    def build(path: str) -> None:
        frames = kafka_frames(sensor_envelope(table(spark, sf_dir, "events")))
        some = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n))
        copies = frames.withColumn("copy", F.explode(F.sequence(F.lit(0), some(3, "key").cast("int"))))
        later = F.col("copy") * (some(20, "offset") + 5)
        sent = (copies.withColumn("timestamp", F.timestamp_seconds(F.unix_micros("timestamp") / 1e6 + later))
                .withColumn("offset", F.col("offset") * 3 + F.col("copy"))
                .withColumn("arrival", F.unix_micros("timestamp") + 1_000_000 * some(10, "offset", "copy")).drop("copy"))
        found = sent.agg(F.count(F.lit(1)).alias("rows"), F.count("arrival").alias("timed")).first()
        n = max(MIN_TOPIC_FILES, math.ceil(found["rows"] / ROWS_PER_TOPIC_FILE))
        if found["timed"]:  # what has no time arrives nowhere among those that have one
            sent = sent.where("arrival IS NOT NULL")
        _write_in_order(sent.repartitionByRange(n, "arrival").drop("arrival"), path)
    return _once(spark, sf_dir, "sensor_topic_redelivered", build)


def sensor_topic_invalid(spark: SparkSession, sf_dir: str) -> str:
    """Message files in which no message passes the validity filter."""
    def build(path: str) -> None:
        events = table(spark, sf_dir, "events")
        frames = kafka_frames(sensor_envelope(events, as_text_temperature=True))
        _write_topic(_spread(events, frames, MIN_TOPIC_FILES), path)
    return _once(spark, sf_dir, "sensor_topic_invalid", build)


def faulty(frames: DataFrame) -> DataFrame:
    """Message frames as broken producers send them: the fault follows from the offset.

    Of each 13 offsets, one has its text cut off, one is a JSON array, one lacks
    the sensor, one has the temperature as text.
    """
    text, turn = F.col("value").cast("string"), F.pmod("offset", F.lit(13))
    broken = (F.when(turn == 1, F.expr("substring(cast(value AS string), 1, length(cast(value AS string)) - 2)"))
              .when(turn == 2, F.concat(F.lit("["), text, F.lit("]")))
              .when(turn == 3, F.regexp_replace(text, '"sensor_id":"[^"]*"', '"sensor_id":null'))
              .when(turn == 4, F.regexp_replace(text, '"temperature":([^,]*),', '"temperature":"$1",'))
              .otherwise(text))
    return frames.withColumn("value", broken.cast("binary"))


def sensor_topic_faulty(spark: SparkSession, sf_dir: str) -> str:
    """Message files with messages that are rejected for every reason."""
    def build(path: str) -> None:
        events = table(spark, sf_dir, "events")
        _write_topic(_spread(events, faulty(kafka_frames(sensor_envelope(events))), MIN_TOPIC_FILES), path)
    return _once(spark, sf_dir, "sensor_topic_faulty", build)


# --- multi-line JSON arrays ----------------------------------------------

def write_json_arrays(df: DataFrame, path: str, bucket_key: str,
                      rows_per_file: int = ROWS_PER_JSON_ARRAY, large_files: int | None = None) -> None:
    """Write ``df`` (minus ``bucket_key``) as pretty multi-line files, each one JSON array.

    Rows go to ``n = ceil(rows / rows_per_file)`` groups by ``bucket_key mod n``
    (a unique integer key), so every array holds about ``rows_per_file``
    elements whatever the table size.  Each group lands in its own
    ``file=<g>/`` directory as a single file.  ``large_files`` gives the number
    of groups instead: rows are dealt by a hash, and each group has a task of its own.
    """
    n_files = large_files or max(1, math.ceil(df.count() / rows_per_file))
    doc_cols = [c for c in df.columns if c != bucket_key]
    docs = df.select(encode_json(*doc_cols).alias("doc"), F.col(bucket_key).alias("key"))
    if large_files:  # a plain hash could put several files into one shuffle partition
        docs = docs.withColumn("file", F.pmod(F.xxhash64("key", "doc"), F.lit(n_files)).cast("int")).repartitionById(n_files, F.col("file"))
    else:
        docs = docs.withColumn("file", F.pmod(F.col("key"), F.lit(n_files)))
    # Rows are written one after the other; an array is never held as a whole.
    order = Window.partitionBy("file").orderBy("key")
    there = F.lit(True)
    opens, closes = F.lag(there).over(order).isNull(), F.lead(there).over(order).isNull()
    line = F.concat(F.when(opens, "[\n  ").otherwise("  "), F.col("doc"), F.when(closes, "\n]").otherwise(","))
    docs.select("file", line.alias("value")).write.mode("overwrite").partitionBy("file").text(path)


def weather_frame(events: DataFrame) -> DataFrame:
    """events -> current-weather documents (time without seconds), keyed by event_id."""
    return events.select(
        F.col("event_id"),
        F.col("value").alias("latitude"),
        F.col("user_id").cast("double").alias("longitude"),
        F.col("event_type").alias("timezone"),
        F.struct(F.lit("iso8601").alias("time")).alias("current_weather_units"),
        F.struct(
            F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm").alias("time"),
            F.col("value").alias("temperature"),
            F.get_json_object(F.col("props"), "$.k").cast("double").alias("windspeed"),
        ).alias("current_weather"),
    )


def weather_documents(spark: SparkSession, sf_dir: str) -> str:
    """Current-weather documents from ``events`` (time without seconds)."""
    def build(path: str) -> None:
        docs = weather_frame(table(spark, sf_dir, "events"))
        write_json_arrays(docs, path, "event_id")
    return _once(spark, sf_dir, "weather_documents", build)


def record_documents(spark: SparkSession, sf_dir: str) -> str:
    """Flat records ``(userId, id, title, body)`` from ``documents`` as JSON arrays."""
    def build(path: str) -> None:
        docs = table(spark, sf_dir, "documents")
        write_json_arrays(records_frame(docs).withColumn("doc_key", F.col("id")), path, "doc_key")
    return _once(spark, sf_dir, "record_documents", build)


def records_frame(documents: DataFrame) -> DataFrame:
    return documents.select(
        (F.col("doc_id") % 10).alias("userId"),
        F.col("doc_id").alias("id"),
        F.concat_ws(" ", F.col("lang"), F.col("source")).alias("title"),
        F.col("text").alias("body"),
    )


# --- CSV exports -----------------------------------------------------------

def csv_export(df: DataFrame, path: str, *, header: bool) -> None:
    """CSV as other systems write it: RFC-4180 quoting, whitespace kept."""
    (df.write.mode("overwrite")
     .option("header", header)
     .option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))


# The customer export is this many files, each with its own header line: part
# of the input, whatever its size.
CUSTOMER_FILES = 4


def part_csv(spark: SparkSession, sf_dir: str) -> str:
    def build(path: str) -> None:
        csv_export(table(spark, sf_dir, "part"), path, header=True)
    return _once(spark, sf_dir, "part_csv", build)


def customer_csv(spark: SparkSession, sf_dir: str) -> str:
    """``customer`` in ``CUSTOMER_FILES`` files by key, each with a header line."""
    def build(path: str) -> None:
        customer = table(spark, sf_dir, "customer")
        dealt = customer.repartitionById(CUSTOMER_FILES, F.pmod("c_custkey", F.lit(CUSTOMER_FILES)).cast("int"))
        csv_export(dealt, path, header=True)
    return _once(spark, sf_dir, "customer_csv", build)


def conversations_csv(spark: SparkSession, sf_dir: str) -> str:
    """``conversations`` without header; texts span lines and hold quotes."""
    def build(path: str) -> None:
        csv_export(table(spark, sf_dir, "conversations"), path, header=False)
    return _once(spark, sf_dir, "conversations_csv", build)


# --- Parquet with two column sets --------------------------------------------

# Orders before this date were exported without a priority; later exports
# dropped the status and added the priority.
ORDERS_SCHEMA_CHANGE = "1998-01-01"
ORDERS_V1_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
ORDERS_V2_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders_before(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderdate") < F.lit(ORDERS_SCHEMA_CHANGE).cast("timestamp_ntz"))


def orders_from(orders: DataFrame) -> DataFrame:
    """The later orders, and those without a date."""
    date = F.col("o_orderdate")
    return orders.filter(date.isNull() | (date >= F.lit(ORDERS_SCHEMA_CHANGE).cast("timestamp_ntz")))


def orders_two_schemas(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """``orders`` as two Parquet directories with different column sets."""
    def build(path: str) -> None:
        orders = table(spark, sf_dir, "orders")
        orders_before(orders).select(*ORDERS_V1_COLUMNS).write.mode("overwrite").parquet(f"{path}/v1")
        orders_from(orders).select(*ORDERS_V2_COLUMNS).write.mode("overwrite").parquet(f"{path}/v2")
    root = _once(spark, sf_dir, "orders_two_schemas", build)
    return f"{root}/v1", f"{root}/v2"


def part_drifted(spark: SparkSession, sf_dir: str) -> str:
    """``part`` as three exports into one folder: the size is an int, then a long, then a double, the last without the type."""
    def build(path: str) -> None:
        part = table(spark, sf_dir, "part")
        for n, kind in enumerate(("int", "bigint", "double")):
            rows = part.where(F.pmod("p_partkey", F.lit(3)) == n).withColumn("p_size", F.col("p_size").cast(kind))
            (rows.drop("p_type") if kind == "double" else rows).write.mode("append").parquet(path)
    return _once(spark, sf_dir, "part_drifted", build)


# --- JSON lines whose keys differ only in case ---------------------------------

def events_case_keys(spark: SparkSession, sf_dir: str) -> str:
    """JSON lines ``{"id": event_id, "ID": user_id}`` from ``events``."""
    def build(path: str) -> None:
        events = table(spark, sf_dir, "events")
        body = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("user_id").alias("ID")))
        events.select(body.alias("value")).write.mode("overwrite").text(path)
    return _once(spark, sf_dir, "events_case_keys", build)


# --- few large files -------------------------------------------------------------

def record_array(spark: SparkSession, sf_dir: str) -> str:
    """All records of ``documents`` as JSON arrays of up to ``BYTES_PER_LARGE_ARRAY`` or so, a file each, as fetched documents land.

    A file has one writer, so one array of a whole large table would pass through one task.
    """
    def build(path: str) -> None:
        docs = table(spark, sf_dir, "documents")
        size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 100).alias("n")).first()["n"] or 0
        write_json_arrays(records_frame(docs).withColumn("doc_key", F.col("id")), path, "doc_key",
                          large_files=max(1, math.ceil(size / BYTES_PER_LARGE_ARRAY)))
    return _once(spark, sf_dir, "record_array", build)


def conversations_one_csv(spark: SparkSession, sf_dir: str) -> str:
    """``conversations`` as one CSV file with a header and line ends inside quotes."""
    def build(path: str) -> None:
        csv_export(table(spark, sf_dir, "conversations").coalesce(1), path, header=True)
    return _once(spark, sf_dir, "conversations_one_csv", build)
