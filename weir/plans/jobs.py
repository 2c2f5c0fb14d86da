"""Registered jobs: each takes ``(spark, sf_dir)`` and returns a DataFrame.

The jobs run the library end to end on inputs staged from the driver tables
(:mod:`weir.plans.staging`): sources -> transforms -> sinks, and, where the
operator is a sink or a stream, a read of what was written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import operators as ops
from weir import sinks, sources
from weir.functions.json import decode_json
from weir.functions.time import format_event_time
from weir.plans import ingest, staging
from weir.schemas import (
    RECORD,
    RECORD_TARGET_NAMES,
    SENSOR_COLUMNS,
    SENSOR_ENVELOPE,
    SENSOR_SORT_KEYS,
    SENSOR_TARGET,
    WEATHER_DOCUMENT,
    WEATHER_DOCUMENT_TYPED_TIME,
)
from weir.session import case_sensitive_session, fresh_path, in_one_process
from weir.streaming import FailOnce, FanOutSink, IdempotentFileSink, ProgressLog, read_batches, read_progress, run_available
from weir.streaming.batch_sinks import read_batch_log

Job = Callable[[SparkSession, str], DataFrame]

# Catch-up streams cut their topic into about this many batches by volume,
# whatever its size.
CATCH_UP_BATCHES = 4
# The stream that tells redelivered messages runs in at least about this many
# batches, so that its state is used across them.
REDELIVERED_BATCHES = 8
# What a batch adds to the state is bounded, whatever the topic's size.
FILES_PER_STATEFUL_BATCH = 32


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_topic_files(spark, staging.sensor_topic(spark, sf_dir))


# --- batch: messages --------------------------------------------------------

def sensor_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages -> parse -> flatten -> drop rows without sensor or temperature."""
    return ops.sensor_readings(_messages(spark, sf_dir))


def kafka_raw_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset as text, broker timestamp and the message text."""
    return ops.raw_message_view(_messages(spark, sf_dir))


def event_time_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp text (ISO with ``T`` and micros, or SQL style) -> seconds text."""
    msgs = ops.parse_messages(_messages(spark, sf_dir), keep=("offset",)).select(
        F.lit("events").alias("source"),
        F.col("offset").alias("key"),
        format_event_time(F.col("data.timestamp")).alias("event_time"))
    orders = staging.table(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"),
        F.col("o_orderkey").alias("key"),
        format_event_time(F.col("o_orderdate").cast("string")).alias("event_time"))
    return msgs.unionByName(orders)


def json_envelope_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows -> Kafka records with JSON values -> decoded back into columns."""
    envelope = staging.sensor_envelope(staging.table(spark, sf_dir, "events"))
    records = sinks.to_kafka_records(envelope, ["id", "timestamp", "value"], key="id")
    decoded = records.select(F.col("key").cast("string").alias("key"),
                             decode_json("value", SENSOR_ENVELOPE).alias("m"))
    return decoded.select(
        "key",
        F.col("m.id").alias("id"),
        F.col("m.timestamp").alias("timestamp"),
        F.col("m.value.sensor_id").alias("sensor_id"),
        F.col("m.value.temperature").alias("temperature"),
        F.col("m.value.humidity").alias("humidity"),
        F.col("m.value.pressure").alias("pressure"),
    )


def required_fields_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The warehouse column check on the flattened frame, and on one that lacks a column."""
    flat = sensor_flatten(spark, sf_dir)
    found = []
    for case, df in (("complete", flat), ("without sensor_id", flat.drop("sensor_id"))):
        try:
            report = ops.require_columns(df, SENSOR_COLUMNS).agg(F.count(F.lit(1)).alias("rows")).withColumn("missing", F.lit(""))
        except ops.MissingColumnsError:
            absent = ",".join(ops.missing_columns(df, SENSOR_COLUMNS))
            report = df.limit(0).agg(F.count(F.lit(1)).alias("rows")).withColumn("missing", F.lit(absent))
        found.append(report.withColumn("case", F.lit(case)))
    return found[0].unionByName(found[1]).select("case", "missing", "rows")


# --- batch: documents and records ----------------------------------------------

def weather_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sources.read_json_documents(spark, staging.weather_documents(spark, sf_dir), WEATHER_DOCUMENT)
    return ops.flatten_weather(raw)


def weather_core(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sources.read_json_documents(spark, staging.weather_documents(spark, sf_dir),
                                      WEATHER_DOCUMENT_TYPED_TIME)
    return ops.weather_core(raw)


def weather_landed_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetched documents landed as raw payloads, then read back and flattened.

    The landing replaces what was there and only happens when there are
    payloads; the loader parses each landed document with the declared schema.
    """
    docs = staging.weather_frame(staging.table(spark, sf_dir, "events"))
    payloads = docs.select(F.to_json(F.struct(*[c for c in docs.columns if c != "event_id"])).alias("payload"))
    landing = fresh_path(spark, "weather_landing")
    ingest.land_payloads(payloads, landing)
    return ops.flatten_weather(sources.read_landed_documents(spark, landing, WEATHER_DOCUMENT))


def json_records_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON arrays of flat records -> one row per record, declared columns."""
    return sources.read_json_documents(spark, staging.record_documents(spark, sf_dir), RECORD)


def positional_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.positional_rename(json_records_scan(spark, sf_dir), RECORD_TARGET_NAMES,
                                 source=RECORD.fieldNames())


def records_csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> CSV with header -> re-read typed -> positional rename."""
    csv_path = fresh_path(spark, "records_csv")
    sinks.write_csv(json_records_scan(spark, sf_dir), csv_path, header=True)
    reread = sources.read_csv(spark, csv_path, header=True, schema=RECORD, multi_line=True)
    return ops.positional_rename(reread, RECORD_TARGET_NAMES)


# --- batch: CSV, Parquet, range, listing ---------------------------------------

def csv_header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_csv(spark, staging.part_csv(spark, sf_dir), header=True)


def csv_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same export with its types inferred from the values."""
    return sources.read_csv(spark, staging.part_csv(spark, sf_dir), header=True, infer_schema=True)


def csv_noheader_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-bearing CSV read without the header option: header lines become rows."""
    return sources.read_csv(spark, staging.customer_csv(spark, sf_dir), header=False)


def csv_multiline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_csv(spark, staging.conversations_csv(spark, sf_dir), header=False, multi_line=True)


def json_array_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with one large JSON array each (a single file up to 256 MB), every file read by many tasks."""
    return sources.read_json_arrays(spark, staging.record_array(spark, sf_dir), RECORD)


def csv_records_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file with line ends inside quotes and a header, read by many tasks."""
    return sources.read_csv_records(spark, staging.conversations_one_csv(spark, sf_dir), header=True)


def parquet_merge_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    v1, v2 = staging.orders_two_schemas(spark, sf_dir)
    return sources.read_parquet_merged(spark, v1, v2)


def parquet_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of files whose columns differ in type and number, as one table."""
    return sources.read_parquet_widened(spark, staging.part_drifted(spark, sf_dir)).select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


def range_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dense id sequence as long as ``orders``."""
    n = staging.table(spark, sf_dir, "orders").count()
    return sources.integer_range(spark, n)


def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every object of the weather landing: its directory and file type.

    File names carry a write id and sizes depend on formatting, so the
    comparable part of each key is its ``file=<g>`` directory and extension.
    """
    listed = sources.list_objects(spark, staging.weather_documents(spark, sf_dir))
    return listed.select(F.regexp_extract("key", r"^(file=[0-9]+)/", 1).alias("prefix"),
                         F.regexp_extract("key", r"\.([a-z]+)$", 1).alias("extension"))


def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.row_count(staging.table(spark, sf_dir, "lineitem"), "row_count")


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.load_report(staging.table(spark, sf_dir, "lineitem")) \
        .select(F.col("rows").alias("row_count"), F.col("columns").alias("column_count"))


def case_sensitive_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON whose keys differ only in case, resolved case-sensitively.

    The setting has to hold while the files are read, so a session of its own
    writes the selection to the scratch area, and the result is read back.
    """
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("ID", T.LongType())])
    out = fresh_path(spark, "case_sensitive")
    own = case_sensitive_session(spark)
    df = sources.read_json_lines(own, staging.events_case_keys(spark, sf_dir), schema)
    df.select(F.col("id").alias("lower_id"), F.col("ID").alias("upper_id")).write.parquet(out)
    return spark.read.parquet(out)


# --- sinks -----------------------------------------------------------------------

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
ORDERS_DDL_TYPES = "o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(32)"


def _derby_url(spark: SparkSession, name: str) -> str:
    path = fresh_path(spark, name)
    if ":" in path.split("/", 1)[0]:
        path = path.split(":", 1)[1]
    return f"jdbc:derby:{path};create=true"


def jdbc_target(spark: SparkSession, name: str) -> tuple[str, dict]:
    """The database the JDBC jobs write to: ``(url, connection options)``.

    Set ``spark.weir.jdbc.url`` (and ``.driver``, ``.user``, ``.password``)
    to use a real warehouse.  Without it, in local mode only, an embedded
    Derby database in the scratch area stands in (same JVM, no server).
    """
    url = spark.conf.get("spark.weir.jdbc.url", None)
    if url:
        conn = {k: spark.conf.get(f"spark.weir.jdbc.{k}", None) for k in ("driver", "user", "password")}
        return url, {k: v for k, v in conn.items() if v is not None}
    if not in_one_process(spark):  # a Derby database is seen by one JVM only
        raise ValueError("set spark.weir.jdbc.url: embedded Derby only works in local mode")
    return _derby_url(spark, name), {"driver": DERBY_DRIVER}


def _read_orders_back(spark: SparkSession, url: str, table: str, conn: dict) -> DataFrame:
    back = sources.read_table(spark, url, table, partition_column="o_orderkey", **conn)
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


def _table_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:8]}".upper()


def jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends (orders before and from 1998) into one table, read back."""
    orders = staging.table(spark, sf_dir, "orders")
    (url, conn), table = jdbc_target(spark, "derby_append"), _table_name("orders_append")
    for part in (staging.orders_before(orders), staging.orders_from(orders)):
        sinks.append_table(part, url, table, extra={"createTableColumnTypes": ORDERS_DDL_TYPES}, **conn)
    return _read_orders_back(spark, url, table, conn)


def jdbc_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load A (orders before 1998), then full refresh with B (all orders)."""
    orders = staging.table(spark, sf_dir, "orders")
    (url, conn), table = jdbc_target(spark, "derby_refresh"), _table_name("orders_refresh")
    for load in (staging.orders_before(orders), orders):
        sinks.replace_table(load, url, table, extra={"createTableColumnTypes": ORDERS_DDL_TYPES}, **conn)
    return _read_orders_back(spark, url, table, conn)


def jdbc_append_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads (orders before and from 1998), each sent twice under its name: every row once."""
    orders = staging.table(spark, sf_dir, "orders")
    (url, conn), table = jdbc_target(spark, "derby_once"), _table_name("orders_once")
    for name, part in (("before", staging.orders_before(orders)), ("from", staging.orders_from(orders))) * 2:
        sinks.append_once(part, url, table, name, max_connections=4, extra={"createTableColumnTypes": ORDERS_DDL_TYPES}, **conn)
    return _read_orders_back(spark, url, table, conn)


def jdbc_change_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older state of orders (some missing, some different, some since deleted), then the present one by its changes."""
    orders = staging.table(spark, sf_dir, "orders")
    (url, conn), table = jdbc_target(spark, "derby_changes"), _table_name("orders_changes")
    key = F.col("o_orderkey")
    older = orders.where(key % 7 != 0).withColumn("o_totalprice", F.when(key % 5 == 0, 0.0).otherwise(F.col("o_totalprice")))
    gone = orders.where(key % 11 == 0).withColumn("o_orderkey", -key - 1)
    for state in (older.unionByName(gone), orders):
        sinks.refresh_changes(state, url, table, ["o_orderkey"], partition_column="o_orderkey",
                              extra={"createTableColumnTypes": ORDERS_DDL_TYPES}, **conn)
    return _read_orders_back(spark, url, table, conn)


PAGE_PAYLOAD = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("payload", T.StringType())])


def raw_land_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land page URLs, then replace the landing with the raw HTML."""
    pages = staging.table(spark, sf_dir, "pages")
    landing = fresh_path(spark, "raw_landing")
    sinks.land_raw(pages.select("page_id", F.col("url").alias("payload")), landing, ["page_id", "payload"])
    sinks.land_raw(pages.select("page_id", F.col("html").alias("payload")), landing, ["page_id", "payload"])
    return sources.read_json_lines(spark, sources.current_landing(spark, landing), PAGE_PAYLOAD)


def sorted_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor rows conformed to the warehouse table, laid out by (event_time, sensor_id)."""
    out = fresh_path(spark, "sensor_table")
    sinks.write_sorted(ops.conform(sensor_flatten(spark, sf_dir), SENSOR_TARGET), out, SENSOR_SORT_KEYS, tie_breaker=["message_id"])
    return spark.read.schema(SENSOR_TARGET).parquet(out)


# --- streaming -----------------------------------------------------------------

def _ingest(spark: SparkSession, topic_path: str, *, files_per_trigger: int | None = None, watermark: bool = False,
            fail_after_batch: int | None = None, with_log: bool = False, once: bool = False,
            query_name: str | None = None) -> tuple[str, str | None]:
    """Stream messages into an idempotent per-batch table; returns (table, log)."""
    run = fresh_path(spark, "ingest")
    table, checkpoint = f"{run}/table", f"{run}/checkpoint"
    log = f"{run}/log" if with_log else None
    wm = ingest.SENSOR_WATERMARK if watermark or once else None
    if once and not files_per_trigger:  # what a batch adds to the state is bounded
        files_per_trigger = staging.files_per_batch(spark, topic_path, CATCH_UP_BATCHES, FILES_PER_STATEFUL_BATCH)
    volume = None if files_per_trigger else staging.bytes_per_batch(spark, topic_path, CATCH_UP_BATCHES)

    def messages() -> DataFrame:
        return sources.stream_topic_files(spark, topic_path, files_per_trigger, volume)

    if fail_after_batch is None:
        ingest.sensor_stream_to_table(messages(), table, checkpoint, log_path=log, watermark=wm, once=once, query_name=query_name)
        return table, log
    sink = ingest.sensor_table_sink(table, log)
    try:
        run_available(ingest.flattened_sensor_stream(messages(), wm), FailOnce(sink, fail_after_batch), checkpoint, query_name=query_name)
    except Exception as exc:  # the injected failure surfaces as a query exception
        if "injected failure" not in str(exc):
            raise
    # Restart from the same checkpoint: the failed batch runs again.
    run_available(ingest.flattened_sensor_stream(messages(), wm), sink, checkpoint, query_name=query_name)
    return table, log


def _read_sensor_table(spark: SparkSession, table: str) -> DataFrame:
    return read_batches(spark, table, SENSOR_TARGET).select(*SENSOR_COLUMNS)


def stream_sensor_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed into batches of the declared table, then compacted into its sorted layout."""
    table, _ = _ingest(spark, staging.sensor_topic(spark, sf_dir))
    compacted = fresh_path(spark, "sensor_table")
    sinks.write_sorted(_read_sensor_table(spark, table), compacted, SENSOR_SORT_KEYS, tie_breaker=["message_id"])
    return spark.read.schema(SENSOR_TARGET).parquet(compacted)


def stream_sorted_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages streamed into batches; each batch is added to the sorted layout, whose files it leaves alone unless it overlaps them."""
    table, _ = _ingest(spark, staging.sensor_topic_redelivered(spark, sf_dir), once=True)
    layout = fresh_path(spark, "sensor_layout")
    batches = spark.read.parquet(table).select("batch_id").distinct().orderBy("batch_id")
    for row in batches.toLocalIterator():  # a number per batch
        sinks.compact_batches(spark, table, layout, SENSOR_TARGET, SENSOR_SORT_KEYS, until=row["batch_id"], tie_breaker=["message_id"])
    return sinks.read_layout(spark, layout, SENSOR_TARGET, SENSOR_SORT_KEYS)


def stream_watermark_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-order messages under a 1-minute watermark: nothing is dropped."""
    table, _ = _ingest(spark, staging.sensor_topic_shuffled(spark, sf_dir), watermark=True)
    return _read_sensor_table(spark, table)


def stream_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered one to three times, out of order: each once, told by a state that follows the watermark."""
    run = fresh_path(spark, "redelivered")
    topic = staging.sensor_topic_redelivered(spark, sf_dir)
    files = staging.files_per_batch(spark, topic, REDELIVERED_BATCHES, FILES_PER_STATEFUL_BATCH)
    messages = sources.stream_topic_files(spark, topic, max_files_per_trigger=files)
    ingest.sensor_stream_to_table(messages, f"{run}/table", f"{run}/checkpoint", once=True)
    return _read_sensor_table(spark, f"{run}/table")


def stream_restart_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fail after writing the first batch, restart: every message exactly once.

    The failed batch was written but not committed, so the restarted query
    runs it again and its folder is replaced rather than duplicated.
    """
    table, _ = _ingest(spark, staging.sensor_topic(spark, sf_dir), fail_after_batch=0)
    return _read_sensor_table(spark, table)


def batch_row_counts(spark: SparkSession, sf_dir: str, cap: int | None = None) -> DataFrame:
    """Rows per micro-batch under a cap on a batch's rows (without one: an eighth of the topic)."""
    if cap is None:
        cap = max(1, -(-staging.table(spark, sf_dir, "events").count() // 8))
    _, log = _ingest(spark, staging.sensor_topic_capped(spark, sf_dir, cap), files_per_trigger=1, with_log=True)
    return read_batch_log(spark, log).agg(
        F.sum("rows_in").alias("total_rows"),
        F.sum("rows_out").alias("valid_rows"),
        (F.max("rows_in") <= F.lit(cap)).alias("within_cap"),
    )


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What Spark reported of each trigger, over a failure and a restart, beside the batch log."""
    name = f"progress-{uuid.uuid4().hex[:8]}"
    reported = fresh_path(spark, "progress")
    with ProgressLog(spark, reported, {name}):
        _, log = _ingest(spark, staging.sensor_topic(spark, sf_dir), fail_after_batch=0, with_log=True, query_name=name)
    progress = read_progress(spark, reported).where("rows > 0").select("batch_id", "rows")
    both = progress.join(read_batch_log(spark, log), "batch_id", "full_outer")
    return both.agg(F.sum("rows").alias("rows_read"), F.sum("rows_out").alias("rows_written"),
                    F.bool_and(F.col("rows").eqNullSafe(F.col("rows_in"))).alias("batches_agree"))


def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message invalid: every batch is skipped, nothing is written."""
    _, log = _ingest(spark, staging.sensor_topic_invalid(spark, sf_dir), with_log=True)
    return read_batch_log(spark, log).agg(
        F.sum("rows_in").alias("rows_in"),
        F.sum("rows_out").alias("rows_written"),
        F.count_if(F.col("written")).alias("batches_written"),
    )


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query, one read of the topic, three outputs: raw landing, warehouse, rejects.

    Returns what the batch log counted and what the outputs hold.
    """
    run = fresh_path(spark, "fanout")
    place = ("offset", "timestamp", "value")
    parsed = lambda d: ops.flatten_sensor(ops.parse_messages(d, keep=place), keep=place)
    fan = FanOutSink({
        "raw": (ops.raw_message_view, IdempotentFileSink(f"{run}/raw", name="raw")),
        "warehouse": (None, ingest.sensor_table_sink(f"{run}/warehouse", name="warehouse")),
        "rejected": (lambda d: d.drop(*place), IdempotentFileSink(f"{run}/rejected", keep=ops.rejected_readings, name="rejected")),
    }, log_path=f"{run}/log", shared=parsed)
    topic = staging.sensor_topic(spark, sf_dir)
    stream = sources.stream_topic_files(spark, topic, max_bytes_per_trigger=staging.bytes_per_batch(spark, topic, CATCH_UP_BATCHES))
    run_available(stream, fan, f"{run}/checkpoint")
    counted = read_batch_log(spark, f"{run}/log").groupBy("branch").agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_out").alias("rows_out"))
    held = None
    for name in fan.branches:
        rows = read_batches(spark, f"{run}/{name}").agg(F.count(F.lit(1)).alias("rows_held")).withColumn("branch", F.lit(name))
        held = rows if held is None else held.unionByName(rows)
    return counted.join(held, "branch").select("branch", "rows_in", "rows_out", "rows_held")


def stream_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with every fault, parsed once: valid readings to the warehouse, the others to a reject table with their reason.

    Returns the rows per reason that the reject table holds, and those of the warehouse as ``accepted``.
    """
    run = fresh_path(spark, "reasons")
    fan = FanOutSink({
        "warehouse": (lambda d: ops.conform(ops.accepted(d), SENSOR_TARGET), IdempotentFileSink(f"{run}/warehouse", name="warehouse")),
        "rejected": (ops.rejected, IdempotentFileSink(f"{run}/rejected", name="rejected")),
    }, log_path=f"{run}/log", shared=lambda d: ops.classified_readings(d, keep=("offset",)))
    topic = staging.sensor_topic_faulty(spark, sf_dir)
    stream = sources.stream_topic_files(spark, topic, max_bytes_per_trigger=staging.bytes_per_batch(spark, topic, CATCH_UP_BATCHES))
    run_available(stream, fan, f"{run}/checkpoint")
    held = T.StructType([T.StructField("reason", T.StringType())])
    reasons = ops.reason_counts(read_batches(spark, f"{run}/rejected", held).select("reason"))
    warehouse = read_batches(spark, f"{run}/warehouse", SENSOR_TARGET)
    return reasons.unionByName(warehouse.agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("rows")))


SENSOR_DDL_TYPES = "message_id VARCHAR(32), sensor_id VARCHAR(64)"
WEATHER_DDL_TYPES = "timezone VARCHAR(64), format_time VARCHAR(16)"


def stream_jdbc_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor messages streamed into a JDBC table, one append per micro-batch."""
    (url, conn), table = jdbc_target(spark, "derby_stream"), _table_name("sensor_metrics")
    run = fresh_path(spark, "jdbc_ingest")
    topic = staging.sensor_topic(spark, sf_dir)
    messages = sources.stream_topic_files(spark, topic, max_bytes_per_trigger=staging.bytes_per_batch(spark, topic, CATCH_UP_BATCHES))
    query = ingest.sensor_stream_to_jdbc(messages, url, table, f"{run}/checkpoint", trigger="availableNow",
                                         extra={"createTableColumnTypes": SENSOR_DDL_TYPES}, **conn)
    query.awaitTermination()
    return sources.read_table(spark, url, table, partition_column="batch_id", **conn).select(*SENSOR_COLUMNS)


def weather_jdbc_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather documents -> flat columns -> JDBC append, read back."""
    (url, conn), table = jdbc_target(spark, "derby_weather"), _table_name("weather")
    ingest.weather_to_jdbc(spark, staging.weather_documents(spark, sf_dir), url, table,
                           extra={"createTableColumnTypes": WEATHER_DDL_TYPES}, **conn)
    return sources.read_table(spark, url, table, partition_column="longitude", **conn)


def records_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records -> CSV -> typed re-read -> rename -> truncate and load, run twice."""
    (url, conn), table = jdbc_target(spark, "derby_records"), _table_name("records")
    for _ in range(2):
        ingest.refresh_records(spark, staging.record_documents(spark, sf_dir), fresh_path(spark, "records_csv"),
                               url, table, **conn)
    return sources.read_table(spark, url, table, partition_column="id", **conn)


JOBS: dict[str, Job] = {
    "sensor_flatten": sensor_flatten,
    "kafka_raw_view": kafka_raw_view,
    "event_time_format": event_time_format,
    "json_envelope_encode": json_envelope_encode,
    "required_fields_check": required_fields_check,
    "weather_flatten": weather_flatten,
    "weather_core": weather_core,
    "weather_landed_flatten": weather_landed_flatten,
    "json_records_scan": json_records_scan,
    "positional_rename": positional_rename,
    "records_csv_load": records_csv_load,
    "csv_header_scan": csv_header_scan,
    "csv_inferred_scan": csv_inferred_scan,
    "csv_noheader_scan": csv_noheader_scan,
    "csv_multiline_scan": csv_multiline_scan,
    "json_array_split_scan": json_array_split_scan,
    "csv_records_split_scan": csv_records_split_scan,
    "parquet_merge_schema": parquet_merge_schema,
    "parquet_widened": parquet_widened,
    "range_source": range_source,
    "object_listing": object_listing,
    "row_count": row_count,
    "load_report": load_report,
    "case_sensitive_select": case_sensitive_select,
    "jdbc_append": jdbc_append,
    "jdbc_full_refresh": jdbc_full_refresh,
    "jdbc_append_once": jdbc_append_once,
    "jdbc_change_refresh": jdbc_change_refresh,
    "raw_land_overwrite": raw_land_overwrite,
    "sorted_layout": sorted_layout,
    "stream_sensor_ingest": stream_sensor_ingest,
    "stream_sorted_layout": stream_sorted_layout,
    "stream_watermark_passthrough": stream_watermark_passthrough,
    "stream_redelivered": stream_redelivered,
    "stream_restart_resume": stream_restart_resume,
    "batch_row_counts": batch_row_counts,
    "stream_progress": stream_progress,
    "stream_empty_batch": stream_empty_batch,
    "stream_fanout": stream_fanout,
    "stream_reject_reasons": stream_reject_reasons,
    "stream_jdbc_ingest": stream_jdbc_ingest,
    "weather_jdbc_load": weather_jdbc_load,
    "records_full_refresh": records_full_refresh,
}


# Driver tables each job reads (for row-in accounting in bench.py).
INPUT_TABLES: dict[str, tuple[str, ...]] = {
    "sensor_flatten": ("events",),
    "kafka_raw_view": ("events",),
    "event_time_format": ("events", "orders"),
    "json_envelope_encode": ("events",),
    "required_fields_check": ("events",),
    "weather_flatten": ("events",),
    "weather_core": ("events",),
    "weather_landed_flatten": ("events",),
    "json_records_scan": ("documents",),
    "positional_rename": ("documents",),
    "records_csv_load": ("documents",),
    "csv_header_scan": ("part",),
    "csv_inferred_scan": ("part",),
    "csv_noheader_scan": ("customer",),
    "csv_multiline_scan": ("conversations",),
    "json_array_split_scan": ("documents",),
    "csv_records_split_scan": ("conversations",),
    "parquet_merge_schema": ("orders",),
    "parquet_widened": ("part",),
    "range_source": ("orders",),
    "object_listing": ("events",),
    "row_count": ("lineitem",),
    "load_report": ("lineitem",),
    "case_sensitive_select": ("events",),
    "jdbc_append": ("orders",),
    "jdbc_full_refresh": ("orders",),
    "jdbc_append_once": ("orders",),
    "jdbc_change_refresh": ("orders",),
    "raw_land_overwrite": ("pages",),
    "sorted_layout": ("events",),
    "stream_sensor_ingest": ("events",),
    "stream_sorted_layout": ("events",),
    "stream_watermark_passthrough": ("events",),
    "stream_redelivered": ("events",),
    "stream_restart_resume": ("events",),
    "batch_row_counts": ("events",),
    "stream_progress": ("events",),
    "stream_empty_batch": ("events",),
    "stream_fanout": ("events",),
    "stream_reject_reasons": ("events",),
    "stream_jdbc_ingest": ("events",),
    "weather_jdbc_load": ("events",),
    "records_full_refresh": ("documents",),
}
