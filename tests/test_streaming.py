"""Streams: checkpoint required, caps, empty batches, fan-out, watermark, restart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weir import operators as ops
from weir import sources
from weir.plans import jobs, staging
from weir.schemas import SENSOR_TARGET
from weir.streaming import FailOnce, IdempotentFileSink, read_batches, run_available, start_stream


def test_checkpoint_is_required(spark, sf_small):
    stream = sources.stream_topic_files(spark, staging.sensor_topic(spark, sf_small))
    with pytest.raises(ValueError):
        start_stream(stream, lambda df, i: None, "")


def test_batches_respect_cap(spark, sf_small):
    out = jobs.batch_row_counts(spark, sf_small, cap=1000).first()
    assert out["within_cap"] is True
    assert out["total_rows"] == staging.table(spark, sf_small, "events").count()


def test_cap_splits_batches(spark, scratch, sf_small):
    topic = scratch("topic")
    events = staging.table(spark, sf_small, "events")
    frames = staging.kafka_frames(staging.sensor_envelope(events)).repartition(4)
    frames.write.option("maxRecordsPerFile", 300).parquet(topic)
    run = scratch("run")
    sink = IdempotentFileSink(f"{run}/t", keep=ops.valid_readings, log_path=f"{run}/log")
    stream = ops.parse_messages(sources.stream_topic_files(spark, topic, 1)).transform(ops.flatten_sensor)
    q = run_available(stream, sink, f"{run}/ck")
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert len(sizes) >= 4 and max(sizes) <= 300 and sum(sizes) == events.count()


def test_empty_batches_write_nothing(spark, sf_small):
    out = jobs.stream_empty_batch(spark, sf_small).first()
    assert out["rows_written"] == 0 and out["batches_written"] == 0
    assert out["rows_in"] == staging.table(spark, sf_small, "events").count()


def test_fanout_reads_once_writes_both(spark, sf_small):
    rows = jobs.stream_fanout(spark, sf_small).collect()
    got = {r["branch"]: (r["rows_in"], r["rows_out"]) for r in rows}
    assert all(r["rows_held"] == r["rows_out"] for r in rows)
    assert got["warehouse"][1] + got["rejected"][1] == got["raw"][1]
    n = staging.table(spark, sf_small, "events").count()
    assert got["raw"] == (n, n)
    assert got["warehouse"][0] == n and 0 < got["warehouse"][1] < n


def test_watermark_drops_nothing_without_state(spark, sf_small):
    expected = ops.conform(jobs.sensor_flatten(spark, sf_small), SENSOR_TARGET)
    got = jobs.stream_watermark_passthrough(spark, sf_small)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def test_restart_gives_each_message_once(spark, scratch, sf_small):
    topic = scratch("topic")
    events = staging.table(spark, sf_small, "events")
    staging.kafka_frames(staging.sensor_envelope(events)).repartition(5).write.parquet(topic)
    run = scratch("restart")
    sink = IdempotentFileSink(f"{run}/t", keep=ops.valid_readings)

    def stream():
        return ops.parse_messages(sources.stream_topic_files(spark, topic, 1)).transform(ops.flatten_sensor)

    with pytest.raises(Exception, match="injected failure"):
        run_available(stream(), FailOnce(sink, after_batch=2), f"{run}/ck")
    written_before = read_batches(spark, f"{run}/t").count()
    assert 0 < written_before
    run_available(stream(), sink, f"{run}/ck")
    table = read_batches(spark, f"{run}/t")
    expected = events.filter(F.col("event_type") != "error").count()
    assert table.count() == expected
    assert table.select("message_id").distinct().count() == expected


def test_batch_log_is_written_with_each_batch(spark, scratch):
    from weir.streaming import BatchLog, read_batch_log

    path = scratch("log")
    assert read_batch_log(spark, path).count() == 0
    BatchLog(path).add(spark, 0, [("main", 10, 8, True)])
    BatchLog(path).add(spark, 1, [("main", 10, 0, False)])
    BatchLog(path).add(spark, 1, [("main", 10, 7, True)])    # replay of batch 1, after a crash
    rows = sorted(tuple(r) for r in read_batch_log(spark, path).collect())
    assert rows == [(0, "main", 10, 8, True), (1, "main", 10, 7, True)]


def test_an_empty_replay_leaves_nothing(spark, scratch):
    path = scratch("replay")
    sink = IdempotentFileSink(path)
    sink(spark.range(5).toDF("x"), 0)
    sink(spark.range(3).toDF("x"), 1)
    sink(spark.range(0).toDF("x"), 0)
    assert read_batches(spark, path).count() == 3


def test_a_stopped_interval_stream_has_logged_every_batch(spark, scratch, sf_small):
    from weir.plans import ingest
    from weir.streaming import read_batch_log

    run = scratch("interval")
    topic = staging.sensor_topic_capped(spark, sf_small, 300)
    query = ingest.sensor_stream_to_table(sources.stream_topic_files(spark, topic, 1), f"{run}/t", f"{run}/ck",
                                          log_path=f"{run}/log", trigger="100 milliseconds")
    query.processAllAvailable()
    query.stop()
    total = read_batch_log(spark, f"{run}/log").agg(F.sum("rows_in"), F.sum("rows_out")).first()
    assert total[0] == staging.table(spark, sf_small, "events").count()
    assert total[1] == read_batches(spark, f"{run}/t").count()


def test_missing_column_fails_before_the_start(spark, scratch, sf_small):
    stream = sources.stream_topic_files(spark, staging.sensor_topic(spark, sf_small))
    sink = IdempotentFileSink(scratch("t"), required=["sensor_id"])
    with pytest.raises(ops.MissingColumnsError):
        start_stream(stream, sink, scratch("ck"))
    assert not spark.streams.active


def test_console_debug_and_await_all(spark, scratch, sf_small, capsys):
    from weir.streaming import await_all, console_debug

    stream = ops.raw_message_view(sources.stream_topic_files(spark, staging.sensor_topic(spark, sf_small)))
    q = console_debug(stream, scratch("console"), trigger="availableNow")
    await_all(q)
    assert not q.isActive


def test_watermark_on_zone_less_time_is_refused(spark, scratch, sf_small):
    events = spark.readStream.schema(staging.table(spark, sf_small, "events").schema) \
        .parquet(f"{sf_small}/events.parquet")
    with pytest.raises(TypeError, match="cast it to timestamp"):
        start_stream(events, lambda df, i: None, scratch("ck"), watermark=("ts", "1 minute"))


def test_fanout_restart_is_exact(spark, scratch, sf_small):
    from weir.streaming import FanOutSink, read_batch_log

    run = scratch("fan_restart")
    raw = IdempotentFileSink(f"{run}/raw", fmt="json", name="raw")
    wh = IdempotentFileSink(f"{run}/wh", keep=ops.valid_readings, name="warehouse")
    fan = FanOutSink({"raw": (ops.raw_message_view, raw),
                      "warehouse": (lambda d: ops.parse_messages(d).transform(ops.flatten_sensor), wh)},
                     log_path=f"{run}/log")
    topic = staging.sensor_topic_capped(spark, sf_small, 1000)
    with pytest.raises(Exception, match="injected failure"):
        run_available(sources.stream_topic_files(spark, topic, 1), FailOnce(fan, after_batch=0), f"{run}/ck")
    run_available(sources.stream_topic_files(spark, topic, 1), fan, f"{run}/ck")
    events = staging.table(spark, sf_small, "events")
    valid = events.filter(F.col("event_type") != "error").count()
    assert read_batches(spark, f"{run}/raw", fmt="json").count() == events.count()
    assert read_batches(spark, f"{run}/wh").count() == valid
    totals = {r["branch"]: r["s"] for r in read_batch_log(spark, f"{run}/log")
              .groupBy("branch").agg(F.sum("rows_out").alias("s")).collect()}
    assert totals == {"raw": events.count(), "warehouse": valid}


def test_jdbc_sink_replay_replaces_its_batch(spark, scratch, sf_small):
    from weir.plans.jobs import DERBY_DRIVER, _derby_url
    from weir.sources import read_table
    from weir.streaming import JdbcBatchSink

    url = _derby_url(spark, "jdbc_restart")
    sink = JdbcBatchSink(url, "S", keep=ops.valid_readings, driver=DERBY_DRIVER,
                         extra={"createTableColumnTypes": "message_id VARCHAR(32), event_time VARCHAR(32), sensor_id VARCHAR(64)"})
    topic = staging.sensor_topic_capped(spark, sf_small, 1000)

    def stream():
        return ops.parse_messages(sources.stream_topic_files(spark, topic, 1)).transform(ops.flatten_sensor)

    ck = scratch("ck")
    with pytest.raises(Exception, match="injected failure"):
        run_available(stream(), FailOnce(sink, after_batch=0), ck)
    run_available(stream(), sink, ck)
    table = read_table(spark, url, "S", driver=DERBY_DRIVER)
    valid = staging.table(spark, sf_small, "events").filter(F.col("event_type") != "error").count()
    assert table.count() == valid
    assert table.select("message_id").distinct().count() == valid


def test_redelivered_messages_come_once(spark, sf_small):
    topic = sources.read_topic_files(spark, staging.sensor_topic_redelivered(spark, sf_small))
    n = staging.table(spark, sf_small, "events").count()
    per_key = {r["n"]: r["keys"] for r in topic.groupBy("key").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("keys")).collect()}
    assert set(per_key) == {1, 2, 3} and sum(per_key.values()) == n
    got = jobs.stream_redelivered(spark, sf_small)
    expected = ops.conform(jobs.sensor_flatten(spark, sf_small), SENSOR_TARGET)
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0


def _arrivals(spark, topic):
    """(first, last) second of each file, in the order a file stream reads them."""
    import os

    folder = topic.removeprefix("file:")
    files = sorted((f for f in os.listdir(folder) if f.endswith(".parquet")), key=lambda f: os.stat(f"{folder}/{f}").st_mtime_ns)
    assert len({int(os.stat(f"{folder}/{f}").st_mtime) for f in files}) == len(files)
    bounds = (F.min("timestamp").alias("low"), F.max("timestamp").alias("high"))
    return [tuple(spark.read.parquet(f"{folder}/{f}").agg(*[F.unix_seconds(c) for c in bounds]).first()) for f in files]


@pytest.mark.parametrize("times_kept", [True, False])
def test_the_redelivered_topic_is_written_by_a_few_jobs_in_order(spark, scratch, sf_small, monkeypatch, times_kept):
    """Jobs don't grow with the files; without kept times the files are written in turn.  Rows don't depend on either."""
    from weir import folders

    if not times_kept:
        monkeypatch.setattr(folders, "date_in_order", lambda spark, path: False)
    folder = scratch("sf")
    staging.table(spark, sf_small, "events").write.parquet(f"{folder}/events.parquet")
    n = 30
    monkeypatch.setattr(staging, "ROWS_PER_TOPIC_FILE", 2 * staging.table(spark, sf_small, "events").count() // n)
    group = scratch("jobs")
    spark.sparkContext.setJobGroup(group, "")
    try:
        topic = staging.sensor_topic_redelivered(spark, folder)
    finally:
        spark.sparkContext.setJobGroup("", "")
    found = _arrivals(spark, topic) if times_kept else None
    if times_kept:
        assert len(found) >= n - 2 and len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) < n / 2
        assert all(low >= before - 10 for (_, before), (low, _) in zip(found, found[1:]))
    rows = spark.read.parquet(topic)
    assert rows.exceptAll(spark.read.parquet(staging.sensor_topic_redelivered(spark, sf_small))).isEmpty()
    assert rows.count() == spark.read.parquet(staging.sensor_topic_redelivered(spark, sf_small)).count()


def test_batches_take_more_files_of_a_larger_topic(spark, scratch):
    folder = scratch("files")
    spark.range(0, 40, 1, 40).write.parquet(folder)
    assert [staging.files_per_batch(spark, folder, *n) for n in ((8, 32), (8, 3), (50, 32))] == [5, 3, 1]


def test_batches_with_state_are_bounded(spark, sf_small, monkeypatch):
    """However large the topic, a batch of the stream that keeps ids takes no more than so many files."""
    monkeypatch.setattr(jobs, "FILES_PER_STATEFUL_BATCH", 1)
    topic = staging.sensor_topic_redelivered(spark, sf_small)
    _, log = jobs._ingest(spark, topic, once=True, with_log=True)
    batches = jobs.read_batch_log(spark, log).where("rows_in > 0").count()
    assert batches >= len(spark.read.parquet(topic).inputFiles()) == 8


def test_redelivery_across_a_restart_and_state_behind_the_watermark(spark, scratch, sf_small):
    from weir.plans import ingest

    run = scratch("again")
    topic = staging.sensor_topic_redelivered(spark, sf_small)
    sink = ingest.sensor_table_sink(f"{run}/t")

    def stream():
        return ingest.flattened_sensor_stream(sources.stream_topic_files(spark, topic, 1), ("timestamp", "1 minute"), once=True)

    with pytest.raises(Exception, match="injected failure"):
        run_available(stream(), FailOnce(sink, after_batch=3), f"{run}/ck")
    query = run_available(stream(), sink, f"{run}/ck")
    ids = read_batches(spark, f"{run}/t", SENSOR_TARGET).select("message_id")
    valid = staging.table(spark, sf_small, "events").filter(F.col("event_type") != "error").count()
    assert ids.count() == valid == ids.distinct().count()
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert states and all(s["numRowsDroppedByWatermark"] == 0 for s in states)
    # ids that the watermark has passed are gone: far fewer are held than the stream has had
    assert states[-1]["numRowsTotal"] < staging.table(spark, sf_small, "events").count() / 4


def test_messages_without_an_id_are_no_copies(spark):
    rows = [(f"m{i}".encode() if i else None, v, "t", 0, i) for i, v in enumerate([b"nope", b"nope", b'{"id":"a"}', b'{"id":"a"}', b'{"id":"b"}', None])]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long").withColumn("timestamp", F.current_timestamp())
    parsed = ops.parse_messages(df, keep=("timestamp", *ops.PLACE))
    assert sorted(str(r[0]) for r in ops.drop_redelivered(parsed, "1 minute").select("data.id").collect()) == ["None", "None", "None", "a", "b"]


def test_a_failure_of_any_query_ends_the_wait(spark, scratch, sf_small):
    import time

    from weir.streaming import await_all

    rate = lambda: spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def broken(df, i):
        raise RuntimeError("second query broke")

    first = start_stream(rate(), lambda df, i: None, scratch("a"), trigger=None)
    second = start_stream(rate(), broken, scratch("b"), trigger=None)
    began = time.time()
    with pytest.raises(Exception, match="second query broke"):
        await_all(first, second)
    assert time.time() - began < 60 and not first.isActive and not second.isActive


def test_a_failed_query_starts_again_from_its_checkpoint(spark, scratch, sf_small):
    from weir.streaming import supervise

    topic = staging.sensor_topic_capped(spark, sf_small, 300)
    run = scratch("supervised")
    sinks = {n: IdempotentFileSink(f"{run}/{n}") for n in "ab"}
    once = FailOnce(sinks["b"], after_batch=1)

    def starter(name, fn):
        return lambda: start_stream(ops.raw_message_view(sources.stream_topic_files(spark, topic, 1)), fn, f"{run}/ck-{name}")

    queries = supervise(starter("a", sinks["a"]), starter("b", once), restarts=1)
    assert not any(q.isActive for q in queries) and not once.armed
    n = staging.table(spark, sf_small, "events").count()
    assert [read_batches(spark, f"{run}/{name}").select("offset").distinct().count() for name in "ab"] == [n, n]
    assert [read_batches(spark, f"{run}/{name}").count() for name in "ab"] == [n, n]
    again = FailOnce(sinks["b"], after_batch=0)
    with pytest.raises(Exception, match="injected failure"):
        supervise(lambda: start_stream(ops.raw_message_view(sources.stream_topic_files(spark, topic, 1)), again, scratch("ck")), restarts=0)
