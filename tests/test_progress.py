"""Progress of streams: an entry per batch over restarts, watermark and state, lag of Kafka offsets."""

from __future__ import annotations

import json
import uuid

import pytest
from pyspark.errors import StreamingQueryException

from weir import sources
from weir.plans import ingest, staging
from weir.streaming import FailOnce, ProgressLog, read_batch_log, read_progress, run_available, topic_lag
from weir.streaming.progress import PROGRESS_SCHEMA


def _run(spark, topic, run, name, once=False, fail=None):
    messages = sources.stream_topic_files(spark, topic, max_files_per_trigger=1)
    sink = ingest.sensor_table_sink(f"{run}/table", f"{run}/log")
    flat = ingest.flattened_sensor_stream(messages, ingest.SENSOR_WATERMARK if once else None, once)
    return run_available(flat, FailOnce(sink, fail) if fail is not None else sink, f"{run}/checkpoint", query_name=name)


def test_entries_equal_the_batch_log_after_a_restart(spark, scratch, sf_small):
    topic, run, name = staging.sensor_topic(spark, sf_small), scratch("run"), f"q{uuid.uuid4().hex}"
    with ProgressLog(spark, f"{run}/progress", {name}) as log:
        with pytest.raises(StreamingQueryException):
            _run(spark, topic, run, name, fail=1)
        _run(spark, topic, run, name)
    assert len(log.failures) == 1
    entries = read_progress(spark, f"{run}/progress").where("rows > 0").collect()
    counted = {r["batch_id"]: r["rows_in"] for r in read_batch_log(spark, f"{run}/log").collect()}
    assert {r["batch_id"]: r["rows"] for r in entries} == counted and len(entries) == len(counted) > 2
    # one query, two runs; what a batch ended with the next one starts from
    assert len({r["query_id"] for r in entries}) == 1 and len({r["run_id"] for r in entries}) == 2
    ordered = sorted(entries, key=lambda r: r["batch_id"])
    for a, b in zip(ordered, ordered[1:], strict=False):
        assert json.loads(a["sources"][0]["end_offset"]) == json.loads(b["sources"][0]["start_offset"])
    assert all(r["duration_ms"] > 0 for r in entries)


def test_watermark_and_state_are_reported(spark, scratch, sf_small):
    topic, run, name = staging.sensor_topic_redelivered(spark, sf_small), scratch("run"), f"q{uuid.uuid4().hex}"
    with ProgressLog(spark, f"{run}/progress", {name}):
        _run(spark, topic, run, name, once=True)
    entries = sorted(read_progress(spark, f"{run}/progress").collect(), key=lambda r: r["batch_id"])
    marks = [r["watermark"] for r in entries]
    assert marks == sorted(marks) and marks[0] < marks[-1]
    assert max(r["state_rows"] for r in entries) > 0 and sum(r["late_rows"] for r in entries) == 0


def test_other_queries_are_not_logged(spark, scratch, sf_small):
    topic, run = staging.sensor_topic(spark, sf_small), scratch("run")
    with ProgressLog(spark, f"{run}/progress", {"another"}):
        _run(spark, topic, run, f"q{uuid.uuid4().hex}")
    assert read_progress(spark, f"{run}/progress").count() == 0


def test_lag_of_kafka_offsets(spark):
    def entry(batch, end, latest):
        return {"query_id": "q", "batch_id": batch, "sources": [
            {"description": "KafkaV2[Subscribe[t]]", "end_offset": end, "latest_offset": latest}]}

    lines = [entry(0, '{"t":{"0":5,"1":2}}', '{"t":{"0":9,"1":2}}'), entry(1, '{"t":{"0":9,"1":2}}', '{"t":{"0":9,"1":2}}'),
             entry(2, '{"logOffset":3}', None)]
    rows = [tuple(line.get(f) if f != "sources" else [tuple(s.get(n) for n in ("description", "start_offset", "end_offset", "latest_offset", "rows", "metrics"))
            for s in line["sources"]] for f in PROGRESS_SCHEMA.fieldNames()) for line in lines]
    found = topic_lag(spark.createDataFrame(rows, PROGRESS_SCHEMA)).collect()
    assert {r["batch_id"]: r["behind"] for r in found} == {0: 4, 1: 0, 2: None}
