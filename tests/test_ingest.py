"""End-to-end ingestion entry points on embedded Derby and the scratch area."""

from __future__ import annotations

from pyspark.sql import functions as F

from weir import sources
from weir.plans import ingest, staging
from weir.plans.jobs import DERBY_DRIVER, _derby_url
from weir.schemas import WEATHER_DOCUMENT_TYPED_TIME


def test_weather_to_jdbc(spark, sf_small):
    url = _derby_url(spark, "weather")
    docs = staging.weather_documents(spark, sf_small)
    flat = ingest.weather_to_jdbc(spark, docs, url, "WEATHER", driver=DERBY_DRIVER,
                                  extra={"createTableColumnTypes": "timezone VARCHAR(32), format_time VARCHAR(16)"})
    core = ingest.weather_to_jdbc(spark, docs, url, "WEATHER_CORE", schema=WEATHER_DOCUMENT_TYPED_TIME,
                                  core_only=True, driver=DERBY_DRIVER)
    back = sources.read_table(spark, url, "WEATHER", driver=DERBY_DRIVER)
    assert back.count() == flat.count() == staging.table(spark, sf_small, "events").count()
    assert sources.read_table(spark, url, "WEATHER_CORE", driver=DERBY_DRIVER).columns == core.columns


def test_refresh_records_full_refresh(spark, scratch, sf_small):
    url = _derby_url(spark, "records")
    records = staging.record_documents(spark, sf_small)
    n = staging.table(spark, sf_small, "documents").count()
    for _ in range(2):  # the second run replaces, never appends
        report = ingest.refresh_records(spark, records, scratch("csv"), url, "RECORDS", driver=DERBY_DRIVER)
        assert tuple(report.first()) == (n, 4, 0)
    back = sources.read_table(spark, url, "RECORDS", driver=DERBY_DRIVER)
    assert back.columns == ["user_id", "id", "title", "body"]
    assert back.count() == n


def test_sensor_stream_to_jdbc(spark, scratch, sf_small):
    url = _derby_url(spark, "sensor")
    messages = sources.stream_topic_files(spark, staging.sensor_topic_capped(spark, sf_small, 1000), 1)
    q = ingest.sensor_stream_to_jdbc(messages, url, "SENSOR", scratch("ck"), trigger="availableNow",
                                     driver=DERBY_DRIVER,
                                     extra={"createTableColumnTypes": "message_id VARCHAR(24), sensor_id VARCHAR(24)"})
    q.awaitTermination()
    back = sources.read_table(spark, url, "SENSOR", driver=DERBY_DRIVER)
    events = staging.table(spark, sf_small, "events")
    assert back.count() == events.filter(F.col("event_type") != "error").count()
    assert "batch_id" in back.columns


def test_sensor_stream_to_table_resumes(spark, scratch, sf_small):
    topic = staging.sensor_topic_capped(spark, sf_small, 1000)
    table, ck = scratch("table"), scratch("ck")
    ingest.sensor_stream_to_table(sources.stream_topic_files(spark, topic, 1), table, ck).awaitTermination()
    first = spark.read.parquet(table).count()
    # Nothing new arrived: a second run from the checkpoint adds nothing.
    ingest.sensor_stream_to_table(sources.stream_topic_files(spark, topic, 1), table, ck).awaitTermination()
    assert spark.read.parquet(table).count() == first > 0
