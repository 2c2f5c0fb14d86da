"""Sinks: JDBC append and full refresh (embedded Derby), landings, sorted layout, Kafka records."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weir import folders, landings, sinks, sources
from weir.functions.json import decode_json
from weir.plans.jobs import DERBY_DRIVER, _derby_url
from weir.schemas import SENSOR_ENVELOPE
from weir.sinks.jdbc import table_exists
from weir.sources import current_landing


def test_jdbc_append_then_refresh(spark):
    url = _derby_url(spark, "derby_test")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    b = spark.createDataFrame([(3, "c")], "k long, v string")
    ddl = {"createTableColumnTypes": "v VARCHAR(10)"}
    sinks.append_table(a, url, "T1", driver=DERBY_DRIVER, extra=ddl)
    sinks.append_table(b, url, "T1", driver=DERBY_DRIVER, extra=ddl)
    back = sources.read_table(spark, url, "T1", partition_column="k", num_partitions=2, driver=DERBY_DRIVER)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    sinks.replace_table(b, url, "T1", driver=DERBY_DRIVER, extra=ddl)
    back = sources.read_table(spark, url, "T1", driver=DERBY_DRIVER)
    assert [tuple(r) for r in back.collect()] == [(3, "c")]


def test_jdbc_errors_raise(spark):
    bad = "jdbc:derby:/nonexistent/dir/db"  # no create=true: connection fails
    try:
        sinks.append_table(spark.range(1), bad, "T", driver=DERBY_DRIVER)
    except Exception:
        pass
    else:
        raise AssertionError("failed JDBC write was not raised")


def test_land_raw_replaces_and_skips_empty(spark, scratch):
    p = scratch("landing")
    first = spark.createDataFrame([("one\ntwo",)], "payload string")
    second = spark.createDataFrame([("three",), ("four",)], "payload string")
    assert sinks.land_raw(first, p)
    assert sinks.land_raw(second, p)
    landed = lambda: spark.read.schema("payload string").json(current_landing(spark, p))
    assert sorted(r[0] for r in landed().collect()) == ["four", "three"]
    assert not sinks.land_raw(second.limit(0), p)
    assert landed().count() == 2


def test_landing_survives_empty_payloads_and_failed_writes(spark, scratch):
    p = scratch("landing")
    sinks.land_raw(spark.createDataFrame([("kept",)], "payload string"), p)
    assert not sinks.land_raw(spark.createDataFrame([(None,), ("",)], "payload string"), p)
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.lit("x")).alias("payload"))
    try:
        sinks.land_raw(broken, p)
    except Exception:
        pass
    else:
        raise AssertionError("a failed landing was not raised")
    assert [r[0] for r in spark.read.schema("payload string").json(current_landing(spark, p)).collect()] == ["kept"]


def test_a_crash_at_any_step_leaves_the_old_landing_or_the_new_one(spark, scratch, monkeypatch):
    frame = lambda *texts: spark.createDataFrame([(t,) for t in texts], "payload string")
    read = lambda p: sorted(r[0] for r in spark.read.schema("payload string").json(current_landing(spark, p)).collect())
    for step in ("point", "write_small", "forget"):
        p = scratch("landing")
        for old in ("older", "old"):
            sinks.land_raw(frame(old), p)
        with monkeypatch.context() as m:
            where = folders if step == "write_small" else landings
            m.setattr(where, step, lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError, match="killed"):
                sinks.land_raw(frame("new", "new 2"), p)
        assert read(p) == (["new", "new 2"] if step == "forget" else ["old"])
        if step == "point":  # a pointer that was torn while it was written
            folders.write_small(spark, f"{p}/_pointers/{99:012d}", "landing-2-00")
            assert read(p) == ["old"]
        assert sinks.land_raw(frame("new", "new 2"), p)
        assert read(p) == ["new", "new 2"]


def test_equal_payloads_are_landed_once(spark, scratch):
    p = scratch("landing")
    frame = lambda *texts: spark.createDataFrame([(t,) for t in texts], "payload string").repartition(3)
    assert sinks.land_raw(frame("a", "b", "b"), p)
    before = sorted(f for f, _, _ in folders.statuses(spark, p))
    assert sinks.land_raw(frame("b", "a", "b"), p)
    assert sorted(f for f, _, _ in folders.statuses(spark, p)) == before
    assert sinks.land_raw(frame("a", "b"), p) and sinks.land_raw(frame("a"), p)
    assert len([n for n in folders.names(spark, p) if n.startswith("landing-")]) == 2  # the current and the one before


def test_table_exists_tells_missing_from_broken(spark):
    url = _derby_url(spark, "exists")
    sinks.append_table(spark.range(2), url, "SOME_T", driver=DERBY_DRIVER)
    assert table_exists(spark, url, "SOME_T", driver=DERBY_DRIVER)
    assert table_exists(spark, url, "some_t", driver=DERBY_DRIVER)
    assert not table_exists(spark, url, "SOMEXT", driver=DERBY_DRIVER)
    assert not table_exists(spark, url, "NOWHERE.SOME_T", driver=DERBY_DRIVER)
    with pytest.raises(Exception, match="not found|No suitable|refused|Database"):
        table_exists(spark, url.replace(";create=true", "_gone"), "SOME_T", driver=DERBY_DRIVER)


def test_failed_refresh_keeps_the_old_rows(spark):
    url = _derby_url(spark, "derby_half")
    sinks.replace_table(spark.range(5).toDF("k"), url, "H", driver=DERBY_DRIVER)
    broken = spark.range(100, 104).select(F.when(F.col("id") == 103, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("k"))
    try:
        sinks.replace_table(broken, url, "H", driver=DERBY_DRIVER)
    except Exception:
        pass
    else:
        raise AssertionError("a failed refresh was not raised")
    assert sorted(r[0] for r in sources.read_table(spark, url, "H", driver=DERBY_DRIVER).collect()) == [0, 1, 2, 3, 4]


def test_sorted_layout_files_do_not_overlap(spark, scratch):
    p = scratch("sorted")
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("t"), (F.col("id") % 13).alias("s"))
    sinks.write_sorted(df, p, ["t", "s"], num_files=4)
    ranges = (spark.read.parquet(p).groupBy(F.input_file_name().alias("f"))
              .agg(F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("lo").collect())
    assert len(ranges) > 1
    for prev, nxt in zip(ranges, ranges[1:]):
        assert prev["hi"] <= nxt["lo"]
    # Within a file rows are in key order.
    first = spark.read.parquet(ranges[0]["f"]).collect()
    assert [tuple(r) for r in first] == sorted(tuple(r) for r in first)


def test_sorted_layout_splits_a_hot_key(spark, scratch):
    p = scratch("sorted_hot")
    # A third of the rows share one key value.
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("t"),
                                  F.col("id").alias("v"))
    sinks.write_sorted(df, p, ["t"], num_files=6)
    per_file = (spark.read.parquet(p).filter(F.col("t") == 7)
                .groupBy(F.input_file_name()).count().collect())
    assert len(per_file) > 1
    assert spark.read.parquet(p).count() == 9000


def test_kafka_records(spark):
    df = spark.createDataFrame([("1", "2025-01-01T00:00:00", ("s", None, 1, 2))],
                               "id string, timestamp string, value struct<sensor_id string, temperature double, humidity int, pressure int>")
    rec = sinks.to_kafka_records(df, key="id")
    assert rec.columns == ["key", "value"]
    text = rec.select(F.col("value").cast("string")).first()[0]
    assert text == '{"id":"1","timestamp":"2025-01-01T00:00:00","value":{"sensor_id":"s","humidity":1,"pressure":2}}'
    back = rec.select(decode_json("value", SENSOR_ENVELOPE).alias("m")).first()["m"]
    assert back["value"]["temperature"] is None and back["value"]["pressure"] == 2


def test_kafka_sink_options():
    opts = sinks.kafka_sink_options(["a:1", "b:2"], "topic")
    assert opts["kafka.bootstrap.servers"] == "a:1,b:2"
    assert opts["kafka.acks"] == "all" and opts["kafka.retries"] == "3"


def test_jdbc_read_with_predicates(spark):
    url = _derby_url(spark, "derby_pred")
    df = spark.createDataFrame([(i, "x" if i < 90 else "y") for i in range(100)], "k long, v string")
    sinks.append_table(df, url, "P", driver=DERBY_DRIVER, extra={"createTableColumnTypes": "v VARCHAR(4)"})
    back = sources.read_table(spark, url, "P", driver=DERBY_DRIVER,
                              predicates=['"k" < 45', '"k" >= 45 AND "k" < 90', '"k" >= 90'])
    assert back.count() == 100 and back.select("k").distinct().count() == 100
    assert back.select(F.spark_partition_id()).distinct().count() == 3
