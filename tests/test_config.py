"""Option builders and session helpers."""

from __future__ import annotations

from weir.session import case_sensitive_session, s3a_conf, scratch_root
from weir.sources.kafka import DEMO_MAX_OFFSETS_PER_TRIGGER, kafka_options


def test_s3a_conf():
    conf = s3a_conf("http://store:9000", "k", "s", attempts=1, establish_timeout_ms=5000, timeout_ms=10000)
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.attempts.maximum"] == "1"
    assert conf["spark.hadoop.fs.s3a.connection.timeout"] == "10000"


def test_kafka_options():
    opts = kafka_options("b:9092", "sensor_metrics")
    assert opts["startingOffsets"] == "earliest"
    assert "maxOffsetsPerTrigger" not in opts
    capped = kafka_options("b:9092", "t", max_offsets_per_trigger=DEMO_MAX_OFFSETS_PER_TRIGGER)
    assert capped["maxOffsetsPerTrigger"] == "1000"


def test_scratch_root_uses_session_setting(spark):
    root = scratch_root(spark)
    assert root == (spark.sparkContext.getCheckpointDir() or "").rstrip("/")


def test_case_sensitive_session_leaves_others_alone(spark):
    before = spark.conf.get("spark.sql.caseSensitive")
    own = case_sensitive_session(spark)
    assert own.createDataFrame([(1, 2)], "a int, A int").select("A").first()[0] == 2
    assert spark.conf.get("spark.sql.caseSensitive") == before


def test_resource_conf():
    from weir.session import resource_conf

    conf = resource_conf(executor_memory="4g", executor_cores=4, min_executors=4, max_executors=20)
    assert conf["spark.dynamicAllocation.enabled"] == "true"
    assert conf["spark.dynamicAllocation.maxExecutors"] == "20"
    assert conf["spark.executor.cores"] == "4"
    assert "spark.dynamicAllocation.enabled" not in resource_conf(driver_memory="2g")


def test_apply_hadoop_conf(spark):
    from weir.session import apply_hadoop_conf

    apply_hadoop_conf(spark, {"spark.hadoop.fs.s3a.connection.timeout": "10000"})
    assert spark.conf.get("fs.s3a.connection.timeout") == "10000"
    spark.conf.unset("fs.s3a.connection.timeout")


def test_kafka_min_partitions():
    assert kafka_options("b:9092", "t", min_partitions=64)["minPartitions"] == "64"


def test_shuffle_conf_scales_with_input():
    from weir.session import shuffle_conf

    assert shuffle_conf(10)["spark.sql.shuffle.partitions"] == "8"
    big = shuffle_conf(100 * 1024 ** 4)  # 100 TiB
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * 1024 * 8


def test_kafka_missing_package_is_explained(spark):
    import pytest

    from weir.sources.kafka import read_kafka_stream

    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_kafka_stream(spark, "localhost:1", "t")


class _Configured:
    """As much of a session as tells its settings."""

    def __init__(self, **conf):
        self.conf = {f"spark.{k.replace('_', '.')}": v for k, v in conf.items()}


def test_embedded_derby_is_refused_where_executors_have_their_own_jvm(spark, monkeypatch):
    import pytest

    from weir.plans import jobs

    monkeypatch.setattr(jobs, "fresh_path", lambda spark, name: f"/tmp/{name}")
    for master in ("local-cluster[3,4,10240]", "spark://host:7077", "yarn"):
        with pytest.raises(ValueError, match="spark.weir.jdbc.url"):
            jobs.jdbc_target(_Configured(master=master), "t")
        url, conn = jobs.jdbc_target(_Configured(master=master, weir_jdbc_url="jdbc:x://db", weir_jdbc_user="u"), "t")
        assert (url, conn) == ("jdbc:x://db", {"user": "u"})
    assert jobs.jdbc_target(spark, "t")[0] == "jdbc:derby:/tmp/t;create=true"
