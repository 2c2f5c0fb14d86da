"""Session construction, object-store settings and the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every weir job relies on: UTC so that formatted times do not depend
# on the host, AQE so shuffle sizes are re-planned at run time.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def s3a_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    *,
    path_style: bool = True,
    ssl: bool = False,
    attempts: int | None = None,
    establish_timeout_ms: int | None = None,
    timeout_ms: int | None = None,
) -> dict[str, str]:
    """Hadoop ``s3a`` settings for an S3-compatible store, as session conf.

    Paths stay arguments of readers and writers, so the same job runs on
    ``s3a://`` in production and ``file:`` locally.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider":
            "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
    }
    if attempts is not None:
        conf["spark.hadoop.fs.s3a.attempts.maximum"] = str(attempts)
    if establish_timeout_ms is not None:
        conf["spark.hadoop.fs.s3a.connection.establish.timeout"] = str(establish_timeout_ms)
    if timeout_ms is not None:
        conf["spark.hadoop.fs.s3a.connection.timeout"] = str(timeout_ms)
    return conf


def apply_hadoop_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Apply ``spark.hadoop.*`` settings (e.g. :func:`s3a_conf`) to a running session.

    Session settings are copied into the Hadoop configuration of every file
    scan and write, so the keys are set without the ``spark.hadoop.`` prefix.
    """
    for key, value in conf.items():
        spark.conf.set(key.removeprefix("spark.hadoop."), value)


def resource_conf(
    *,
    driver_memory: str | None = None,
    executor_memory: str | None = None,
    executor_cores: int | None = None,
    min_executors: int | None = None,
    max_executors: int | None = None,
    max_result_size: str | None = None,
) -> dict[str, str]:
    """Deployment sizing as session conf; dynamic allocation when bounds are given.

    Dynamic allocation tracks shuffle files so executors can be released
    without an external shuffle service.
    """
    conf: dict[str, str] = {}
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    if executor_memory:
        conf["spark.executor.memory"] = executor_memory
    if executor_cores:
        conf["spark.executor.cores"] = str(executor_cores)
    if max_result_size:
        conf["spark.driver.maxResultSize"] = max_result_size
    if min_executors is not None or max_executors is not None:
        conf["spark.dynamicAllocation.enabled"] = "true"
        conf["spark.dynamicAllocation.shuffleTracking.enabled"] = "true"
        if min_executors is not None:
            conf["spark.dynamicAllocation.minExecutors"] = str(min_executors)
        if max_executors is not None:
            conf["spark.dynamicAllocation.maxExecutors"] = str(max_executors)
    return conf


def shuffle_conf(input_bytes: int, target_partition_bytes: int = 128 * 1024 * 1024) -> dict[str, str]:
    """Shuffle sizing for a job reading about ``input_bytes``.

    AQE merges small shuffle partitions but never splits a large one outside
    joins, so the starting count must cover the data: one partition per
    ``target_partition_bytes`` (at least 8).  Range repartitions without an
    explicit count (the sorted layout) start from this number too.
    """
    n = max(8, -(-int(input_bytes) // int(target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(int(target_partition_bytes)),
    }


def build_session(
    app_name: str = "weir",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed.

    Workers get the package root on their path; on a cluster the package is
    installed, or shipped with ``--py-files``, as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged inputs and lineage cuts.

    On a cluster this is ``spark.checkpoint.dir`` (a shared file system the
    cluster names), read from the session.  Only when nothing is configured,
    as in local tests, a fresh local folder is created and registered as the
    checkpoint dir.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="weir-checkpoint-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def in_one_process(spark: SparkSession) -> bool:
    """Whether tasks run in the driver's JVM; the executors of ``local-cluster`` have JVMs of their own."""
    return is_local(spark) and not spark.conf.get("spark.master").startswith("local-cluster")


_RUN_ID = uuid.uuid4().hex[:12]


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under this process's area of :func:`scratch_root`."""
    return "/".join([scratch_root(spark), "weir", _RUN_ID, *parts])


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used path under the scratch area."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


def case_sensitive_session(spark: SparkSession, enabled: bool = True) -> SparkSession:
    """A session of its own on the same cluster that resolves column names case-sensitively.

    Queries of the session it comes from are not touched.  File readers consult
    the setting when they run, so what reads such a source belongs to this
    session until it is written out.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.caseSensitive", str(enabled).lower())
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own
