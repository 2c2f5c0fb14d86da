"""Progress of streaming queries, trigger by trigger, as a table.

Spark reports each trigger's offsets, rates, watermark and the source's lag to
listeners and then forgets them.  The log keeps them as one small file per batch,
named by query and batch: a batch that is run again after a restart replaces
its entry.  Entries hold numbers about a batch, never its rows.
"""

from __future__ import annotations

import json
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener

from weir.folders import exists, write_small

SOURCE_SCHEMA = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("start_offset", T.StringType()),
    T.StructField("end_offset", T.StringType()),
    T.StructField("latest_offset", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.StringType())),
])
PROGRESS_SCHEMA = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("started", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("input_rate", T.DoubleType()),
    T.StructField("process_rate", T.DoubleType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("watermark", T.StringType()),
    T.StructField("state_rows", T.LongType()),
    T.StructField("late_rows", T.LongType()),
    T.StructField("sources", T.ArrayType(SOURCE_SCHEMA)),
])


def _rate(value: float | None) -> float | None:
    """A rate as JSON can hold it: none for a trigger without duration."""
    return value if value is not None and abs(value) < float("inf") else None


def _entry(p) -> dict:
    return {
        "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "started": p.timestamp,
        "rows": p.numInputRows, "input_rate": _rate(p.inputRowsPerSecond), "process_rate": _rate(p.processedRowsPerSecond),
        "duration_ms": p.durationMs.get("triggerExecution"), "watermark": p.eventTime.get("watermark"),
        "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
        "late_rows": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        "sources": [{"description": s.description, "start_offset": s.startOffset, "end_offset": s.endOffset,
                     "latest_offset": s.latestOffset, "rows": s.numInputRows, "metrics": dict(s.metrics)} for s in p.sources],
    }


class ProgressLog(StreamingQueryListener):
    """Writes the progress of queries to ``path`` while the ``with`` block runs.

    ``names``: only queries of these names (all of the session, without it).  At
    its end the block waits for what was reported of the queries that have
    ended, so a table read after it is whole; :attr:`failures` holds the errors of
    queries that failed.  If the driver is lost between a batch's commit and its
    report, that batch has no entry: row counts that must survive are the batch
    log's, which is written with the batch.
    """

    def __init__(self, spark: SparkSession, path: str, names: set[str] | None = None):
        self.spark, self.path, self.names = spark, path.rstrip("/"), names
        self.failures: list[str] = []
        self._open: dict[str, threading.Event] = {}
        self._errors: list[Exception] = []

    def _wanted(self, name: str | None) -> bool:
        return self.names is None or name in self.names

    def onQueryStarted(self, event) -> None:  # called before start() returns
        if self._wanted(event.name):
            self._open[str(event.runId)] = threading.Event()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not self._wanted(p.name):
            return
        target = f"{self.path}/{p.id}/{p.batchId}.json"
        try:
            # a trigger without data may report the number of a batch that ran
            if p.numInputRows or not exists(self.spark, target):
                write_small(self.spark, target, json.dumps(_entry(p)) + "\n", overwrite=True)
        except Exception as exc:  # the bus would only print it; the block raises it
            self._errors.append(exc)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        if run in self._open:
            if event.exception:
                self.failures.append(event.exception)
            self._open[run].set()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, kind, exc, trace) -> None:
        running = {str(q.runId) for q in self.spark.streams.active}
        late = [run for run, done in list(self._open.items()) if run not in running and not done.wait(60)]
        self.spark.streams.removeListener(self)
        if kind is None and self._errors:
            raise self._errors[0]
        if kind is None and late:
            raise TimeoutError(f"no end was reported for the runs {late}")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query and batch; empty if nothing was reported."""
    try:
        return spark.read.schema(PROGRESS_SCHEMA).option("recursiveFileLookup", True).json(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return spark.createDataFrame([], PROGRESS_SCHEMA)


def _offsets(text: Column) -> Column:
    """Kafka's offsets ``{topic: {partition: offset}}`` as one number: their sum."""
    parsed = F.from_json(text, "map<string, map<string, bigint>>")
    add = lambda a, b: a + b
    return F.aggregate(F.map_values(parsed), F.lit(0).cast("long"),
                       lambda a, topic: a + F.aggregate(F.map_values(topic), F.lit(0).cast("long"), add))


def topic_lag(progress: DataFrame) -> DataFrame:
    """``(query_id, batch_id, source, behind)``: messages of a Kafka source that were there, but not read, at the end of a batch.

    Null for other sources, whose offsets are not counts of messages.
    """
    each = progress.select("query_id", "batch_id", F.explode("sources").alias("s"))
    return each.select("query_id", "batch_id", F.col("s.description").alias("source"),
                       (_offsets(F.col("s.latest_offset")) - _offsets(F.col("s.end_offset"))).alias("behind"))
