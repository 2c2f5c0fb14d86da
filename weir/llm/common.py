"""What the operators of this package share: tables, written intermediates, small expressions."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.folders import remove
from weir.session import fresh_path

#: Rows of an Arrow batch: texts are long, and a task holds a batch of them several times over.
BATCH_ROWS = 1000
#: Bytes of an Arrow batch, give or take a row: rows alone are no bound.
BATCH_BYTES = 1 << 20

#: White space between words, as a regular expression class (fixed by the contracts).
WHITE = r"[\x20\x09-\x0D]"
NOT_WHITE = r"[^\x20\x09-\x0D]"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed, and bound what they hold.

    Workers get the package root on their path; on a cluster the package is
    installed, or shipped with ``--py-files``, as usual.  Spark's default for
    Arrow batches (rows, bytes) is lowered, any other setting of it stays.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` as a written table in the shared scratch folder: cuts the lineage.

    A lost executor costs the tasks it ran, never what was already written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path, **options)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing will read again."""
    for t in tables:
        remove(t.sparkSession, t.written_at)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often body uses it.

    The optimizer copies a projected expression into each of its uses; a lambda
    variable is not copied.
    """
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text (null: none), as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WHITE + "+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(NOT_WHITE + "+")).cast("long")


def id_text(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def scored(docs: DataFrame, keep: list[str], run: Callable, outputs: str) -> DataFrame:
    """``run`` over Arrow batches of texts, with the columns ``keep`` carried along as k0, k1, ...

    ``run`` gets batches with ``text`` and the carried columns and returns the
    carried ones and ``outputs``.  The short names can't clash with a column of
    the input, whatever it is called.
    """
    carried = docs.select("text", *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    kinds = [f"k{i} {f.dataType.simpleString()}" for i, f in enumerate(carried.schema.fields[1:])]
    return carried.mapInArrow(run, ", ".join([*kinds, outputs]))


def carried_columns(batch) -> tuple[list, list[str]]:
    names = [c for c in batch.schema.names if c != "text"]
    return [batch.column(c) for c in names], names


def as_named(keep: list[str]) -> list[Column]:
    return [F.col(f"k{i}").alias(c) for i, c in enumerate(keep)]
