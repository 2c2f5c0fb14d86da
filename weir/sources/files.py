"""File sources: nested JSON documents, JSON record arrays, CSV, Parquet,
integer ranges and object listings."""

from __future__ import annotations

import fnmatch
import itertools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import folders, landings
from weir.session import fresh_path
from weir.sources.split import csv_records, json_elements


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Multi-line JSON files with an explicit schema.

    A file holding one object gives one row; a file holding an array gives
    one row per element.  Each file is read whole by one task, so many
    moderate files parallelise and one huge file does not.
    """
    df = spark.read.schema(schema).json(path, multiLine=True)
    # Directory partitions (k=v/) are appended to the scan; keep the
    # declared columns only.
    return df.select(*schema.fieldNames())


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold JSON arrays, of any size: each is read by many tasks (see :mod:`weir.sources.split`).

    One row per element; a file that holds one object gives one row.  An element
    that can't be read is a row of nulls, the others are not touched by it.
    """
    parsed = json_elements(spark, path).select(F.from_json("value", schema).alias("row"))
    return parsed.select("row.*").select(*schema.fieldNames())


def read_csv_records(spark: SparkSession, path: str, *, header: bool = False, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with line ends inside quotes, in files of any size: like :func:`read_csv` with ``multi_line``, but each is read by many tasks.

    With ``header`` the first record of each file names the columns (those of
    one file hold for all) and is no row.
    """
    if schema is None:  # looks at the first record of one file
        names = read_csv(spark, path, header=header, multi_line=True).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    records = csv_records(spark, path)
    if header:
        records = records.where("NOT first")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.select(F.from_csv("value", F.lit(ddl), {"escape": '"'}).alias("row")).select("row.*")


def current_landing(spark: SparkSession, path: str) -> str:
    """The folder of the landing at ``path`` that counts (see ``sinks.land_raw``)."""
    return landings.current(spark, path)


def read_landed_documents(spark: SparkSession, path: str, schema: T.StructType,
                          payload_col: str = "payload") -> DataFrame:
    """Documents landed as JSON-lines payloads (see ``sinks.land_raw``) -> declared columns.

    Each line holds one document as text, so the landing splits across tasks
    however many documents it holds; each payload is parsed once.  A payload
    that is an array gives one row per element, one that can't be read a row of nulls.
    """
    landed = spark.read.schema(T.StructType([T.StructField(payload_col, T.StringType())])).json(current_landing(spark, path))
    # an array gives one row per element; an object is read as an array of one
    parsed = landed.select(F.inline_outer(F.from_json(F.col(payload_col), T.ArrayType(schema))))
    return parsed.select(*schema.fieldNames())


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines (one object per line, splittable) with an explicit schema."""
    return spark.read.schema(schema).json(path).select(*schema.fieldNames())


def read_csv(spark: SparkSession, path: str, *, header: bool = False,
             schema: T.StructType | str | None = None, infer_schema: bool = False,
             multi_line: bool = False) -> DataFrame:
    """CSV with RFC-4180 quoting (a quote inside a field is doubled).

    An empty field reads as NULL whether it was written from NULL or from an
    empty string; CSV has no way to tell them apart.

    Without a header the columns are ``_c0, _c1, ...`` and a header line in
    the file is read as data.  With ``multi_line`` a file is not split, so
    each file is read by one task.  Without a schema every column is a string;
    ``infer_schema`` costs an extra pass over the data, so prefer a schema.
    """
    reader = spark.read.option("header", header).option("escape", '"')
    if multi_line:
        reader = reader.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files whose column sets differ, read as one table.

    Columns absent from a file are NULL for its rows.  Merging is a per-read
    option, so other reads keep the cheaper single-footer schema.
    """
    return spark.read.option("mergeSchema", True).parquet(*paths)


def integer_range(spark: SparkSession, end: int, start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """``id`` from ``start`` to ``end - 1``, generated on the executors."""
    return spark.range(start, end, 1, num_partitions)


LISTING_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modificationTime", T.TimestampType()),
])


#: Objects listed before they are written out; the driver never holds more.
LISTING_PAGE = 10_000


def list_objects(spark: SparkSession, prefix: str, pattern: str | None = None) -> DataFrame:
    """Every object whose name starts with ``prefix``: ``(path, key, length, modificationTime)``.

    ``prefix`` is a folder, the beginning of names in a folder, a single object
    or a glob.  Keys are relative to the folder that the prefix names, or that
    its last part lies in.  Hidden names and empty objects are listed like any
    other; ``pattern`` is a glob on the last part of a name.  Pages of the
    listing go to the scratch area as they come, so the driver holds one page.
    A prefix with no objects, or one that does not exist, gives an empty frame.
    """
    if any(c in prefix for c in "*?[{"):
        base, start = prefix[:re.search(r"[*?\[{]", prefix).start()].rpartition("/")[0], prefix
    elif prefix.endswith("/") or folders.is_folder(spark, prefix):
        base = start = prefix.rstrip("/")
    else:
        base, start = prefix.rpartition("/")[0], prefix + "*"
    root = folders.qualified(spark, base).rstrip("/") + "/"
    schema = "path string, key string, length long, modified long"
    target = fresh_path(spark, "listing")
    found = folders.statuses(spark, start)
    pages = 0
    while page := list(itertools.islice(found, LISTING_PAGE)):
        rows = [(path, path.removeprefix(root), length, at) for path, length, at in page
                if not pattern or fnmatch.fnmatchcase(path.rpartition("/")[2], pattern)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(target)
        pages += 1
    if not pages:
        return spark.createDataFrame([], LISTING_SCHEMA)
    return spark.read.schema(schema).parquet(target).select(
        "path", "key", "length", F.timestamp_millis("modified").alias("modificationTime"))
