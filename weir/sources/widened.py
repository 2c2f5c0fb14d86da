"""Parquet files whose columns differ in type, read as one table.

Spark's own schema merge takes missing columns, but refuses a column that is an
integer in one file and a double in another.  Here the footers of all files are read
in tasks, the files are grouped by schema, and a column's type is the
smallest that holds every type found for it.  Each group is read with its own
schema, so the scan needs no conversion, and cast above the scan, where Spark still pushes
comparisons below the cast.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir.session import fresh_path, share_package

_ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_FOOTER = "path string, schema string"


class SchemaConflict(TypeError):
    """No type holds all types found for a column."""


def _footer_schema(path: str) -> str:
    """Schema of one file as Spark writes it in JSON; reads the footer only."""
    import pyarrow.fs as pafs
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_schema

    scheme, _, rest = path.partition(":")
    # pyarrow knows S3 by its own name; "file:/x" and "file:///x" are one place
    uri = f"file://{'/' + rest.lstrip('/')}" if scheme == "file" else path.replace("s3a:", "s3:", 1)
    fs, name = pafs.FileSystem.from_uri(uri)
    with fs.open_input_file(name) as file:
        footer = pq.ParquetFile(file)
        own = (footer.metadata.metadata or {}).get(_ROW_METADATA)
        return own.decode() if own else from_arrow_schema(footer.schema_arrow).json()


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "schema": [_footer_schema(p) for p in batch["path"]]})


def file_schemas(spark: SparkSession, *paths: str) -> DataFrame:
    """``(path, schema)`` of every Parquet file at or below ``paths``; footers are read in tasks, once."""
    share_package(spark)
    # path and length come from the listing: no content is read
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(list(paths)).select("path"))
    spread = found.repartition(spark.sparkContext.defaultParallelism)
    written = fresh_path(spark, "footers")
    spread.mapInPandas(_read_footers, _FOOTER).write.parquet(written)
    return spark.read.schema(_FOOTER).parquet(written)


def _decimal(whole: int, scale: int, column: str) -> T.DecimalType:
    if whole + scale > 38:
        raise SchemaConflict(f"column {column!r}: no decimal has {whole} digits before and {scale} after the point")
    return T.DecimalType(whole + scale, scale)


def wider(a: T.DataType, b: T.DataType, column: str = "", text: bool = False, fold: bool = True) -> T.DataType:
    """The smallest type that holds ``a`` and ``b``.

    Integers and decimals widen exactly; with a float or double beside another number
    the result is double (a long beyond 2^53 is rounded).  Dates widen to
    timestamps.  Structs, arrays and maps widen part by part, a struct has the fields
    of both.  With ``text`` other pairs of plain types become text; without it they
    raise :class:`SchemaConflict`.  ``fold``: field names that differ only in case are one.
    """
    again = functools.partial(wider, text=text, fold=fold)
    if type(a) is type(b):
        if isinstance(a, T.StructType):
            return _merged(a, b, column, again, fold)
        if isinstance(a, T.ArrayType):
            return T.ArrayType(again(a.elementType, b.elementType, f"{column}[]"))
        if isinstance(a, T.MapType):
            return T.MapType(again(a.keyType, b.keyType, f"{column}.key"), again(a.valueType, b.valueType, f"{column}.value"))
        if isinstance(a, T.DecimalType):
            return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale), column)
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
            return max(a, b, key=lambda t: _DIGITS[type(t)])
        for x, y in ((a, b), (b, a)):
            if isinstance(x, T.DecimalType) and isinstance(y, _INTEGERS):
                return _decimal(max(x.precision - x.scale, _DIGITS[type(y)]), x.scale, column)
        return T.DoubleType()
    times = {type(a), type(b)}
    if T.DateType in times and times & {T.TimestampType, T.TimestampNTZType}:
        return b if isinstance(a, T.DateType) else a
    nested = (T.StructType, T.ArrayType, T.MapType, T.BinaryType, T.VariantType)
    if text and not isinstance(a, nested) and not isinstance(b, nested):
        return T.StringType()
    raise SchemaConflict(f"column {column!r} is {a.simpleString()} in one file and {b.simpleString()} in another")


def _merged(a: T.StructType, b: T.StructType, column: str, again, fold: bool) -> T.StructType:
    key = (lambda n: n.lower()) if fold else (lambda n: n)
    other = {key(f.name): f for f in b.fields}
    place = f"{column}." if column else ""
    fields = []
    for f in a.fields:
        found = other.pop(key(f.name), None)
        fields.append(T.StructField(f.name, again(f.dataType, found.dataType, place + f.name) if found else f.dataType))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in b.fields if key(f.name) in other])


def _as(col: Column, own: T.DataType, wide: T.DataType, fold: bool) -> Column:
    """``col``, of type ``own``, as ``wide``."""
    if own == wide:
        return col
    if isinstance(wide, T.StructType):
        return F.when(col.isNotNull(), F.struct(*_fields(lambda n: col.getField(n), own, wide, fold)))
    if isinstance(wide, T.ArrayType):
        return F.transform(col, lambda x: _as(x, own.elementType, wide.elementType, fold))
    if isinstance(wide, T.MapType):
        values = F.transform_values(col, lambda k, v: _as(v, own.valueType, wide.valueType, fold))
        return F.transform_keys(values, lambda k, v: _as(k, own.keyType, wide.keyType, fold))
    return col.cast(wide)


def _fields(get, own: T.StructType, wide: T.StructType, fold: bool) -> list[Column]:
    key = (lambda n: n.lower()) if fold else (lambda n: n)
    there = {key(f.name): f for f in own.fields}
    out = []
    for f in wide.fields:
        found = there.get(key(f.name))
        col = _as(get(found.name), found.dataType, f.dataType, fold) if found else F.lit(None).cast(f.dataType)
        out.append(col.alias(f.name))
    return out


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_parquet_widened(spark: SparkSession, *paths: str, text: bool = False) -> DataFrame:
    """All Parquet files at or below ``paths`` as one table, types widened (see :func:`wider`).

    A column that a file lacks is null for its rows.  Columns come in the order
    in which the files, by path, name them.  Folder names ``k=v`` give no column.  Raises
    :class:`SchemaConflict` for types that nothing holds, ``ValueError`` where there is no file.
    Footers are read through pyarrow's file systems, which must reach the paths.
    """
    fold = spark.conf.get("spark.sql.caseSensitive", "false").lower() != "true"
    found = file_schemas(spark, *paths)
    # a row per distinct schema
    kinds = [(r["schema"], T.StructType.fromJson(json.loads(r["schema"])))
             for r in found.groupBy("schema").agg(F.min("path").alias("first")).orderBy("first").collect()]
    if not kinds:
        raise ValueError(f"no Parquet file at {', '.join(paths)}")
    wide = functools.reduce(lambda a, b: wider(a, b, text=text, fold=fold), [own for _, own in kinds])
    parts = []
    for name, own in kinds:
        # names only: the reader takes its files as a list
        files = [r["path"] for r in found.where(F.col("schema") == name).select("path").orderBy("path").toLocalIterator()]
        rows = spark.read.schema(own).parquet(*files)
        parts.append(rows.select(*_fields(_quoted, own, wide, fold)))
    return functools.reduce(DataFrame.unionAll, parts)
