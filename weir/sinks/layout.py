"""A sorted layout that takes batch after batch without being rewritten whole.

``<path>`` holds immutable Parquet files and, per load, a manifest: a small
table with one row per file and the range of sort keys in it.  A pointer file
(:mod:`weir.landings`), written last, says which manifest counts, so a reader or a
crash at any step sees the layout before a load or after it, never between.

A load is written sorted by itself first, cut where files of the layout begin, so
that late rows and those at the front never share a file that spans all between.
A sweep over the key ranges of its files and of the layout's finds those that
overlap; only these are merged, each group of overlapping files by itself, so no
merged file reaches over one that was left alone.  Loads are numbered: one that the layout has is not added again.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import folders, landings
from weir.session import fresh_path
from weir.sinks.files import write_sorted

GROUP = "weir_group"
PART = "weir_part"
#: Files whose group is looked up in one merge; larger groups are merged by themselves.
FILES_PER_MERGE = 10_000


def last_load(spark: SparkSession, path: str) -> int:
    """Number of the last load that the layout has; -1 where there is none."""
    known = landings.pointers(spark, path)
    return int(known[-1][1].removeprefix("landing-")) if known else -1


def _manifest_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    place = T.StructType([schema[k] for k in keys])
    return T.StructType([T.StructField("file", T.StringType()), T.StructField("low", place),
                         T.StructField("high", place), T.StructField("rows", T.LongType())])


def layout_manifest(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """``(file, low, high, rows)`` per file of the layout; ``low`` and ``high`` are structs of the sort keys."""
    own = _manifest_schema(schema, keys)
    if last_load(spark, path) < 0:
        return spark.createDataFrame([], own)
    return spark.read.schema(own).parquet(landings.current(spark, path))


def _file() -> Column:
    """The file a row is read from, below the layout's folder (names alone repeat in the folders of one write)."""
    return F.regexp_extract("_metadata.file_path", r".*/((?:data|merged)-[0-9]+/.*)$", 1)


def _ranges(spark: SparkSession, path: str, folder: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Manifest rows of the files below ``<path>/<folder>``; reads their key columns only."""
    place = F.struct(*keys)
    written = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/{folder}")
    return written.groupBy(_file().alias("file")).agg(
        F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("rows"))


Scan = tuple[str, Callable[[Column], Column], Callable[[Column, Column], Column], Column, bool]


def _carried(df: DataFrame, order: Sequence[str], *scans: Scan) -> DataFrame:
    """Adds, per scan ``(name, total, join, value, forward)``, ``total`` of ``value`` over all rows before (or after) this one.

    Inside a range partition by a window; what the other partitions add comes
    from one row per partition, so no task sees all rows and the broadcast has as
    many rows as the shuffle has partitions.
    """
    def before(window, by: Sequence[str], forward: bool):
        return window(*[(F.asc if forward else F.desc)(c) for c in by]).rowsBetween(Window.unboundedPreceding, -1)

    sums = df.groupBy(PART).agg(*[total(value).alias(name) for name, total, _, value, _ in scans])
    carry = sums.select(PART, *[total(F.col(name)).over(before(Window.orderBy, [PART], forward)).alias(f"{name}_carry")
                                for name, total, _, _, forward in scans])
    inside = [join(total(value).over(before(Window.partitionBy(PART).orderBy, order, forward)), F.col(f"{name}_carry")).alias(name)
              for name, total, join, value, forward in scans]
    return df.join(F.broadcast(carry), PART).select(*df.columns, *inside)


def _sum(name: str, value: Column) -> Scan:
    zero = lambda c: F.coalesce(c, F.lit(0))
    return name, F.sum, lambda a, b: zero(a) + zero(b), value, True


def _write_cut(df: DataFrame, path: str, old: DataFrame, keys: Sequence[str], tie_breaker: Sequence[str]) -> None:
    """Sorted files of ``df``, none of which reaches over the beginning of a file of the layout.

    Rows and the beginnings of files are swept together: the number of
    beginnings up to a row's key names the folder it goes to.  A hash among the range
    keys spreads a hot key over tasks.
    """
    spark = df.sparkSession
    rows = df.select(F.struct(*keys).alias("low"), F.lit(1).alias("kind"), F.xxhash64(*tie_breaker).alias("tie"),
                     F.struct(*df.columns).alias("row"))
    begins = old.select("low", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("tie"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
    dealt, order = fresh_path(spark, "layout-cut"), ("low", "kind", "tie")
    rows.unionByName(begins).repartitionByRange(*order).withColumn(PART, F.spark_partition_id()).write.parquet(dealt)
    swept = _carried(spark.read.parquet(dealt), order, _sum(GROUP, 1 - F.col("kind")))
    (swept.where("kind = 1").sortWithinPartitions(GROUP, PART, "low", "tie").select("row.*", GROUP, PART)
     .write.mode("overwrite").partitionBy(GROUP, PART).parquet(path))
    folders.remove(spark, dealt)


def sweep(old: DataFrame, new: DataFrame) -> DataFrame:
    """Manifest rows of both with ``is_new``, ``touched`` and the merge ``group``.

    ``touched``: the range (ends included) shares a key with one of the other
    side.  Touched rows whose ranges hang together form a group.  Files of the
    layout that only touch each other are left alone.
    """
    spark = old.sparkSession
    both = old.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))
    dealt = fresh_path(spark, "layout-sweep")
    # written, so that every scan below sees the same partitions
    both.repartitionByRange("low").withColumn(PART, F.spark_partition_id()).write.parquet(dealt)
    marked = spark.read.parquet(dealt)
    order = ("low", "high", "file")
    scans = []
    for side, of in {"new": F.col("is_new"), "old": ~F.col("is_new")}.items():
        scans.append((f"{side}_high", F.max, F.greatest, F.when(of, F.col("high")), True))
        scans.append((f"{side}_low", F.min, F.least, F.when(of, F.col("low")), False))
    marked = _carried(marked, order, *scans)

    def meets(side: str) -> Column:
        # one that begins earlier and reaches here, or one that begins later, but within this range
        return F.coalesce(F.col(f"{side}_high") >= F.col("low"), F.lit(False)) | \
            F.coalesce(F.col(f"{side}_low") <= F.col("high"), F.lit(False))

    marked = marked.withColumn("touched", F.when(F.col("is_new"), meets("old")).otherwise(meets("new")))
    marked = _carried(marked, order, ("reach", F.max, F.greatest, F.when(F.col("touched"), F.col("high")), True))
    opens = F.when(F.col("touched") & F.coalesce(F.col("low") > F.col("reach"), F.lit(True)), 1).otherwise(0)
    marked = marked.withColumn("opens", opens)
    marked = _carried(marked, order, _sum("opened", F.col("opens")))
    group = F.when(F.col("touched"), F.col("opened") + F.col("opens"))
    return marked.select("file", "low", "high", "rows", "is_new", "touched", group.alias("group"))


def _merge(spark: SparkSession, path: str, folder: str, schema: T.StructType, keys: Sequence[str],
           tie_breaker: Sequence[str], touched: list, rows_per_file: int) -> None:
    """Rewrite touched files, each group sorted into files of its own."""
    groups: dict[int, list] = {}
    for row in touched:
        groups.setdefault(row["group"], []).append(row)
    jobs, shared = [], []
    for files in groups.values():
        if len(files) > FILES_PER_MERGE:
            jobs.append(files)
        elif len(shared) + len(files) > FILES_PER_MERGE:
            jobs.append(shared)
            shared = list(files)
        else:
            shared += files
    if shared:
        jobs.append(shared)
    for n, files in enumerate(jobs):
        rows = spark.read.schema(schema).parquet(*[f"{path}/{f['file']}" for f in files])
        if len({f["group"] for f in files}) == 1:
            rows = rows.select(*schema.fieldNames(), F.lit(files[0]["group"]).alias(GROUP))
        else:  # at most FILES_PER_MERGE rows are broadcast
            of = spark.createDataFrame([(f["file"], f["group"]) for f in files], f"{GROUP}_file string, {GROUP} long")
            rows = rows.select(*schema.fieldNames(), _file().alias(f"{GROUP}_file")) \
                .join(F.broadcast(of), f"{GROUP}_file").drop(f"{GROUP}_file")
        order = [GROUP, *keys, F.xxhash64(*tie_breaker)]
        parts = max(1, math.ceil(sum(f["rows"] for f in files) / rows_per_file))
        (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
         .write.mode("overwrite").partitionBy(GROUP).parquet(f"{path}/{folder}/{n}"))


def add_load(df: DataFrame, path: str, sort_keys: Sequence[str], number: int, *,
             tie_breaker: Sequence[str] | None = None, rows_per_file: int = 5_000_000) -> dict | None:
    """Add ``df`` to the layout as load ``number``; None if the layout has that load already.

    Returns how many files were ``kept`` as they are, ``merged`` away and ``added``.
    Numbers must rise.  A load that failed half way is sent again under its number
    and overwrites what it left.  One writer at a time.  Files that only the
    version before the last one named are deleted.
    """
    spark, path, schema = df.sparkSession, path.rstrip("/"), df.schema
    if number <= last_load(spark, path):
        return None
    name = f"{number:012d}"
    old = layout_manifest(spark, path, schema, sort_keys)
    if last_load(spark, path) < 0:
        write_sorted(df, f"{path}/data-{name}", sort_keys, tie_breaker=tie_breaker)
    else:
        _write_cut(df, f"{path}/data-{name}", old, sort_keys, tie_breaker or df.columns)
    new = _ranges(spark, path, f"data-{name}", schema, sort_keys)
    found = fresh_path(spark, "layout-found")
    sweep(old, new).write.parquet(found)
    marked = spark.read.parquet(found)
    # names of the files to merge: the driver hands them to the reader
    touched = marked.where("touched").select("file", "rows", "group").collect()
    kept = marked.where("NOT touched").select("file", "low", "high", "rows")
    manifest = kept
    if touched:
        _merge(spark, path, f"merged-{name}", schema, sort_keys, tie_breaker or schema.fieldNames(), touched, rows_per_file)
        manifest = kept.unionByName(_ranges(spark, path, f"merged-{name}", schema, sort_keys))
    manifest.write.mode("overwrite").parquet(f"{path}/landing-{name}")
    landings.point(spark, path, f"landing-{name}")
    counts = marked.agg(F.count_if(~F.col("touched") & ~F.col("is_new")).alias("kept"),
                        F.count_if(F.col("touched") & ~F.col("is_new")).alias("merged")).first()
    total = layout_manifest(spark, path, schema, sort_keys).count()
    _forget_files(spark, path)
    return {"kept": counts["kept"], "merged": counts["merged"], "added": total - counts["kept"]}


def _forget_files(spark: SparkSession, path: str) -> None:
    """Delete the files, and then the manifests, that neither the last version nor the one before it names."""
    known = [v for _, v in landings.pointers(spark, path)]
    gone, left = known[:-2], known[-2:]
    for version in gone:
        names = spark.read.parquet(f"{path}/{version}").select("file")
        for other in left:
            names = names.join(spark.read.parquet(f"{path}/{other}").select("file"), "file", "left_anti")
        for row in names.toLocalIterator():
            folders.remove(spark, f"{path}/{row['file']}")
    landings.forget(spark, path)


def compact_batches(spark: SparkSession, batches_path: str, path: str, schema: T.StructType,
                    sort_keys: Sequence[str], until: int | None = None, **options) -> dict | None:
    """Add a stream's batches (folders ``batch_id=<n>``) that the layout lacks, as one load.

    Pass the last committed batch as ``until`` while the stream runs; without
    it every batch there is counts.  None if there is nothing new.
    """
    from weir.streaming.batch_sinks import BATCH_COLUMN

    numbers = [int(n.partition("=")[2]) for n in folders.names(spark, batches_path) if n.startswith(f"{BATCH_COLUMN}=")]
    numbers = [n for n in numbers if n > last_load(spark, path) and (until is None or n <= until)]
    if not numbers:
        return None
    batches = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.LongType())])).parquet(batches_path)
    rows = batches.where(F.col(BATCH_COLUMN).between(min(numbers), max(numbers))).select(*schema.fieldNames())
    return add_load(rows, path, sort_keys, max(numbers), **options)


def _bounded(key: Column, low: Sequence | None, high: Sequence | None, names: Sequence[str], other: Column | None = None) -> Column:
    """Whether the range ``key`` to ``other`` (one key, without it) meets ``low`` to ``high``, both included."""
    def head(place: Column, n: int) -> Column:
        return F.struct(*[place[k].alias(k) for k in names[:n]])

    def value(of: Sequence) -> Column:
        return F.struct(*[F.lit(v).alias(k) for k, v in zip(names, of)])

    found = F.lit(True)
    if low:
        found = found & (head(key if other is None else other, len(low)) >= value(low))
    if high:
        found = found & (head(key, len(high)) <= value(high))
    return found


def read_layout(spark: SparkSession, path: str, schema: T.StructType, sort_keys: Sequence[str],
                low: Sequence | None = None, high: Sequence | None = None) -> DataFrame:
    """Rows of the layout whose sort keys lie from ``low`` to ``high``, ends included.

    A bound is a tuple of the first one or more keys.  Only the files whose range meets
    the bounds are opened.  A null key sorts before all values.
    """
    path = path.rstrip("/")
    hit = layout_manifest(spark, path, schema, sort_keys).where(_bounded(F.col("low"), low, high, sort_keys, F.col("high")))
    files = [f"{path}/{r['file']}" for r in hit.select("file").toLocalIterator()]
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files).select(*schema.fieldNames())
    first = F.col(sort_keys[0])
    if low and low[0] is not None:  # plain filters reach the scan's row groups
        rows = rows.where(first >= F.lit(low[0]))
    if high and high[0] is not None:
        rows = rows.where(first.isNull() | (first <= F.lit(high[0])))
    return rows.where(_bounded(F.struct(*sort_keys), low, high, sort_keys))
