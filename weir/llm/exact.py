"""Exact duplicates by an extendible-hash index on shared files.

A text's key is a 64-bit hash of its normalised form (A-Z lower-cased).  The
index has a directory over the first bits of the keys and buckets of entries;
an entry is one distinct text:

1. *Entries.*  Texts are grouped by key and by their bytes, so that copies
   collapse in the task that reads them and equal hashes are never taken for
   equal texts.
2. *Directory.*  It doubles while a bucket is overfull: a bucket with more than
   ``capacity`` entries is split by its next bit, up to ``MAX_DEPTH`` bits.  The
   counts of all possible buckets come from one aggregate over at most
   ``2 ** MAX_DEPTH`` cells, so all doublings are decided at once.
3. *Owners.*  Entries are dealt out by key ranges that follow the buckets; the
   task that owns a range chains the entries of one key by the digest of their
   bytes and writes its part of the index.
4. *Probe.*  Rows look up their bucket's entry by key, those of a chained key
   by the digest of their text too.  An entry that holds a large share of all
   rows is sent to the rows, as there can be only few; the others meet theirs
   by a shuffle of keys.  Texts move once, copies of a task as one.

Everything is DataFrame functions.

Defined cases: a null text is an empty one; a null doc_id is smaller than any
other; rows alike in id and text are copies like others, exactly one of which
is kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import written

#: Entries of a bucket before it splits, at least; large tables get as many buckets as the directory can name.
CAPACITY = 4096
#: Longest directory: 2 ** MAX_DEPTH places.
MAX_DEPTH = 16
#: An entry with one in so many of all rows is broadcast; there can be no more than that.
HOT_SHARE = 1024

Key = Callable[[Column], Column]


class Index(NamedTuple):
    """Tables of the index: (bucket, depth, entries) and (bucket, key, chain, link, text_sha256, group_size, keep_id, keep_part)."""

    directory: DataFrame
    entries: DataFrame
    #: the rows that were indexed, as (key, link, doc_id, part, copies)
    rows: DataFrame


def folded(text: Column) -> Column:
    """``text`` with A-Z, and no other letters, in lower case; null as empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def _cell(key: Column) -> Column:
    return F.shiftrightunsigned(key, 64 - MAX_DEPTH).cast("int")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(cell, depth, bucket, entries): which bucket each cell of keys belongs to once no bucket is overfull.

    ``bucket`` is the first key prefix of the bucket, as a cell, so that buckets
    follow the order of their keys.  At most 2 ** MAX_DEPTH rows.
    """
    cells = written(keys.groupBy(_cell(F.col("key")).alias("cell")).agg(F.count(F.lit(1)).alias("n")), "exact-cells")
    total = cells.agg(F.sum("n")).first()[0] or 0
    # a directory of bounded size has room for twice as many buckets as it should need
    capacity = max(capacity, -(-2 * total // 2 ** MAX_DEPTH))
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(MAX_DEPTH))).alias("depth"))
    # (cell >> rest) << rest, rest the bits behind the prefix
    prefix = (F.col("cell") - F.expr(f"cell % cast(power(2, {MAX_DEPTH} - depth) as int)")).cast("int")
    levels = levels.withColumn("bucket", prefix)
    sizes = levels.groupBy("depth", "bucket").agg(F.sum("n").alias("entries"))
    found = levels.join(F.broadcast(sizes), ["depth", "bucket"])
    # a cell's bucket is the first on the way down that isn't overfull
    stops = F.min(F.when((F.col("entries") <= capacity) | (F.col("depth") == MAX_DEPTH), F.struct("depth", "bucket", "entries")))
    return written(found.groupBy("cell").agg(stops.alias("at")).select("cell", "at.*"), "exact-directory")


def build(docs: DataFrame, capacity: int = CAPACITY, key: Key = F.xxhash64) -> Index:
    """The index of the texts of ``docs`` and the rows as it sees them."""
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), folded(F.col("text")).alias("folded"))
             .select("doc_id", "folded", key(F.col("folded")).alias("key")))
    distinct = written(texts.groupBy("key", "folded").agg(F.count(F.lit(1)).alias("n"))
                       .select("key", F.sha2("folded", 256).alias("text_sha256")), "exact-texts")
    places = directory(distinct.select("key").distinct(), capacity)

    owned = (distinct.join(F.broadcast(places.select(F.col("cell"), "bucket")), _cell(F.col("key")) == F.col("cell"))
             .repartitionByRange("bucket", "key").sortWithinPartitions("bucket", "key", "text_sha256"))
    of_key = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    chains = written(owned.select("bucket", "key", "text_sha256", F.row_number().over(of_key).alias("chain")), "exact-chains")
    chained = written(chains.where("chain = 2").select("key"), "exact-chained")

    # a row's link: nothing where its key has one text, the text's digest where it has several
    flagged = texts.join(chained.withColumn("several", F.lit(True)), "key", "left")
    link = F.when(F.col("several"), F.sha2("folded", 256)).otherwise(F.lit(""))
    rows = written(flagged.select("key", link.alias("link"), "doc_id", F.spark_partition_id().alias("part"))
                   .groupBy("key", "link", "doc_id", "part").agg(F.count(F.lit(1)).alias("copies")), "exact-rows")
    groups = (rows.groupBy("key", "link").agg(F.sum("copies").alias("group_size"), F.max(F.struct("doc_id", "part")).alias("keep"))
              .select("key", "link", "group_size", F.col("keep.doc_id").alias("keep_id"), F.col("keep.part").alias("keep_part")))
    several = chains.join(chained.withColumn("several", F.lit(True)), "key", "left")
    linked = several.withColumn("link", F.when(F.col("several"), F.col("text_sha256")).otherwise(F.lit(""))).drop("several")
    entries = written(linked.join(groups, ["key", "link"]).repartitionByRange("bucket", "key")
                      .sortWithinPartitions("bucket", "key", "chain"), "exact-index")
    return Index(places.select("bucket", "depth", "entries").distinct(), entries, rows)


def duplicates(docs: DataFrame, capacity: int = CAPACITY, key: Key = F.xxhash64) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs``.

    keep_id is the largest doc_id among equal texts; of the rows that have it one is kept.
    """
    index = build(docs, capacity, key)
    total = index.rows.agg(F.sum("copies")).first()[0] or 0
    entries = index.entries.select("key", "link", "text_sha256", "group_size", "keep_id", "keep_part")
    hot = entries.where(F.col("group_size") * HOT_SHARE >= total)
    cold = entries.where(F.col("group_size") * HOT_SHARE < total)
    few = index.rows.join(F.broadcast(hot.select("key", "link")), ["key", "link"], "left_anti")
    found = (index.rows.join(F.broadcast(hot), ["key", "link"])
             .unionByName(few.join(cold, ["key", "link"])))
    # copies of one id and text, as many as one task had read; the first of the last task's is the one that stays
    numbered = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("part") == F.col("keep_part")) & (F.col("copy") == 1)
    return numbered.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
