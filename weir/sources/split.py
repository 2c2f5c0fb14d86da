"""Multi-line files read by many tasks: JSON arrays cut at their elements, CSV at its records.

Where an element or a record ends depends on all text before it: whether a quote
is open, and how many brackets.  Both are sums, so they need no reading in order:

1. Tasks read byte ranges of the files, cut at commas (JSON) or line ends (CSV),
   so that no escape sequence is cut.  They write the text in chunks of about
   ``CHUNK`` bytes, each with the number of quotes since the range's start and the
   depth since then, under both assumptions: a string open at that start, or none.
2. Running sums over the byte ranges of a file, a row per range and without the
   text, give each range the state it really starts in, and so each chunk.
3. Tasks cut their chunks at the commas between elements, or at the line ends
   between records, and emit what lies whole in a chunk.  What crosses chunks, two
   pieces a chunk, is put together by a small group-by.

The chunks are a written table: the second pass doesn't depend on how the scan
was split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.session import fresh_path, share_package

#: Bytes of a chunk, about: a piece between two separators is never cut.
CHUNK = 1 << 20

Batches = Iterator[pa.RecordBatch]
# quotes, and depth if no string is open at the start of the range (closed) or one is (opened): before the chunk, and after it
_CHUNKS = ("file string, start long, seq long, text string, lead string, quotes long, closed long, opened long, "
           "quotes_after long, closed_after long, opened_after long")
_QUOTE, _BACKSLASH, _COMMA, _NEWLINE = (np.uint8(ord(c)) for c in '"\\,\n')
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("["), ord("{")]] = 1
_DEPTH[[ord("]"), ord("}")]] = -1


def _quotes(raw: np.ndarray, escapes: bool) -> np.ndarray:
    """Which bytes are quotes that open or close a string."""
    quote = raw == _QUOTE
    if not escapes:  # a doubled quote closes and opens again
        return quote
    slash = raw == _BACKSLASH
    if not slash.any():
        return quote
    # length of the run of backslashes that ends before each byte
    at = np.arange(len(raw))
    last_other = np.maximum.accumulate(np.where(slash, -1, at))
    run = np.concatenate([[0], (at - last_other)[:-1]])
    return quote & (run % 2 == 0)


def _changes(raw: np.ndarray, quote: np.ndarray) -> tuple[int, int]:
    """Change of depth if no string is open at the start, and if one is."""
    inside = (np.cumsum(quote) - quote) % 2 == 1
    depth = _DEPTH[raw]
    return int(depth[~inside].sum()), int(depth[inside].sum())


def _chunked(separator: str, escapes: bool) -> Callable[[Batches], Batches]:
    names = [c.split(" ")[0] for c in _CHUNKS.split(", ")]

    def run(batches: Batches) -> Batches:
        now, seq, parts, size, state = None, 0, [], 0, (0, 0, 0)

        def sent() -> pa.RecordBatch:
            nonlocal state
            text = "".join(p + separator for p in parts)
            raw = np.frombuffer(text.encode(), np.uint8)
            quote = _quotes(raw, escapes)
            changes = _changes(raw, quote)
            odd = state[0] % 2
            before, state = state, (state[0] + int(quote.sum()), state[1] + changes[odd], state[2] + changes[1 - odd])
            row = (*now, seq, text, text.lstrip()[:1], *before, *state)
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names)

        for batch in batches:
            for file, start, value in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "value")), strict=True):
                if (file, start) != now or size > CHUNK:
                    if parts:
                        yield sent()
                    if (file, start) == now:
                        seq += 1
                    else:
                        now, seq, state = (file, start), 0, (0, 0, 0)
                    parts, size = [], 0
                parts.append(value)
                size += len(value) + 1
        if parts:
            yield sent()
    return run


def _cut(json: bool) -> Callable[[Batches], Batches]:
    """Pieces of each chunk: kind 0 whole, 1 what ends in it (or crosses it), 2 what it leaves open."""
    names = ["file", "start", "seq", "kind", "cuts", "piece"]

    def cuts(raw: np.ndarray, inside: int, depth: int, array: bool) -> np.ndarray:
        quote = _quotes(raw, json)
        out = (np.cumsum(quote) - quote + inside) % 2 == 0
        if not json:
            return np.flatnonzero((raw == _NEWLINE) & out)
        if not array:
            return np.zeros(0, np.int64)
        change = np.where(out, _DEPTH[raw], 0)
        after = np.cumsum(change) + depth
        before = after - change
        # between elements, and the brackets of the array itself
        return np.flatnonzero((out & (raw == _COMMA) & (before == 1)) | ((before == 0) & (after == 1)) | ((before == 1) & (after == 0)))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("file", "start", "seq", "text", "inside", "depth", "array"))
            for file, start, seq, text, inside, depth, array in zip(*columns, strict=True):
                data = text.encode()
                at = cuts(np.frombuffer(data, np.uint8), inside, depth, array)
                ends = [*at.tolist(), len(data)]
                starts = [0, *(at + 1).tolist()]
                pieces = [data[a:b].decode() for a, b in zip(starts, ends, strict=True)]
                kinds = [1] + [0] * (len(pieces) - 2) + [2] if len(pieces) > 1 else [1]
                n = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * n), pa.array([start] * n, pa.int64()), pa.array([seq] * n, pa.int64()), pa.array(kinds, pa.int32()),
                     pa.array([len(at)] * n, pa.int64()), pa.array(pieces, pa.string())], names)
    return run


def _pieces(spark: SparkSession, path: str, json: bool) -> DataFrame:
    """(file, first, piece): the elements or records of all files; first: it begins its file."""
    share_package(spark)
    separator = "," if json else "\n"
    lines = spark.read.option("lineSep", separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    target = fresh_path(spark, "chunks")
    lines.mapInArrow(_chunked(separator, json), _CHUNKS).write.parquet(target)
    chunks = spark.read.schema(_CHUNKS).parquet(target)

    # a row per byte range of a file
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole_file = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    last = F.max(F.struct("seq", "quotes_after", "closed_after", "opened_after")).alias("last")
    lead = F.min(F.when(F.col("lead") != "", F.struct("seq", "lead"))).alias("lead")  # white space alone leads with nothing
    ranges = (chunks.groupBy("file", "start").agg(last, lead)
              .withColumn("range_inside", F.coalesce(F.sum("last.quotes_after").over(before), zero) % 2 == 1)
              .withColumn("change", F.when(F.col("range_inside"), F.col("last.opened_after")).otherwise(F.col("last.closed_after")))
              .withColumn("range_depth", F.coalesce(F.sum("change").over(before), zero))
              .withColumn("array", F.coalesce(F.first("lead.lead", ignorenulls=True).over(whole_file) == "[", F.lit(False)))
              .select("file", "start", "range_inside", "range_depth", "array"))
    inside = (F.col("range_inside").cast("long") + F.col("quotes")) % 2
    depth = F.col("range_depth") + F.when(F.col("range_inside"), F.col("opened")).otherwise(F.col("closed"))
    # a row per split is broadcast: the text isn't shuffled
    known = chunks.join(F.broadcast(ranges), ["file", "start"]).select("file", "start", "seq", "text", inside.alias("inside"), depth.alias("depth"), "array")
    cut = fresh_path(spark, "pieces")
    kinds = "file string, start long, seq long, kind int, cuts long, piece string"
    known.mapInArrow(_cut(json), kinds).write.parquet(cut)
    pieces = spark.read.schema(kinds).parquet(cut)
    whole = pieces.where("kind = 0").select("file", F.lit(False).alias("first"), "piece")

    # What crosses chunks: all between two cuts that lie in different chunks.  Pieces between the same two have the
    # same number of cut chunks before them, counted within the range and over the ranges before.
    open_ = pieces.where("kind > 0").withColumn("cut", F.when((F.col("kind") == 1) & (F.col("cuts") > 0), 1).otherwise(0).cast("long"))
    inner = Window.partitionBy("file", "start").orderBy("seq", "kind").rowsBetween(Window.unboundedPreceding, -1)
    outer = (open_.drop("piece").groupBy("file", "start").agg(F.sum("cut").alias("cut"))
             .select("file", "start", F.coalesce(F.sum("cut").over(before), zero).alias("earlier")))
    joined = (open_.withColumn("within", F.coalesce(F.sum("cut").over(inner), zero)).join(outer, ["file", "start"])
              .groupBy("file", (F.col("earlier") + F.col("within")).alias("run"))
              .agg(F.sort_array(F.collect_list(F.struct("start", "seq", "kind", "piece"))).alias("parts"))
              .select("file", (F.col("run") == 0).alias("first"), F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("piece")))
    return whole.unionByName(joined)


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(value): the text of each element of the JSON arrays at ``path``; a file of one object is one element.

    The comma that ends the scan of a file is not the file's own and is cut off.
    """
    pieces = _pieces(spark, path, True).select(F.btrim("piece", F.lit(", \t\r\n")).alias("value"))
    return pieces.where("value <> ''")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(first, value): the text of each CSV record at ``path``, line ends in quotes included; first: it begins its file."""
    pieces = _pieces(spark, path, False).select("first", F.rtrim("piece", F.lit("\r\n")).alias("value"))
    return pieces.where("value <> ''")
