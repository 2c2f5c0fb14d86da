"""WARC archives: writing pages as records, and reading archives back by verified boundaries.

Writing.  Each page becomes one record.  Among pages of equal payloads the one
with the largest page_id is a response, the others are revisits that refer to
it and carry no payload.  Only pages whose digest may occur again are exchanged to
find that one, told by a bitmap of bounded size; the others' records are written
where the pages are read.  Archives are plain text files that Spark's text writer
makes, so tasks commit their files as any Spark job does.

Reading.  Files are read in splits, cut at the magic ``WARC/1.0``: every cut is a
candidate record, but a payload may hold the magic too.  Each task emits, for
every candidate, the offset its own header makes its successor start at.
Pointer jumping from the start of each file then keeps the candidates that a
chain of successors reaches; what only looked like a record inside a payload is
on no chain.  Rounds grow with the logarithm of the records of a file.  Last,
the pieces between one verified record and the next are put together again.

Defined cases: a null html is an empty payload; null urls are left out; pages of
one page_id are records of their own (with equal payloads and the largest id,
all of them are responses); a null page_id takes part and is written as an empty
id (and never the largest, if any is known); an empty table writes no record; a
file that does not begin with a record has none; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import discard, written

# Fixed values of the format.
MAGIC = "WARC/1.0\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_BASE32_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# Bits of the map of digests that occur again: 2048 rows of 4 KB, 8 MB at most, however many pages there are.
_BITS = 1 << 26

Batches = Iterator[pa.RecordBatch]


def payload_digest(payload: Column) -> Column:
    """Base32 of the SHA-1: 20 bits, 5 hex digits, make 4 of its letters."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _BASE32_DIGITS, _BASE32)


def _payloads(pages: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", body.alias("payload"), F.octet_length(body).cast("long").alias("payload_bytes"),
                        payload_digest(body.cast("binary")).alias("digest"))


def _repeated(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(digest, payload_bytes, response_id) of the payloads that more than one page has."""
    # equal payloads: equal digest and length.  Only ids go through the grouping.
    return (_payloads(pages).where(F.col("payload_bytes") >= least_bytes).groupBy("digest", "payload_bytes")
            .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"))


def _bit() -> Column:
    """The bit of a payload, from 1."""
    return F.pmod(F.xxhash64("digest", "payload_bytes"), F.lit(_BITS)) + 1


def _may_repeat(base: DataFrame, first: DataFrame) -> DataFrame:
    """``base`` with ``again``: true for every payload of ``first``, and for few others."""
    bits = (first.groupBy(F.bitmap_bucket_number(_bit()).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(_bit())).alias("_bits")))
    at = F.bitmap_bit_position(_bit())
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (base.withColumn("_bucket", F.bitmap_bucket_number(_bit())).join(F.broadcast(bits), ["_bucket"], "left")
            .withColumn("again", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("_bucket", "_bits"))


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, record): the text of each page's WARC record, but for its last line end.

    Payloads under ``least_bytes`` are never revisits.  What payloads occur again is written first.
    """
    return _records(pages, written(_repeated(pages, least_bytes), "warc-repeated"))


def _records(pages: DataFrame, first: DataFrame) -> DataFrame:
    """:func:`records`, given what payloads occur again."""
    base = _may_repeat(_payloads(pages), first)
    told = (base.where("again").join(first, ["digest", "payload_bytes"], "left")
            .unionByName(base.where("NOT again"), allowMissingColumns=True))
    revisit = F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", page(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", page(F.col("response_id"))), line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Payload-Length", F.col("payload_bytes").cast("string")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(block).cast("string")))
    return told.select("page_id", F.concat(head, F.lit("\r\n"), block, F.lit("\r\n")).alias("record"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``, a file a task."""
    first = written(_repeated(pages, least_bytes), "warc-repeated")
    _records(pages, first).select("record").write.option("lineSep", "\r\n").text(path)
    discard(first)


_PIECE = ("file string, split long, inside long, bytes long, next long, head long, "
          "kind string, page string, digest string, refers string, length long, claimed string, crc long, body binary")


def _header(text: bytes) -> tuple[int, dict[str, str]] | None:
    """(bytes of the header, its fields) of a candidate, magic not included."""
    end = text.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for row in text[:end].split(b"\r\n"):
        name, found, value = row.partition(b":")
        if not found:
            return None
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return (end + 4, fields) if _number(fields.get("content-length")) is not None else None


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isascii() and text.isdecimal() and len(text) <= 18 else None


def _pieces(batches: Batches) -> Batches:
    """Pieces between magics: their place in the split, and what they claim if they are records."""
    names = [c.split(" ")[0] for c in _PIECE.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split(" ")[1]] for c in _PIECE.split(", ")]
    magic = len(MAGIC)
    now, at = None, 0
    for batch in batches:
        rows = []
        for file, split, text in zip(*(batch.column(c).to_pylist() for c in ("file", "split", "piece")), strict=True):
            if (file, split) != now:
                now, at = (file, split), 0
            # ``at`` is where the piece's text begins in the split; a record begins at the magic before it
            head = _header(text)
            after, fields = (None, {}) if head is None else (head[0] + int(head[1]["content-length"]) + 4, head[1])
            rows.append((file, split, at, len(text), after, head and head[0], fields.get("warc-type"), fields.get("warc-record-id"),
                         fields.get("warc-payload-digest"), fields.get("warc-refers-to"),
                         _number(fields.get("warc-payload-length")), head and _digest(text[head[0]:len(text) - 4]),
                         zlib.crc32(text), text))
            at += len(text) + magic
        if rows:
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _cut(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of the files under ``path``, with their place in their split and their text."""
    lines = (spark.read.option("lineSep", MAGIC).text(path)
             .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                     F.col("value").cast("binary").alias("piece")))
    return lines.mapInArrow(_pieces, _PIECE)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of the files under ``path`` with their byte offsets in the file, without their texts.

    ``start`` is where a piece's record would begin (its magic), ``next`` where
    the record after it would; the piece before the first magic starts below 0.
    """
    found = written(_cut(spark, path).drop("body"), "warc-pieces")
    every = written(_placed(found).withColumn("next", F.col("start") + len(MAGIC) + F.col("next")), "warc-offsets")
    discard(found)
    return every


def _placed(found: DataFrame) -> DataFrame:
    """The pieces of one written scan with their offset in the file, from that scan's own splits."""
    # a split's pieces follow those of the splits before it
    size = found.groupBy("file", "split").agg(F.sum(F.col("bytes") + len(MAGIC)).alias("_size"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = size.select("file", "split", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    return (found.join(bases, ["file", "split"])
            .withColumn("start", F.col("_base") + F.col("inside") - len(MAGIC)).drop("_base"))


def _texts(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """(file, start, text) of the pieces of a scan of its own, whose splits may be others than those of the first.

    ``wanted`` (bytes, crc) tells which texts to keep; it lets others of equal
    length and checksum through, so texts are found by their offset alone.
    """
    cut = _cut(spark, path).select("file", "split", "inside", "bytes", "crc", "body")
    if wanted is not None:
        cut = (cut.join(wanted.distinct().withColumn("wanted", F.lit(True)), ["bytes", "crc"], "left")
               .withColumn("body", F.when(F.col("wanted"), F.col("body"))))
    found = written(cut.select("file", "split", "inside", "bytes", "body"), "warc-texts")
    return _placed(found).where("body IS NOT NULL").select("file", "start", F.col("body").alias("text"))


def _with_text(places: DataFrame, texts: DataFrame) -> DataFrame:
    """Each of ``places`` with its text; one that has none is an error."""
    missing = F.raise_error(F.concat(F.lit("no text at byte "), F.col("start").cast("string"), F.lit(" of "), F.col("file")))
    return (places.join(texts, ["file", "start"], "left")
            .withColumn("text", F.when(F.col("text").isNotNull(), F.col("text")).otherwise(missing.cast("binary"))))


def reachable(links: DataFrame) -> DataFrame:
    """(file, start) of the candidates that a chain from offset 0 of their file reaches.

    ``links`` has one (file, start, next) per candidate.  Each round the reached
    set jumps along ``next`` and ``next`` doubles its stride, so a file of n
    records takes log n rounds.  Tables are written, nothing is collected; those of
    a round are deleted after the next.
    """
    jumps = written(links.where("next IS NOT NULL"), "warc-jumps")
    reached = written(links.where("start = 0").select("file", "start"), "warc-reached")
    while True:
        onto = links.select("file", "start")
        step = (reached.join(jumps, ["file", "start"]).select("file", F.col("next").alias("start"))
                .join(onto, ["file", "start"], "left_semi"))
        grown = written(reached.unionByName(step).distinct(), "warc-reached")
        far = jumps.alias("a").join(jumps.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.next") == F.col("b.start")))
        further = written(far.select("a.file", "a.start", "b.next"), "warc-jumps")
        discard(jumps, reached)
        jumps, reached = further, grown
        if jumps.isEmpty():
            discard(jumps)
            return reached


def _verified(spark: SparkSession, path: str, every_text: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(records of one piece, records of several with their text, texts of the latter's pieces or of all)."""
    every = pieces(spark, path)
    links = written(every.where("start >= 0").select("file", "start", "next"), "warc-links")
    real = reachable(links)
    discard(links)
    # A piece belongs to the last verified record at or before it.
    marked = every.where("start >= 0").join(real.withColumn("real", F.lit(True)), ["file", "start"], "left")
    up = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = lambda c: F.last(F.when(F.col("real"), F.col(c)), ignorenulls=True).over(up)
    of = (marked.select("file", "start", "next", "real", "bytes", "crc").withColumn("record", known("start")).withColumn("until", known("next"))
          .where("record IS NOT NULL AND start < until").select("file", "start", "bytes", "crc", "record"))
    inner = written(of.where("start > record"), "warc-inner")
    heads = marked.where("real").drop("real")
    parted = inner.select("file", F.col("record").alias("start")).distinct()
    whole = heads.join(parted, ["file", "start"], "left_anti")
    places = written(inner.unionByName(heads.join(parted, ["file", "start"], "left_semi").select(
        "file", "start", "bytes", "crc", F.col("start").alias("record"))), "warc-places")
    # Texts are cut out of the files again where they are wanted, not kept in between.
    texts = _texts(spark, path, None if every_text else places.select("bytes", "crc"))
    joined = (_with_text(places.select("file", "start", "record"), texts)
              .groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
              .select("file", F.col("record").alias("start"),
                      F.concat_ws(MAGIC, F.transform("parts", lambda p: p["text"].cast("string"))).cast("binary").alias("text")))
    return whole, heads.join(joined, ["file", "start"]), texts


def _told() -> list[Column]:
    """What a record's header says."""
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return [F.col("kind").alias("record_type"), number(F.col("page")).alias("page_id"), number(F.col("refers")).alias("refers_to"),
            F.regexp_replace("digest", "^sha1:", "").alias("told_digest"), F.col("length").alias("told_bytes")]


def _payload() -> Column:
    """The block of a record: what follows the header, without the two line ends that close it."""
    return F.substring("text", (F.col("head") + 1).cast("int"), (F.octet_length("text") - F.col("head") - 4).cast("int"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The verified records under ``path``: file, start, payload and what their headers say.

    ``payload`` is the record's block, put together from its pieces; a revisit
    has the length and digest its header tells, and what it refers to.
    """
    whole, joined, texts = _verified(spark, path, every_text=True)
    full = _with_text(whole, texts).unionByName(joined)
    return full.select("file", "start", *_told(), _payload().alias("payload"))


def summary(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the verified records under ``path``.

    Of a response, length and digest are those of the payload that was read:
    tasks take them of every candidate as they cut it out, and candidates that
    are no records go with what was taken of them, so payloads don't travel.  A
    revisit has those of the payload it stands for.
    """
    whole, joined, _ = _verified(spark, path)
    found = (whole.select(*_told(), (F.col("bytes") - F.col("head") - 4).alias("n"), F.col("claimed").alias("sha"))
             .unionByName(joined.select(*_told(), F.octet_length(_payload()).cast("long").alias("n"), payload_digest(_payload()).alias("sha"))))
    revisit = F.col("record_type") == "revisit"
    return found.select(
        "page_id", F.when(revisit, F.col("told_bytes")).otherwise(F.col("n")).alias("payload_bytes"),
        F.when(revisit, F.col("told_digest")).otherwise(F.col("sha")).alias("payload_digest"),
        "record_type", F.when(revisit, F.col("refers_to")).alias("refers_to"))
