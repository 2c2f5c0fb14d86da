"""Jump consistent hashing: stable keys to shards, without a ring table.

A key visits shards 0 = j0 < j1 < j2 ...; from shard b it jumps to
``floor((b + 1) / r)``, r a uniform number in (0, 1] made from (key, b) alone.
With n shards the key lives in the last shard below n that it visits, so adding
shard n moves only the keys that jump onto n, and moves them only there.

Everything is a projection but the slots: rows get gapless numbers within
their shard by counts per (shard, piece), where pieces are equal ranges of a
hash of the key and the text, and row numbers inside a piece.  No task holds a
whole shard, whatever its size.

Defined cases: a null key is the key ``null``; a null text has 0 bytes and
CRC 0; rows alike in key and text share a shard and get adjacent slots; an
empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import id_text

#: Pieces a shard is numbered in (hex digits of the hash: 16 ** 3).
PIECE_DIGITS = 3
#: Bytes a row takes besides its text.
ROW_BYTES = 16
#: r has 52 random bits: 13 hex digits, exact in a double.
_R_DIGITS, _R_RANGE = 13, float(1 << 52)


def _uniform(key: Column, b: Column) -> Column:
    digits = F.substring(F.md5(F.concat_ws(":", key, b.cast("string"))), 1, _R_DIGITS)
    return (F.conv(digits, 16, 10).cast("long") + 1) / F.lit(_R_RANGE)


def jump(key: Column, shards: list[int]) -> list[Column]:
    """The shard of ``key`` under each count in ``shards`` (one walk for all)."""
    last = max(shards)
    start = F.struct(F.lit(0).alias("next"), *[F.lit(0).alias(f"s{i}") for i in range(len(shards))])

    def visit(state: Column, b: Column) -> Column:
        here = state["next"] == b
        # A jump beyond the last shard is as good as one onto it.
        to = F.least(F.floor((b + 1) / _uniform(key, b)), F.lit(last)).cast("int")
        return F.struct(
            F.when(here, to).otherwise(state["next"]).alias("next"),
            *[F.when(here & (b < n), b).otherwise(state[f"s{i}"]).alias(f"s{i}")
              for i, n in enumerate(shards)])

    walk = F.aggregate(F.sequence(F.lit(0), F.lit(last - 1)), start, visit)
    return [walk[f"s{i}"] for i in range(len(shards))]


def shard(docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` placed in shards ``0 .. shards - 1`` by jump hashing of ``key``.

    Returns the key, ``size`` (UTF-8 bytes of the text plus :data:`ROW_BYTES`),
    ``text_crc32``, ``shard``, ``slot`` and ``grown_shard`` (the shard once one
    more is appended).
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    content = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(
        F.col(key).alias(key),
        (F.octet_length(content).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"))
    walk = F.array(*jump(id_text(F.col(key)), [shards, shards + 1]))
    placed = (base
              .withColumn("_at", walk)
              .withColumn("_hash", F.md5(F.concat_ws(":", id_text(F.col(key)), F.col("text_crc32").cast("string"))))
              .withColumn("shard", F.col("_at")[0])
              .withColumn("grown_shard", F.col("_at")[1])
              .withColumn("_piece", F.substring("_hash", 1, PIECE_DIGITS))
              .drop("_at"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    counts = (placed.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("_n"))
              .select("shard", "_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("shard", "_piece").orderBy("_hash", key, "size")
    return (placed.withColumn("_row", F.row_number().over(inside))
            .join(counts, ["shard", "_piece"])
            .select(key, "size", "text_crc32", "shard",
                    (F.col("_before") + F.col("_row") - 1).cast("long").alias("slot"), "grown_shard"))
