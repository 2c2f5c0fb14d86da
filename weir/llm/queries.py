"""Registered queries of this package: one per operator, over its whole table.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` has the
DuckDB statement where SQL can express the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm import bpe, exact, language, lm, mixing, neighbours, ngram_join, oracle, quality, sharding, toxicity, trie, warc, whitening
from weir.llm.common import ready, table
from weir.session import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's 3-word set size and the component it is in at similarity 0.9."""
    return ngram_join.join_components(table(spark, sf_dir, "documents"), 3, 90).drop("row")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of adaptive thresholds on every document."""
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what the mix takes of it, in training order."""
    return (mixing.mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("position"))
            .repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    held_out = language.held_out("doc_id", 4, 2)
    labels = table(spark, sf_dir, "labels").where(~held_out)
    found = toxicity.score(docs, docs, labels, ["doc_id"]).withColumnRenamed("k0", "doc_id")
    return found.select("doc_id", held_out.alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record, and what reading the archives back gives."""
    path = fresh_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.summary(spark, path)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the part that is not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, docs.where(~language.held_out()), ["doc_id"])
    return (found.withColumnRenamed("k0", "doc_id")
            .select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score"))


def vocabulary_path() -> str:
    """The vocabulary file of the contract, where the public package keeps it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to ids and decoded again, as counts and digests."""
    rows = bpe.encode(table(spark, sf_dir, "documents"), vocabulary_path(), ["doc_id"], decoded=True)
    return rows.select(
        F.col("k0").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors to every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"), 10)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much more like the benchmark's texts than like the corpus every document is, in nats a word."""
    docs = table(spark, sf_dir, "documents")
    return lm.score(docs, docs, table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards, and where it goes with 41."""
    return sharding.shard(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first four principal components, each with unit variance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), 4)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of all with its text, up to the case of A-Z."""
    return exact.duplicates(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {f.__name__: _ready(f) for f in (
    op1_ngram_join, op2_quality_rules, op3_mixing, op4_toxicity, op5_warc, op6_language_id, op7_bpe, op8_neighbours, op9_lm_scoring, op10_sharding,
    op11_whitening, op12_exact_dedup, op13_prefix_trie)}

ORACLE: dict[str, str] = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
