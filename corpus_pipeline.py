"""The corpus pipeline: five stages over ``documents``, each writing its rows for the next.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``.  :func:`run` writes each result as Parquet in the
shared scratch folder and reads it again, so a lost executor never costs more
than the stage that runs.

Columns beyond those a stage reads are carried along, whatever they are called.
Null and empty texts are documents without words in every stage, a null id is an
id like others, and an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm import bpe, language, mixing, ngram_join, toxicity
from weir.llm.common import as_named, ready, table, written
from weir.llm.queries import vocabulary_path

#: How far the mean log-probability of a document's n-grams may lie below that of its language's training texts.
LEAST_FIT = -4.0
#: Near copies: words of an n-gram, and percent of all n-grams of two documents that both have.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic.

    Null and empty texts get the score of a text without any sign.  Rows alike
    share their verdict; without labels of both kinds nothing is toxic.
    """
    ready(spark)
    labels = table(spark, sf_dir, "labels").where(~language.held_out("doc_id", 4, 2))
    found = toxicity.score(docs, docs, labels, docs.columns)
    return found.where(F.col("score") < toxicity.THRESHOLD).select(*as_named(docs.columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose n-grams are about as likely in their best language as those of its training texts are.

    The posterior alone tells nothing: summed over many n-grams it is near 1 for
    garbled text, too.  Texts without a letter go, null and empty ones among
    them; with no language learned, all do.
    """
    ready(spark)
    found = language.identify(docs, docs.where(~language.held_out()), docs.columns)
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("fit") >= LEAST_FIT)
    return found.where(known).select(*as_named(docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents: that with the smallest id.

    Documents without words are no group and stay.  Repeated rows count as one:
    of rows alike in id and text, that with the least other columns stays.
    Among rows of one id, or in a group without any, the least name by content stays.
    """
    ready(spark)
    own = "row named by its content"
    rows = written(ngram_join.join_groups(docs, NEAR_WORDS, NEAR_PERCENT).select("doc_id", "row", "root"), "near-groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row"))
    stays = (rows.where("root IS NOT NULL").groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias(own))
             .unionByName(rows.where("root IS NULL").select(F.col("row").alias(own))))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # the join has dealt rows out by their name, so equal rows are together already
    return (docs.withColumn(own, ngram_join.named()).join(stays, own, "left_semi")
            .groupBy(own, "doc_id", "text").agg(F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("least"))
            .select("doc_id", "text", "least.*").select(*[F.col(f"`{c}`") for c in docs.columns]))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, once for each time it takes them, in training order.

    Documents without words are not taken.
    """
    ready(spark)
    mixed = mixing.mix(docs, keep=docs.columns)
    return mixing.in_training_order(mixed).select(*as_named(docs.columns))


def in_file_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``position``: the number of the row, from 0, in the order of its files and of the rows in them.

    Rows that come from no file are numbered as they come.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns]
    try:
        rows = docs.select(*keep, F.col("_metadata.file_path").alias("path of its file"), F.col("_metadata.row_index").alias("position"))
    except AnalysisException:  # not a scan of files
        return docs.select(*keep, F.monotonically_increasing_id().alias("position"))
    counts = rows.groupBy("path of its file").agg(F.count(F.lit(1)).alias("rows in it"))
    # a row per file
    before = F.sum("rows in it").over(Window.orderBy("path of its file").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("path of its file", F.coalesce(before, F.lit(0)).alias("rows before it"))
    return (rows.join(F.broadcast(starts), "path of its file")  # no more than the driver has listed for the scan
            .select(*keep, (F.col("rows before it") + F.col("position")).alias("position")))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, with their place in the training order and the digest of the decoded text.

    Null and empty texts have no tokens.
    """
    ready(spark)
    keep = ["doc_id", "lang", "source", "position"]
    docs = in_file_order(docs.select("doc_id", "lang", "source", "text"))
    rows = bpe.encode(docs, vocabulary_path(), keep, decoded=True)
    return rows.select(*as_named(keep), F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("ngram_join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: SQL can express neither the classifiers nor the tokenizer; tests compare with the operators one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
