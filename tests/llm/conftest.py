from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use themselves
    T.StructField("size", T.StringType()), T.StructField("shard", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("lang_pred", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("positions", T.StringType()), T.StructField("k0", T.StringType()), T.StructField("position", T.StringType()),
])
EXTRA = len(SCHEMA) - 5


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * EXTRA)


def awkward_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "naïve", "groß", "año", "ça"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    rows = [row(1, None), row(2, ""), row(3, " \t\n"), row(None, "some words without an id"), row(4, "one"),
            row(5, "two words"), row(6, "Same text here twice"), row(7, "same TEXT here twice"), row(8, long),
            row(9, "line one here\nline one here\nanother line"), row(10, "### $$$ 12345"), row(11, "x" * 50_000),
            row(12, "text", None, None), row(13, "no letters? 123", "en", ""), row(14, "été où ça Σ İ ß", "fr", "b"),
            row(15, "repeated row"), row(15, "repeated row"), row(-3, "negative id"), (None,) * len(SCHEMA)]
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))
        rows.append(row(100 + i, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])))
    return rows


@pytest.fixture(scope="session")
def awkward(spark):
    from weir.llm.common import ready

    ready(spark)
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    from weir.llm.common import ready

    ready(spark)
    return spark.createDataFrame([], SCHEMA)
