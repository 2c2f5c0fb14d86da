"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets a few whole-number measures (per thousand or per million).
Per (lang, source) and measure, a sketch counts documents by value rounded
down to 7 significant bits: a fixed relative error under 1/64, a bounded number
of cells, and merging by adding counts, so any grouping of the input gives the
same sketch.  Sketches of a language, or of everything, are sums of the finer
ones; they stand in for groups of fewer than ``min_rows`` documents.

A threshold is a fence around the middle of its group: the quartiles, widened
by ``spread`` times their distance and by a tolerance of the measure's own, so
that a group in which nearly all documents agree does not lose the next one.
Thresholds are then joined back to the documents, which they pass or fail.

Defined cases: a null text, or one without words, has measures 0 and fails the
base rule; null languages and sources are groups of their own; repeated rows
count and are judged each by themselves; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import NOT_WHITE, WHITE, bind, words, written

#: measure -> (has a lower fence, tolerance).
MEASURES: dict[str, tuple[bool, int]] = {
    "word_length_milli": (True, 1000),
    "symbols_ppm": (False, 100_000),
    "dup_lines_ppm": (False, 500_000),
    "repeat_words_ppm": (False, 400_000),
}
SPREAD = 3
MIN_ROWS = 50
#: Significant bits a sketch keeps of a value.
BITS = 7
BASE_WORDS = 50
BASE_REPEAT_PERCENT = 50


def _repeat_words(ws: Column) -> Column:
    """Words covered by a 3-word window that the text has at least twice."""
    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = bind(pairs, lambda p: F.sort_array(F.transform(
            F.filter(p, lambda x, k: (x["h"] == F.get(p, k - 1)["h"]) | (x["h"] == F.get(p, k + 1)["h"])),
            lambda x: x["i"])))
        steps = bind(again, lambda a: F.transform(
            a, lambda at, k: F.least(F.lit(3), F.coalesce(F.get(a, k + 1) - at, F.lit(3)))))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + x)

    counted = bind(windows(ws), lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(ws) < 3, F.lit(0)).otherwise(counted)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_WHITE))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts and the measures of each text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    per_words = bind(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).cast("long").alias("n_repeat_words")))
    per_lines = bind(_lines(text), lambda n: F.struct(
        F.size(n).cast("long").alias("n_lines"), (F.size(n) - F.size(F.array_distinct(n))).cast("long").alias("n_dup_lines")))
    counts = F.struct(per_words.alias("w"), per_lines.alias("l"),
                      F.length(F.regexp_replace(text, WHITE + "+", "")).cast("long").alias("word_chars"),
                      F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    # behind a one-row generator: the optimizer would copy the counting into each use of a count
    base = docs.select("doc_id", "lang", "source", F.explode(F.array(counts)).alias("c"))
    base = base.select("doc_id", "lang", "source", "c.w.n_words", "c.word_chars", "c.n_symbols",
                       "c.l.n_dup_lines", "c.w.n_repeat_words", "c.l.n_lines")

    def share(part: str, whole: str, unit: int) -> Column:
        return F.when(F.col(whole) > 0, F.expr(f"{part} * {unit} div {whole}")).otherwise(F.lit(0)).cast("long")

    return (base
            .withColumn("word_length_milli", share("word_chars", "n_words", 1000))
            .withColumn("symbols_ppm", share("n_symbols", "n_words", 1_000_000))
            .withColumn("dup_lines_ppm", share("n_dup_lines", "n_lines", 1_000_000))
            .withColumn("repeat_words_ppm", share("n_repeat_words", "n_words", 1_000_000))
            .withColumn("base_failed", (F.col("n_words") < BASE_WORDS)
                        | (100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words"))))


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, measure, cell, docs): the sketch of each group and measure."""
    cell = F.expr(f"CASE WHEN value < {1 << BITS} THEN value ELSE "
                  f"shiftleft(shiftright(value, length(bin(value)) - {BITS}), length(bin(value)) - {BITS}) END")
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES]))
    return (rows.where(~F.col("base_failed")).select("lang", "source", values.alias("v")).select("lang", "source", "v.*")
            .groupBy("lang", "source", "measure", cell.alias("cell")).agg(F.count(F.lit(1)).alias("docs")))


def _quartiles(cells: DataFrame, by: list[str], tag: str) -> DataFrame:
    """Group size and quartiles of each (group, measure) out of its sketch."""
    merged = cells.groupBy(*by, "measure", "cell").agg(F.sum("docs").alias("docs"))
    up = Window.partitionBy(*by, "measure").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*by, "measure")
    at = merged.withColumn("_upto", F.sum("docs").over(up)).withColumn("_all", F.sum("docs").over(whole))
    reached = lambda num: F.min(F.when(4 * F.col("_upto") >= num * F.col("_all"), F.col("cell")))
    return at.groupBy(*[F.col(c).alias(f"{tag}_{c}") for c in by], F.col("measure").alias(f"{tag}_measure")).agg(
        F.max("_all").alias(f"{tag}_docs"), reached(1).alias(f"{tag}_q1"), reached(3).alias(f"{tag}_q3"))


def thresholds(cells: DataFrame, spread: int = SPREAD, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per (lang, source): a lower and an upper fence for each measure."""
    fine = _quartiles(cells, ["lang", "source"], "f")
    lang = _quartiles(cells, ["lang"], "l")
    every = _quartiles(cells, [], "e")
    use = lambda q: (F.when(F.col("f_docs") >= min_rows, F.col(f"f_{q}"))
                     .when(F.col("l_docs") >= min_rows, F.col(f"l_{q}")).otherwise(F.col(f"e_{q}")))
    joined = (fine.join(lang, F.col("f_lang").eqNullSafe(F.col("l_lang")) & (F.col("f_measure") == F.col("l_measure")))
              .join(every, F.col("f_measure") == F.col("e_measure"))
              .select("f_lang", "f_source", "f_measure", use("q1").alias("q1"), use("q3").alias("q3")))
    fences = []
    for m, (has_low, slack) in MEASURES.items():
        mine = F.col("f_measure") == m
        wide = spread * (F.col("q3") - F.col("q1")) + slack
        fences.append(F.max(F.when(mine, F.col("q3") + wide)).alias(f"{m}_high"))
        if has_low:
            fences.append(F.max(F.when(mine, F.col("q1") - wide)).alias(f"{m}_low"))
    return joined.groupBy("f_lang", "f_source").agg(*fences)


def judged(docs: DataFrame, spread: int = SPREAD, min_rows: int = MIN_ROWS) -> DataFrame:
    """Each document with its base counts, ``base_failed`` and ``kept``."""
    rows = written(measured(docs), "quality-measures")
    fences = thresholds(sketches(rows), spread, min_rows)
    with_fences = rows.join(fences, F.col("lang").eqNullSafe(F.col("f_lang"))
                            & F.col("source").eqNullSafe(F.col("f_source")), "left")
    passes = ~F.col("base_failed")
    for m, (has_low, _) in MEASURES.items():
        passes = passes & F.coalesce(F.col(m) <= F.col(f"{m}_high"), F.lit(False))
        if has_low:
            passes = passes & F.coalesce(F.col(m) >= F.col(f"{m}_low"), F.lit(False))
    return with_fences.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", passes.alias("kept"), *MEASURES)
