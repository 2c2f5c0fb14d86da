"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0..1, piecewise linear.
Its integral is the source's weight; weights share out the whole token budget,
and no source is asked for more than ``cap`` times its own size (the excess is
shared again by weight).  A source's cumulative token demand by time t is its
target times the integral up to t.  The documents of a source, in the order of
a hash, take their tokens one after the other, lap after lap; inverting the
demand at the middle of a document's tokens gives its training position, and a
range sort by position lays the corpus out in training order.

Whole documents are taken: every document of a source gets the whole laps, and
the last, partial lap takes documents in hash order up to the target, so a
source's words miss its target by half a document at most.

Running sums over a source go by pieces (ranges of the hash): sums of pieces
first, then sums inside each piece, so a source with a third of all rows is no
single task's work.

Defined cases: null source is a source of its own, last in order; null and
empty texts have size 0 and are never taken; a null id is the id ``null``;
repeated rows are rows of their own; an empty table, or one without words,
gives targets of 0; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weir.llm.common import id_text, n_words, written

Schedule = Sequence[tuple[float, float]]

#: Weight schedules by turns over the ordered sources, as (time, weight) knots.
#: Their integrals are 5, 2 and 1.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 8.0), (1.0, 2.0)),
    ((0.0, 1.0), (1.0, 3.0)),
    ((0.0, 0.0), (0.5, 1.0), (1.0, 2.0)),
)
#: Laps over a source at most.
CAP = 3
PIECE_DIGITS = 3


def integral(schedule: Schedule) -> float:
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def invert(schedule: Schedule, share: Column) -> Column:
    """The time by which ``share`` (0..1) of the schedule's integral has passed."""
    total, done = integral(schedule), 0.0
    cases, last = None, float(schedule[-1][0])
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        area = (t1 - t0) * (w0 + w1) / 2
        if area > 0:
            left = share * F.lit(total) - F.lit(done)
            slope = (w1 - w0) / (t1 - t0)
            # w0 * x + slope * x^2 / 2 = left, written so that slope 0 is no special case
            x = 2 * left / (F.lit(w0) + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * left, F.lit(0.0))))
            time = F.when(left <= 0, F.lit(float(t0))).otherwise(F.lit(float(t0)) + x)
            inside = share * F.lit(total) <= F.lit(done + area)
            cases = F.when(inside, time) if cases is None else cases.when(inside, time)
        done += area
    return F.least(cases.otherwise(F.lit(last)), F.lit(last))


def targets(sizes: DataFrame, weights: Sequence[float], cap: int = CAP) -> DataFrame:
    """Targets of sources: ``sizes`` has one row (source, source_size) per source.

    Water filling: with sources ordered by cap over weight, those before the
    first that can take its share of what is left are full; the others share
    the rest by weight.  Shares only fall from that first one on, so the level
    is the largest share that fits.  One row per source, never one per document.
    """
    if any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (sizes.withColumn("turn", ((F.row_number().over(by_name) - 1) % len(weights)).cast("int"))
              .withColumn("weight", every[F.col("turn")])
              .withColumn("_full", F.col("source_size").cast("double") * cap)
              .withColumn("_level", F.col("_full") / F.col("weight")))
    order = [F.col("_level"), F.col("source").asc_nulls_last()]
    up = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("_full").over(up), F.lit(0.0))
    return (ranked.withColumn("_share", left / F.sum("weight").over(down))
            .withColumn("_water", F.max(F.when(F.col("_share") <= F.col("_level"), F.col("_share"))).over(whole))
            .select("source", "source_size", "turn",
                    F.least(F.col("_full"), F.coalesce(F.col("_water"), F.lit(0.0)) * F.col("weight")).alias("target")))


def mix(docs: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, cap: int = CAP,
        keep: Sequence[str] = ()) -> DataFrame:
    """Each document with its size, its source's target and the positions it takes.

    Returns doc_id, source, size, source_size, target, ``taken`` (words, repeats
    counted), ``positions`` (one training time per repeat; empty: not taken) and
    the columns ``keep`` as k0, k1, ..., whatever they are called.
    """
    base = docs.select(
        F.col("doc_id"), F.col("source"), n_words(F.col("text")).alias("size"),
        F.md5(id_text(F.col("doc_id"))).alias("_hash"), F.xxhash64("text").alias("_text"),
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)])
    base = base.withColumn("_piece", F.substring("_hash", 1, PIECE_DIGITS))
    if not keep:  # a few numbers a row: cheaper written than counted from the texts twice
        base = written(base, "mixing-sizes")
    pieces = base.groupBy("source", "_piece").agg(F.sum("size").alias("_words"))
    goal = targets(pieces.groupBy("source").agg(F.sum("_words").alias("source_size")),
                   [integral(s) for s in schedules], cap)
    before = Window.partitionBy("source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(F.col("source").alias("_s"), F.col("_piece").alias("_p"),
                           F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_before"))
    goal = goal.withColumnRenamed("source", "_g")
    starts = (pieces.join(goal, F.col("_s").eqNullSafe(F.col("_g"))).drop("_g"))

    inside = (Window.partitionBy("source", "_piece").orderBy("_hash", "doc_id", "size", "_text")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = base.withColumn("_run", F.sum("size").over(inside))
    rows = run.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_piece") == F.col("_p")))
    middle = (F.col("_before") + F.col("_run") - F.col("size")).cast("double") + F.col("size") / F.lit(2.0)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    part = F.col("target") - F.col("_laps") * F.col("source_size")
    laps = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.col("_laps") + F.when(F.col("_middle") < part, 1).otherwise(0)).cast("int")
    rows = (rows.withColumn("_middle", middle).withColumn("_laps", whole)
            .withColumn("_times", laps))

    def position(lap: Column) -> Column:
        share = F.least((lap * F.col("source_size") + F.col("_middle")) / F.col("target"), F.lit(1.0))
        by_turn = None
        for turn, schedule in enumerate(schedules):
            time = invert(schedule, share)
            by_turn = F.when(F.col("turn") == turn, time) if by_turn is None else by_turn.when(F.col("turn") == turn, time)
        return by_turn

    spots = F.when(F.col("_times") > 0, F.transform(F.sequence(F.lit(0), F.col("_times") - 1), position)).otherwise(
        F.array().cast("array<double>"))
    return rows.select(
        "doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (F.col("_times") * F.col("size")).cast("long").alias("taken"), spots.alias("positions"),
        *[f"k{i}" for i in range(len(keep))])


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row per repeat, range-sorted by ``position``: the training order."""
    placed = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return placed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
