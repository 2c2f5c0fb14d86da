"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

1. *Voters.*  Words (a lexicon) and word beginnings (patterns) that occur more
   often in documents labelled toxic become voters: each votes "toxic" on the
   documents that hold it and abstains on the rest.
2. *Label model.*  The true class is latent.  Expectation maximisation
   estimates how often each voter fires in either class, its accuracy; the
   given label is one more voter, of known accuracy, and anchors the class.  Voters that fire together beyond
   what the class explains are correlated, and share one say: each counts by
   the reciprocal of its summed correlations.
3. *Classifier.*  A logistic regression over the presence of many more words and
   beginnings learns the posterior labels, and so reaches documents on which no
   voter fires.

Fitting uses at most ``SAMPLE`` labelled documents, chosen by a hash of the id:
that bounds what is broadcast (their ids) and what comes to the driver (for
each, the numbers of the at most ``FEATURES`` features it holds).  Scoring runs
over whole texts with one table of ``FEATURES`` weights.

Defined cases: null and empty texts hold no feature and get the classifier's
base score; labels that are null or have no document don't count, and of
repeated labels of a document the larger counts; rows repeated under one id
train once; without labels of both kinds every score is 0; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import carried_columns, scored, written
from weir.llm.text import PUNCTUATION, mix, prefix_sums, slices, stretch_hashes, word_spans

#: Labelled documents the model is fitted on, at most.
SAMPLE = 20_000
CANDIDATES = 65_536
FEATURES = 2_048
VOTERS = 256
#: Toxic documents a word or beginning must occur in to be looked at.
LEAST_TOXIC = 4
#: Lengths in bytes of the beginnings.
BEGINNINGS = (4, 5, 6, 7, 8, 9)
THRESHOLD = 0.3
#: Correlation given the class from which voters share one say; less is noise of the sample.
CORRELATED = 0.3
#: How much a toxic document weighs against a clean one in the classifier.
TOXIC_WEIGHT = 2.0
#: Least association with the label (in standard errors) of a feature.
SURE = 4.0
#: How often the given label says toxic of clean and of toxic documents: it anchors the latent class.
GIVEN_RATES = (0.01, 0.95)

Batches = Iterator[pa.RecordBatch]


def _held(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, document) of the words, then of the beginnings of each length."""
    starts, ends, bounds = word_spans(raw, offsets, PUNCTUATION)
    total = prefix_sums(raw)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    yield stretch_hashes(total, starts, ends), of
    for length in BEGINNINGS:
        long = ends - starts > length
        s = starts[long]
        yield mix(stretch_hashes(total, s, s + length) + np.uint64(length)), of[long]


def _wanted(wanted: np.ndarray | None) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Positions of hashes that are among ``wanted`` (sorted), and their ranks there."""
    if wanted is None:
        return lambda h: (np.arange(len(h)), h)
    near = np.zeros(1 << 20, bool)
    near[(wanted >> np.uint64(44)).astype(np.int64)] = True

    def find(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(near[(h >> np.uint64(44)).astype(np.int64)])
        rank = np.searchsorted(wanted, h[at])
        hit = rank < len(wanted)
        hit[hit] = wanted[rank[hit]] == h[at][hit]
        return at[hit], rank[hit]
    return find


def _occurring(wanted: object = None) -> Callable[[Batches], Batches]:
    """(feature, toxic documents, other documents) per batch."""
    def run(batches: Batches) -> Batches:
        among = None if wanted is None else wanted.value
        find = _wanted(among)
        for batch in batches:
            labels = np.array(batch.column("toxic").to_pylist(), np.int64)
            for first, last, raw, offsets in slices(batch.column("text")):
                toxic = labels[first:last]
                for h, of in _held(raw, offsets):
                    at, found = find(h)
                    if not len(at):
                        continue
                    feature = found.astype(np.uint64) if among is None else among[found]
                    pairs = np.unique(np.stack([feature, of[at].astype(np.uint64)]), axis=1)
                    names, inverse = np.unique(pairs[0], return_inverse=True)
                    bad = np.bincount(inverse, toxic[pairs[1].astype(np.int64)], len(names)).astype(np.int64)
                    every = np.bincount(inverse, minlength=len(names))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names.view(np.int64)), pa.array(bad), pa.array(every - bad)], ["feature", "bad", "good"])
    return run


def _present(features: object) -> Callable[[Batches], Batches]:
    """For each document its label and the sorted numbers of the features it holds."""
    def run(batches: Batches) -> Batches:
        find = _wanted(features.value)
        for batch in batches:
            for first, last, raw, offsets in slices(batch.column("text")):
                held = _numbers(raw, offsets, find)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("toxic").slice(first, last - first).cast(pa.int32()),
                     pa.array([h.astype(np.int32).tobytes() for h in held], pa.binary())], ["toxic", "held"])
    return run


def _numbers(raw: np.ndarray, offsets: np.ndarray, find: Callable) -> list[np.ndarray]:
    ranks, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for h, document in _held(raw, offsets):
        at, rank = find(h)
        ranks.append(rank.astype(np.int64))
        of.append(document[at])
    keys = np.unique(np.concatenate(of) * (1 << 32) + np.concatenate(ranks))
    cuts = np.searchsorted(keys, np.arange(len(offsets)) << 32)
    return [keys[a:b] & 0xFFFFFFFF for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def association(bad: np.ndarray, good: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Root of the likelihood-ratio statistic of feature against label, negative where clean ones hold it more often."""
    total, cells = toxic + clean, 0.0
    for held, seen, size in ((bad, bad + good, toxic), (good, bad + good, clean),
                             (toxic - bad, total - bad - good, toxic), (clean - good, total - bad - good, clean)):
        cells = cells + held * np.log(np.maximum(held, 1e-9) / np.maximum(seen * size / total, 1e-9))
    return np.sign(bad * clean - good * toxic) * np.sqrt(2 * np.maximum(cells, 0))


def posteriors(votes: np.ndarray, gold: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The label model over ``votes`` (documents x voters, 0/1) and the given labels.

    Returns each document's probability of being toxic, each voter's rates of
    firing by class (2 x voters) and each voter's say (1: uncorrelated).
    """
    given = np.concatenate([votes, gold[:, None]], axis=1).astype(np.float64)
    p = np.clip(gold.astype(np.float64), 0.02, 0.98)
    for _ in range(rounds):
        weight = np.stack([1 - p, p])
        mass = weight.sum(axis=1)
        rate = (weight @ given + 0.5) / (mass[:, None] + 1)
        rate[:, -1] = GIVEN_RATES
        # what is left of the votes once the class is known, and how it goes together
        together = np.zeros((given.shape[1],) * 2)
        for y in (0, 1):
            rest = (given - rate[y]) * np.sqrt(weight[y])[:, None]
            together += rest.T @ rest
        scale = np.sqrt(np.maximum(np.diag(together), 1e-9))
        tied = together / scale / scale[:, None]
        say = 1 / np.where(tied >= CORRELATED, np.minimum(tied, 1), 0).sum(axis=1).clip(1)
        say[-1] = 1.0
        fires = np.log(rate[1] / rate[0])
        silent = np.log((1 - rate[1]) / (1 - rate[0]))
        logit = np.log(mass[1] / mass[0]) + given @ (say * (fires - silent)) + (say * silent).sum()
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return p, rate[:, :-1], say[:-1]


def logistic(held: list[np.ndarray], goal: np.ndarray, features: int, rounds: int = 600, decay: float = 3e-4) -> np.ndarray:
    """Weights (and the base, last) of a logistic regression on soft labels, by Adam over all rows."""
    sizes = np.array([len(h) for h in held])
    flat = np.concatenate([np.zeros(0, np.int64), *held]).astype(np.int64)
    of = np.repeat(np.arange(len(held)), sizes)
    w, base = np.zeros(features), float(np.log(goal.mean() / (1 - goal.mean())))
    weight = (1 + (TOXIC_WEIGHT - 1) * goal) / len(held)
    m, v = np.zeros(features + 1), np.zeros(features + 1)
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of, w[flat], len(held)) + base, -30, 30)))
        off = (p - goal) * weight
        g = np.append(np.bincount(flat, off[of], features) + decay * w, off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, base = w - move[:-1], base - move[-1]
    return np.append(w, base)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """(sorted feature hashes, weights and base); None without labels of both kinds.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic.
    """
    spark = docs.sparkSession
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `sample` ids
                   .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "toxicity-sample")
    texts = rows.select("text", "toxic")
    many = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not many.get(0) or not many.get(1):
        return None
    kind = "feature long, bad long, good long"
    total = lambda df: df.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    first = (total(texts.where("toxic = 1").mapInArrow(_occurring(), kind)).where(f"bad >= {LEAST_TOXIC}")
             .orderBy(F.desc("bad"), "feature").limit(CANDIDATES).select("feature").toPandas())
    if not len(first):
        return None
    looked = spark.sparkContext.broadcast(np.sort(first["feature"].to_numpy(np.int64).view(np.uint64)))
    seen = total(texts.mapInArrow(_occurring(looked), kind)).toPandas()
    bad, good = seen["bad"].to_numpy(float), seen["good"].to_numpy(float)
    sure = association(bad, good, many[1], many[0])
    names = seen["feature"].to_numpy(np.int64).view(np.uint64)
    best = np.lexsort((names, -sure))[:FEATURES]
    best = best[sure[best] >= SURE]
    best = best[np.argsort(names[best])]
    features = names[best]
    votes_for = np.lexsort((features, -sure[best]))[:VOTERS]
    votes_for = votes_for[bad[best][votes_for] > good[best][votes_for]]  # right more often than wrong

    held = texts.mapInArrow(_present(spark.sparkContext.broadcast(features)), "toxic int, held binary").toPandas()
    numbers = [np.frombuffer(h, np.int32) for h in held["held"]]
    rank = np.full(len(features), -1)
    rank[votes_for] = np.arange(len(votes_for))
    votes = np.zeros((len(numbers), len(votes_for)), np.float32)
    for i, h in enumerate(numbers):
        r = rank[h]
        votes[i, r[r >= 0]] = 1
    p, _, _ = posteriors(votes, held["toxic"].to_numpy())
    return features, logistic(numbers, p, len(features))


def _scorer(model: object) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        fitted = model.value
        find = _wanted(fitted[0]) if fitted else None
        for batch in batches:
            scores = [np.zeros(0)]
            for first, last, raw, offsets in slices(batch.column("text")):
                if fitted is None:
                    scores.append(np.zeros(last - first))
                    continue
                held = _numbers(raw, offsets, find)
                logit = np.array([fitted[1][h].sum() for h in held]) + fitted[1][-1]
                scores.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
            kept, names = carried_columns(batch)
            yield pa.RecordBatch.from_arrays([*kept, pa.array(np.concatenate(scores))], [*names, "score"])
    return run


def score(docs: DataFrame, training: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` as k0, k1, ..., and ``score``: near 1 where label 1 is likelier.

    Learns from the documents of ``training`` (doc_id, text) that ``labels``
    (doc_id, toxic) names.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(training, labels))
    return scored(docs, keep, _scorer(model), "score double")
