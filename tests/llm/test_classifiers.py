from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weir.llm import language, toxicity
from weir.llm.common import BATCH_BYTES, ready
from weir.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


# --- language -------------------------------------------------------------------------

def test_held_out_languages(spark):
    got = QUERIES["op6_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert len(got) == 1000
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def grams_of(text):
    x = [ord(c) for c in "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)]
    out = []
    for n in (1, 2, 3):
        for i in range(len(x) - n + 1):
            key = 0
            for k in range(n):
                key = (key * 0x01000193 + x[i + k] + k + 1) & 0xFFFFFFFF
            out.append((((key ^ (key >> 15)) * 0x9E3779B1) & 0xFFFFFFFF) >> (32 - language.HASH_BITS))
    return out


def test_scores_are_those_of_naive_bayes(spark):
    train = [("the cat sat on the mat", "en"), ("the dog and the fox", "en"), ("le chat est là", "fr"), ("où est la forêt", "fr"), ("nothing", None)]
    asked = [(1, "the forest"), (2, "la forêt"), (3, None), (4, "12 34"), (5, ""), (6, "Été chat")]
    docs = spark.createDataFrame(asked, "doc_id long, text string")
    got = {r["k0"]: (r["lang_pred"], r["score"]) for r in language.identify(
        docs, spark.createDataFrame(train, "text string, lang string"), ["doc_id"]).collect()}
    logs = {}
    for label in ("en", "fr"):
        counts = np.full(language.CELLS, language.SMOOTHING)
        for text, lang in train:
            if lang == label:
                np.add.at(counts, grams_of(text), 1)
        logs[label] = np.log(counts / counts.sum())
    for i, text in asked:
        if not text or not any(c.isalpha() for c in text):
            assert got[i] == ("und", 0.0)
            continue
        total = {k: v[grams_of(text)].sum() + np.log(0.5) for k, v in logs.items()}
        best = max(total, key=total.get)
        assert got[i][0] == best
        assert got[i][1] == pytest.approx(1 / sum(np.exp(v - total[best]) for v in total.values()))


def test_languages_of_awkward_rows(awkward, nothing):
    found = language.identify(awkward, awkward.where(~language.held_out()), ["doc_id", "lang_pred", "score"])
    rows = found.select(F.col("k0").alias("doc_id"), F.col("k1"), found["lang_pred"], found["score"]).collect()
    assert len(rows) == awkward.count()
    assert all(r["k1"] in ("x", None) and 0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} >= {1, 2, 3, None}
    assert language.identify(nothing, nothing, ["doc_id"]).collect() == []
    unlearned = language.identify(awkward, nothing, ["doc_id"]).collect()
    assert {(r["lang_pred"], r["score"]) for r in unlearned} == {("und", 0.0)}


def test_scoring_holds_little_beside_a_batch():
    """What the scorer holds follows the slice and the longest document, not the batch."""
    texts = [f"some words of text number {i} " * 100 for i in range(1_500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    model = type("Model", (), {"value": np.zeros((2, language.CELLS + 3))})
    run = language._scorer(["a", "b"], model)
    list(run(iter([batch.slice(0, 5)])))  # tables that stay
    tracemalloc.start()
    try:
        list(run(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()


def test_batches_are_bounded_in_bytes(spark):
    """Tasks get about BATCH_BYTES at a time, however long the texts are."""
    ready(spark)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    docs = spark.range(0, 64, 1, 1).selectExpr("repeat('text ', 20000) text")
    found = docs.mapInArrow(sizes, "n long, size long").collect()
    assert sum(r["n"] for r in found) == 64
    assert max(r["size"] for r in found) <= BATCH_BYTES + 110_000


def test_too_many_labels_are_refused(spark):
    docs = spark.range(language.MAX_LABELS + 1).select(F.col("id").cast("string").alias("lang"), F.lit("text").alias("text"))
    with pytest.raises(ValueError, match="labels"):
        language.train(docs)


# --- toxicity -------------------------------------------------------------------------

def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op4_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in got if r["toxic"]]
    clean = [r["predicted"] for r in got if not r["toxic"]]
    assert sum(toxic) >= 0.8 * len(toxic)
    assert sum(clean) <= 0.02 * len(clean)


def test_label_model_finds_accuracies_and_ties():
    rng = np.random.default_rng(3)
    true = rng.random(4000) < 0.2
    fires = lambda hit, miss: np.where(true, rng.random(4000) < hit, rng.random(4000) < miss)
    first = fires(0.7, 0.02)
    votes = np.stack([first, first, fires(0.6, 0.05), fires(0.3, 0.01)], axis=1).astype(np.float32)
    gold = fires(*reversed(toxicity.GIVEN_RATES))  # labels as fallible as the model takes them to be
    p, rates, say = toxicity.posteriors(votes, gold)
    assert np.allclose(rates[1], [0.7, 0.7, 0.6, 0.3], atol=0.06)
    assert np.allclose(rates[0], [0.02, 0.02, 0.05, 0.01], atol=0.03)
    assert say[0] == pytest.approx(0.5, abs=0.05) and say[2] == pytest.approx(1, abs=0.1)
    assert ((p > 0.5) == true).mean() >= (gold == true).mean()


def features_of(text):
    """Words of a text, and their beginnings, by name."""
    words, word = set(), b""
    for byte in (text or "").lower().encode() + b" ":
        if byte >= 128 or chr(byte).isalnum():
            word += bytes([byte])
        elif word:
            words.add(word)
            word = b""
    return {("word", w) for w in words} | {(n, w[:n]) for w in words for n in toxicity.BEGINNINGS if len(w) > n}


def scores_by_force(texts, labels):
    """All of operator 4 in plain loops over named features: selection, label model, classifier, scores."""
    held = {i: features_of(t) for i, t in texts.items()}
    fitted = sorted(i for i in labels if i in texts)
    gold = [labels[i] for i in fitted]
    toxic, clean = sum(gold), len(gold) - sum(gold)
    bad, every = {}, {}
    for i, y in zip(fitted, gold, strict=True):
        for f in held[i]:
            every[f] = every.get(f, 0) + 1
            bad[f] = bad.get(f, 0) + y

    def sure(f):
        b, g, n = bad[f], every[f] - bad[f], toxic + clean
        cells = [(b, every[f] * toxic / n), (g, every[f] * clean / n),
                 (toxic - b, (n - every[f]) * toxic / n), (clean - g, (n - every[f]) * clean / n)]
        ratio = 2 * sum(x * np.log(x / e) for x, e in cells if x)
        return np.sign(b * clean - g * toxic) * np.sqrt(max(ratio, 0))

    chosen = sorted((f for f in every if bad[f] >= toxicity.LEAST_TOXIC and sure(f) >= toxicity.SURE), key=str)
    voters = [f for f in chosen if bad[f] > every[f] - bad[f]]
    assert 3 < len(voters) <= toxicity.VOTERS and len(chosen) <= toxicity.FEATURES
    votes = [[float(f in held[i]) for f in voters] + [float(y)] for i, y in zip(fitted, gold, strict=True)]
    p = [min(max(y, 0.02), 0.98) for y in gold]
    for _ in range(20):
        mass = [sum(1 - q for q in p), sum(p)]
        rate = [[(sum(v[k] * w for v, w in zip(votes, side, strict=True)) + 0.5) / (mass[y] + 1) for k in range(len(voters))]
                + [toxicity.GIVEN_RATES[y]] for y, side in ((0, [1 - q for q in p]), (1, p))]
        rest = [[(v[k] - rate[y][k]) * (w ** 0.5) for v, q in zip(votes, p, strict=True) for y, w in ((0, 1 - q), (1, q))]
                for k in range(len(voters) + 1)]
        size = [max(sum(x * x for x in r), 1e-9) ** 0.5 for r in rest]
        say = []
        for k, a in enumerate(rest):
            tied = [sum(x * y for x, y in zip(a, b, strict=True)) / size[k] / size[j] for j, b in enumerate(rest)]
            say.append(1 / max(1.0, sum(min(t, 1) for t in tied if t >= toxicity.CORRELATED)))
        say[-1] = 1.0
        p = []
        for v in votes:
            logit = np.log(mass[1] / mass[0])
            for k, x in enumerate(v):
                logit += say[k] * np.log(rate[1][k] / rate[0][k] if x else (1 - rate[1][k]) / (1 - rate[0][k]))
            p.append(1 / (1 + np.exp(-min(max(logit, -30), 30))))
    weight, base = dict.fromkeys(chosen, 0.0), float(np.log(np.mean(p) / (1 - np.mean(p))))
    present = [[f for f in chosen if f in held[i]] for i in fitted]
    m, v = dict.fromkeys([*chosen, None], 0.0), dict.fromkeys([*chosen, None], 0.0)
    for step in range(1, 601):
        g = {f: 3e-4 * weight[f] for f in chosen} | {None: 0.0}
        for fs, goal in zip(present, p, strict=True):
            off = (1 / (1 + np.exp(-sum(weight[f] for f in fs) - base)) - goal) * (1 + (toxicity.TOXIC_WEIGHT - 1) * goal) / len(p)
            for f in [*fs, None]:
                g[f] += off
        for f in g:
            m[f], v[f] = 0.9 * m[f] + 0.1 * g[f], 0.99 * v[f] + 0.01 * g[f] ** 2
            move = 0.1 * (m[f] / (1 - 0.9 ** step)) / ((v[f] / (1 - 0.99 ** step)) ** 0.5 + 1e-8)
            if f is None:
                base -= move
            else:
                weight[f] -= move
    return {i: 1 / (1 + np.exp(-sum(weight[f] for f in chosen if f in held[i]) - base)) for i in texts}


def test_scores_equal_brute_force(spark):
    rng = random.Random(8)
    plain = [f"ab{chr(97 + i)}" for i in range(26)] + ["größe", "ÜBER", "日本", "x-y"]
    texts, labels = {0: None, 1: "", 2: "GRUMBLE, vile!"}, {}
    for i in range(3, 180):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(12)]
        for word, hit, miss in (("grumble", 0.7, 0.02), ("vile", 0.5, 0.02), ("Pestilent", 0.4, 0.0), ("mean1", 0.5, 0.1)):
            if rng.random() < (hit if toxic else miss):
                words.insert(rng.randrange(12), word)
        texts[i] = " ".join(words)
        if i < 160:
            labels[i] = int(toxic) if rng.random() < 0.97 else int(not toxic)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = toxicity.score(docs, docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), ["doc_id"]).collect()
    expected = scores_by_force(texts, labels)
    assert len(found) == len(texts)
    assert {r["k0"]: r["score"] for r in found} == pytest.approx(expected, abs=1e-5)


def test_the_label_model_mends_wrong_labels():
    """A classifier of the posteriors errs less than one of the labels, where many toxic documents were labelled clean."""
    rng = np.random.default_rng(11)
    true = rng.random(3000) < 0.25
    votes = np.stack([np.where(true, rng.random(3000) < 0.6, rng.random(3000) < 0.02) for _ in range(6)], axis=1)
    gold = (true & (rng.random(3000) < 0.6)).astype(int)
    held = [np.flatnonzero(v) for v in votes]
    p, _, _ = toxicity.posteriors(votes.astype(np.float32), gold)

    def error(goal):
        w = toxicity.logistic(held, goal, 6)
        score = 1 / (1 + np.exp(-(votes @ w[:-1] + w[-1])))
        return -np.mean(np.log(np.where(true, score, 1 - score).clip(1e-9)))

    assert error(p) < 0.9 * error(gold.astype(float))


def test_classifier_reaches_beyond_the_voters(spark):
    """A beginning shared by many rare words is learned, so a word never seen before is caught."""
    rng = random.Random(4)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 5 == 0
        words = [rng.choice(plain) for _ in range(30)]
        if toxic:
            words[rng.randrange(30)] = f"grumble{rng.randrange(10_000)}"
            words[rng.randrange(30)] = f"grumble{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(9_001, " ".join([*rng.sample(plain, 20), "grumblenew", "grumbleother"])), (9_002, " ".join(rng.sample(plain, 22)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = toxicity.score(docs, docs, spark.createDataFrame(labels, "doc_id long, toxic int"), ["doc_id"])
    got = {r["k0"]: r["score"] for r in found.collect()}
    assert got[9_001] > 0.9 and got[9_002] < 0.1


def test_toxicity_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100, 160)] + [(6, None), (None, 1), (77_777, 1), (110, 1)],
                                   "doc_id long, toxic int")
    rows = toxicity.score(awkward, awkward, labels, ["doc_id", "score"]).collect()
    assert len(rows) == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["k1"] in ("x", None) for r in rows)
    assert toxicity.score(nothing, awkward, labels, ["doc_id"]).collect() == []
    one_kind = toxicity.score(awkward, awkward, labels.where("toxic = 1"), ["doc_id"]).collect()
    assert {r["score"] for r in one_kind} == {0.0}
