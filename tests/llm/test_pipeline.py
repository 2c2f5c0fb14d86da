from __future__ import annotations

import hashlib
import random

import corpus_pipeline as pipeline
import pytest
from pyspark.sql import functions as F
from weir.llm import language, mixing, ngram_join, toxicity
from weir.llm.common import table, written
from weir.llm.queries import QUERIES, vocabulary_path

SF = "/root/testdata/sf0.01"


def rows_of(df):
    return sorted((str(tuple(r)) for r in df.collect()))


def test_stages_are_the_operators_decisions(spark):
    """Each stage over what the one before kept, against the operator's own verdicts."""
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    columns = docs.columns
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    kept = written(pipeline.toxicity_stage(spark, docs, SF), "t")
    assert kept.columns == columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, p in scores.items() if not p}

    told = {r["k0"]: (r["lang_pred"], r["fit"]) for r in language.identify(kept, kept.where(~language.held_out()), ["doc_id"]).collect()}
    known = written(pipeline.language_stage(spark, kept, SF), "t")
    assert known.columns == columns
    assert {r["doc_id"] for r in known.select("doc_id").collect()} == {i for i, (p, s) in told.items() if p != "und" and s >= pipeline.LEAST_FIT}

    groups = {r["doc_id"]: r["component_id"] for r in ngram_join.join_components(known).collect()}
    single = written(pipeline.near_duplicate_stage(spark, known, SF), "t")
    assert single.columns == columns
    ids = [r["doc_id"] for r in single.select("doc_id").collect()]
    assert sorted(ids) == sorted(set(groups.values()))

    taken = {r["doc_id"]: len(r["positions"]) for r in mixing.mix(single).collect()}
    mixed = written(pipeline.mixing_stage(spark, single, SF), "t")
    assert mixed.columns == columns
    found = [r["doc_id"] for r in mixed.select("doc_id").collect()]
    assert sorted(found) == sorted(i for i, n in taken.items() for _ in range(n))

    library = Tokenizer.from_file(vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    last = sorted(pipeline.bpe_stage(spark, mixed, SF).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in last] == list(range(len(found)))
    for r in last[::20]:
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(r["ids"], skip_special_tokens=False).encode()).hexdigest()
    placed = mixing.mix(single).select("doc_id", F.explode("positions").alias("at")).orderBy("at", "doc_id").collect()
    assert [r["doc_id"] for r in last] == [r["doc_id"] for r in placed]


def test_garbled_and_unlearned_texts_go(spark):
    """Texts in no learned language go although the posterior of some language is near 1; clean ones stay."""
    rng = random.Random(4)
    docs = table(spark, SF, "documents")
    letters = "abcdefghijklmnopqrstuvwxyz   "
    garbled = [(10**9 + i, "".join(rng.choice(letters) for _ in range(n)), None, "x", n) for i, n in enumerate([60, 200, 1000, 9000] * 3)]
    garbled += [(2 * 10**9, "Съешь ещё этих мягких французских булок " * 4, None, "x", 160), (2 * 10**9 + 1, "123 !!", None, "x", 6)]
    every = docs.unionByName(spark.createDataFrame(garbled, docs.schema))
    kept = {r["doc_id"] for r in pipeline.language_stage(spark, every, SF).select("doc_id").collect()}
    assert not kept & {r[0] for r in garbled}
    clean = {r["doc_id"] for r in table(spark, SF, "labels").where("quality = 1").select("doc_id").collect()}
    there = {r["doc_id"] for r in docs.where("text rlike '[A-Za-z]'").select("doc_id").collect()}
    assert clean & there <= kept


def test_ties_of_the_mix_and_of_repeated_rows(spark):
    """The texts that are taken, and the columns of the row that stays, don't depend on the order of the input."""
    rows = [(5, f"text {i} {'x ' * 30}", "en", "s", i) for i in range(6)] + [(6, "same text of some words here", lang, src, 3) for lang in "cab" for src in "zy"]
    rows += [(100 + i, f"filler {i} " * 20, "en", "t", 1) for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def found(order):
        df = spark.createDataFrame(order, schema).repartition(3)
        mixed = sorted(str(tuple(r)) for r in pipeline.mixing_stage(spark, df, SF).collect())
        return mixed, rows_of(pipeline.near_duplicate_stage(spark, df, SF))

    first = found(rows)
    assert found(rows[::-1]) == first
    assert str((6, "same text of some words here", "a", "y", 3)) in first[1]


def test_awkward_rows_and_nothing(spark, awkward, nothing, monkeypatch):
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100, 160)], "doc_id long, toxic int")
    monkeypatch.setattr(pipeline, "table", lambda *a: labels)
    for start in (awkward, nothing):
        docs = start
        for name, stage in pipeline.STAGES:
            before = docs.count()
            docs = written(stage(spark, docs, SF), "t")
            if name in ("toxicity", "language_id", "ngram_join"):
                assert docs.count() <= before
            if name != "bpe":
                assert docs.schema.names == start.schema.names
    assert docs.count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "a b c d e"), (3, ""), (4, None), (None, "a b c d e"), (None, "x y z"), (5, "other words here")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = rows_of(pipeline.near_duplicate_stage(spark, df, SF).select("doc_id", "text"))
    assert got == sorted(map(str, [(1, "a b c d e"), (3, ""), (4, None), (None, "x y z"), (5, "other words here")]))


def changed(words, places):
    return " ".join(f"new{i}" if i in places else w for i, w in enumerate(words))


def test_near_copies_of_five_words_at_four_fifths_go(spark):
    """The stage against all pairs of five-word sets, with copies on both sides of 0.8."""
    rng = random.Random(8)
    rows = []
    for base, (size, most) in enumerate([(300, 9), (50, 3), (120, 6)]):
        words = [f"b{base}w{i}" for i in range(size)]
        rows += [(1000 * base, " ".join(words), base)]
        rows += [(1000 * base + n, changed(words, set(rng.sample(range(5, size - 5), n))), base) for n in range(1, most)]
    lone = [f"l{i}" for i in range(300)]
    rows += [(5000, " ".join(lone), 5), (5001, changed(lone, {20, 60, 100, 140, 180, 220}), 5)]  # 266 / 326
    half = [f"h{i}" for i in range(50)]
    rows += [(6000, " ".join(half), 6), (6001, changed(half, {25}), 6)]  # 41 / 51
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long")

    grams = {i: {tuple(w[k:k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t, _ in rows)}
    least = {i: i for i in grams}
    for _ in grams:
        for a in grams:
            for b in grams:
                if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                    least[a] = min(least[a], least[b])
    got = sorted(r["doc_id"] for r in pipeline.near_duplicate_stage(spark, df, SF).select("doc_id").collect())
    assert got == sorted(set(least.values()))
    assert not {5001, 6001} & set(got)


def test_one_row_stays_without_ids_and_of_an_id_with_several_texts(spark):
    words = [f"w{i}" for i in range(100)]
    others = [f"o{i}" for i in range(100)]
    rows = [(None, changed(words, {n})) for n in (10, 40, 70)] + [(7, changed(others, {n})) for n in (20, 50)] + [(9, " ".join(others)), (None, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"][:1]) for r in pipeline.near_duplicate_stage(spark, df, SF).select("doc_id", "text").collect()]
    assert sorted(got, key=str) == sorted([(None, "w"), (7, "o"), (None, "")], key=str)


def test_stage_names():
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "language_id", "ngram_join", "mixing", "bpe"]
    assert toxicity.THRESHOLD == pytest.approx(0.3)
