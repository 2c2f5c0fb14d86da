from __future__ import annotations

import random
import re

import pytest

from weir.llm import ngram_join
from weir.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sets_of(rows, size=3):
    out = []
    for doc_id, text in rows:
        w = WORD.findall((text or "").translate({k: k + 32 for k in range(65, 91)}))
        out.append((doc_id, {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()))
    return out


def brute(rows, percent=90, size=3):
    """(doc_id, set size, smallest reachable id) of each row, by comparing all pairs."""
    sets = sets_of(rows, size)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 10 * min(len(a), len(b)) * 10 >= percent * max(len(a), len(b)):
                if 100 * len(a & b) >= percent * len(a | b):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(((d, len(s), least.get(find(i))) for i, (d, s) in enumerate(sets)), key=str)


def joined(df, percent=90, size=3):
    return sorted((tuple(r) for r in ngram_join.join_components(df, size, percent).drop("row").collect()), key=str)


def near_copies(seed, n=250):
    """Groups of near copies at similarities on both sides of the limit, and a common passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    bases = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 120))] for _ in range(4)]
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10_000)}"
        if rng.random() < 0.2:
            words = passage + [rng.choice(vocabulary) for _ in range(rng.randint(0, 20))]
        rows.append((i * 7 % 1_009, " ".join(words)))
    return rows


@pytest.mark.parametrize(("seed", "percent"), [(1, 90), (2, 80), (3, 95)])
def test_components_are_those_of_all_pairs(spark, awkward, seed, percent):
    rows = near_copies(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert joined(df, percent) == brute(rows, percent)


def crowd(seed, n=220):
    """One large group of near copies around a text, strays beside it that share its passages, and exact copies."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 12, 20])):
            words[rng.randrange(len(words))] = f"new{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    return rows + [(1000 + i, rows[3][1].upper()) for i in range(30)] + [(2000 + i, " ".join(base[:25])) for i in range(30)]


@pytest.mark.parametrize(("seed", "percent", "size"), [(4, 90, 3), (5, 80, 5), (6, 60, 2)])
@pytest.mark.parametrize("rounds", [0, 2])
def test_strays_beside_a_large_group(spark, monkeypatch, seed, percent, size, rounds):
    """Stars or none, one n-gram a bucket or many, many blocks or few: the same links."""
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(ngram_join, "BUCKET", 500)
    monkeypatch.setattr(ngram_join, "BLOCK", 700)
    rows = crowd(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert joined(df, percent, size) == brute(rows, percent, size)


def test_awkward_rows(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert joined(awkward) == brute(rows)


def test_empty_table(nothing):
    assert joined(nothing) == []


def test_limit_must_be_a_percentage(awkward):
    with pytest.raises(ValueError, match="percent"):
        ngram_join.join_components(awkward, 3, 0)


def test_the_cheapest_prefix_is_taken(spark):
    """Few long posting lists: one match; many of them: more matches asked for."""
    rows = [("rare", 100, 90, [(2, i) for i in range(1, 12)]), ("common", 100, 90, [(500, i) for i in range(1, 101)])]
    df = spark.createDataFrame(rows, "node string, n int, need long, shared array<struct<df:long,gram:long>>")
    got = {r["node"]: r["m"] for r in df.select("node", ngram_join._matches().alias("m")).collect()}
    assert got["rare"] == 1
    assert got["common"] > 4


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 103: 100}
