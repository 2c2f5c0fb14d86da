from __future__ import annotations

import hashlib
import random
import string
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.llm import exact, trie, whitening
from weir.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, x string, n string, component int, i int"


# --- whitening ------------------------------------------------------------------------

def turned(values, seed=1):
    """A symmetric matrix with these eigenvalues."""
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    a = (q * np.array(values)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 64, 64), [10, 10 + 1e-6, 9.9999, 5, 5, 5, *np.linspace(0.1, 1, 40)], np.ones(20), [3, 3, 3, 3, *np.zeros(30)],
    np.geomspace(1, 1e-12, 40), [1e6, *(1 + 1e-7 * np.arange(40))], np.zeros(4), [7.0]])
def test_eigenvectors_to_double_precision(values):
    a = turned(values)
    found, vectors = whitening.eigen(a)
    size = max(np.abs(a).max(), 1e-300)
    assert np.abs(found - np.sort(np.linalg.eigvalsh(a))[::-1]).max() <= 1e-14 * size * len(a)
    assert np.abs(a @ vectors - vectors * found).max() <= 1e-14 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(a))).max() <= 1e-15 * len(a)


def test_clustered_eigenvectors_beat_single_precision():
    """Vectors of values that float32 can't tell apart are each right, not only their span."""
    a = turned([2, 2 - 1e-9, 2 - 2e-9, *np.linspace(0.1, 1, 30)])
    _, vectors = whitening.eigen(a)
    _, plain = np.linalg.eigh(a)
    _, single = np.linalg.eigh(a.astype(np.float32))
    match = lambda x: min(abs(float(plain[:, -1 - i] @ x[:, i])) for i in range(3))
    assert match(vectors) > 1 - 1e-10
    assert match(single[:, ::-1].astype(float)) < 1 - 1e-6


def brute_whitened(rows, k):
    """{vec_id: [(component, deviation, whitened, explained)]} by exact sums and the plain solver."""
    fine = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    listed = np.array(sorted({tuple(x) for _, x in fine}))
    n, sums = len(listed), listed.sum(axis=0)
    centred = listed - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    trace = (centred ** 2).sum() / n
    return n, {i: [(c + 1, int(((n * x - sums) ** 2).sum()), float((x - sums / n) @ vectors[:, c] / np.sqrt(values[c])), values[c] / trace)
                   for c in range(k)] for i, x in fine}


def test_whitening_against_the_plain_solver(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 6)) * [3, 2.5, 2, 1, 0.5, 0.1] @ np.linalg.qr(rng.standard_normal((6, 6)))[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[7][1]) for i in range(400)]  # one vector holds more than half of all rows
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] + [0.0] * 5), (2003, [float("inf")] + [0.0] * 5),
             (2004, [1.0, 2.0]), (2005, []), (2006, [-0.0] * 6)]
    df = spark.createDataFrame([(i, v, None, "a", "b", 1, 2) for i, v in rows], VECTORS).repartition(5)
    n, want = brute_whitened([r for r in rows if r[0] not in (2004, 2005)], 4)
    got = defaultdict(list)
    for r in whitening.whiten(df).collect():
        assert r["n"] == n and r["identity_error"] < 1e-9
        got[r["vec_id"]].append((r["component"], r["deviation"], r["whitened"], r["explained"]))
    assert sorted(got) == sorted(want) and len(got) == 701
    signs = {c: np.sign(w) * np.sign(x) for (c, _, w, _), (_, _, x, _) in zip(sorted(got[3]), want[3], strict=True)}
    for i, rows_ in got.items():
        for (c, dev, w, part), (c2, dev2, w2, part2) in zip(sorted(rows_), want[i], strict=True):
            assert (c, dev) == (c2, dev2)
            assert w * signs[c] == pytest.approx(w2, abs=1e-9) and part == pytest.approx(part2, rel=1e-9)


def test_whitening_of_nothing_and_extremes(spark):
    make = lambda rows: spark.createDataFrame([(i, v, None, "a", "b", 1, 2) for i, v in rows], VECTORS)
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitening.whiten(make(rows))
        assert found.collect() == [] and found.columns[:3] == ["vec_id", "component", "n"]
    line = whitening.whiten(make([(i, [float(i), 0.0]) for i in range(5)] + [(None, [9.0, 0.0])])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 6  # the other has no variance
    huge = whitening.whiten(make([(1, [1e308, 0.0]), (2, [-1e308, 0.0]), (3, [0.0, 0.001])])).collect()
    assert {r["vec_id"]: r["deviation"] for r in huge} == {1: None, 2: None, 3: 1} and all(np.isfinite(r["whitened"]) for r in huge)


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, want = brute_whitened(rows, 4)
    got = QUERIES["op11_whitening"](spark, SF).collect()
    assert len(got) == 4 * len(want)
    for r in got:
        _, deviation, value, part = want[r["vec_id"]][r["component"] - 1]
        assert (r["n"], r["deviation"]) == (n, deviation) and abs(r["whitened"]) == pytest.approx(abs(value), abs=1e-8)
        assert r["explained"] == pytest.approx(part, rel=1e-8) and r["identity_error"] < 1e-8


# --- exact duplicates -------------------------------------------------------------------

def brute_duplicates(rows):
    fold = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(fold)].append(i)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[-1], len(ids), at == len(ids) - 1, sha) for at, i in enumerate(ids)]
    return sorted(out, key=str)


KEYS = {"hash": F.xxhash64, "few": lambda t: F.xxhash64(F.substring(t, 1, 1)), "one": lambda t: F.octet_length(t).cast("long") * 0 - 5}


@pytest.mark.parametrize("key", sorted(KEYS))
@pytest.mark.parametrize("capacity", [1, 3, 4096])
def test_duplicates_with_any_hash(spark, awkward, key, capacity):
    """Hashes that collide, all of them even, and buckets of any size leave the result alone."""
    rows = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    docs = awkward.unionByName(awkward.where("doc_id = 6").withColumn("doc_id", F.lit(77).cast("long")))
    docs = docs.unionByName(spark.createDataFrame([(500 + i, t) for i, t in enumerate(["ÉTÉ", "été", "Éte", "ABC", "abc", "aBC"])],
                                                  "doc_id long, text string"), allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = exact.duplicates(docs, capacity, KEYS[key]).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_duplicates(rows)


def test_duplicates_of_nothing_and_a_hot_group(spark, nothing):
    assert exact.duplicates(nothing).collect() == []
    rows = [(i, "Copy" if i % 3 else f"own text {i}") for i in range(3000)] + [(1, "cOPY")] * 50
    got = exact.duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_duplicates(rows)


def test_directory_splits_what_is_overfull(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("key"))
    index = exact.directory(keys, 100)
    rows = index.select("bucket", "depth", "entries").distinct().collect()
    assert sum(r["entries"] for r in rows) == 20_000 and max(r["entries"] for r in rows) <= 100
    for r in rows:  # none was split without need: its sibling and it together are too many
        width = 2 ** (exact.MAX_DEPTH - r["depth"])
        pair = r["bucket"] - r["bucket"] % (2 * width)
        assert sum(q["entries"] for q in rows if pair <= q["bucket"] < pair + 2 * width) > 100
    assert [(r["depth"], r["entries"]) for r in exact.directory(keys.limit(50), 100).select("depth", "entries").distinct().collect()] == [(0, 50)]


# --- conversations ----------------------------------------------------------------------

def brute_trie(rows):
    whole = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            whole[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in whole.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, cs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        kids = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(len(o) == len(m) + 1 and o[:len(m)] == m for o in members)]
        saved = sum((len(members[m]) - 1) * (len(m[-1][1].encode()) if m else 0) for m in below)
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(cs), len(node), min(members[node[:-1]]) if node else None, len(cs), len(kids), len(leaves), saved, sha))
    return sorted(out, key=str)


CONVERSATIONS = "conv_id long, turn long, role string, text string, x1 string, depth string, bytes string, a string, base string"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], CONVERSATIONS)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(df):
    return sorted((tuple(r) for r in trie.prefix_trie(df).select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_trie_against_brute_force(spark, seed):
    rng = random.Random(seed)
    said = ["a", "b", "été", "", None, "x" * 3000]
    rows = []
    for c in [*range(-12, 60), 10**12, 10**12 + 3]:
        if rng.random() < 0.15:
            continue
        turns = list(range(rng.choice([1, 2, 5, 9, 14])))
        if rng.random() < 0.3:
            turns[0] = None
        rows += [(c, t, rng.choice(["user", "assistant", None]), "hello" if not t else rng.choice(said)) for t in turns]
    rows += [(None, 0, "user", "nobody's")]
    rng.shuffle(rows)
    assert trie_rows(conversations(spark, rows).repartition(6)) == brute_trie(rows)


def test_trie_of_ties_and_repeats(spark):
    """Ties in turn have one order, whatever the order of the input; repeated rows are turns each."""
    rows = [(c, t, "user", f"text {k}") for c in (0, 3, 8) for t in (0, 0, 1) for k in (1, 2)] * 2
    found = trie_rows(conversations(spark, rows))
    random.Random(1).shuffle(rows)
    assert trie_rows(conversations(spark, rows).repartition(5)) == found
    assert max(r[1] for r in found) == 12


def test_trie_of_nothing_long_and_identical(spark):
    assert trie_rows(conversations(spark, [])) == []
    long = [(0, t, "user", f"turn {t}") for t in range(400)]
    assert trie_rows(conversations(spark, long).repartition(4)) == brute_trie(long)
    same = [(c, t, "user", "same") for c in range(0, 3000, 5) for t in range(2)] + [(1, 0, "user", "same")]
    assert trie_rows(conversations(spark, same).repartition(4)) == brute_trie(same)
