from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from weir.llm import mixing, oracle, quality, sharding
from weir.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def same(df, sql):
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    want = con.execute(sql)
    names = [c[0] for c in want.description]
    clean = lambda v: round(v, 9) if isinstance(v, float) else v
    rows = lambda found, cols: sorted([tuple(clean(r[cols.index(c)]) for c in sorted(cols)) for r in found], key=str)
    assert sorted(df.columns) == sorted(names)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(want.fetchall(), names)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_oracle(spark, name):
    same(QUERIES[name](spark, SF), oracle.SQL[name])


# --- mixing -------------------------------------------------------------------------

def filled(sizes, weights, cap):
    """Targets by sharing again and again, as the contract words it."""
    target, full, left = dict.fromkeys(sizes, 0.0), set(), float(sum(sizes.values()))
    while True:
        open_ = [s for s in sizes if s not in full]
        share = left / sum(weights[s] for s in open_) if open_ else 0
        over = [s for s in open_ if share * weights[s] > cap * sizes[s]]
        if not over:
            return target | {s: share * weights[s] for s in open_}
        for s in over:
            full.add(s)
            target[s] = float(cap * sizes[s])
            left -= target[s]


def test_mix_of_awkward_rows(awkward):
    rows = [r.asDict() for r in mixing.mix(awkward).collect()]
    assert len(rows) == awkward.count()
    sizes = defaultdict(int)
    for r in awkward.select("source", "text").collect():
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5.0, 2.0, 1.0)[i % 3] for i, s in enumerate(order)}
    want = filled(dict(sizes), weights, 3)
    taken = defaultdict(int)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == len(r["positions"]) * r["size"] <= 3 * r["size"]
        assert all(0 <= p <= 1 for p in r["positions"]) and r["positions"] == sorted(r["positions"])
        taken[r["source"]] += r["taken"]
    longest = max(r["size"] for r in rows)
    for s, n in taken.items():
        assert abs(n - want[s]) <= longest / 2 + 1
    again = [r.asDict() for r in mixing.mix(awkward.repartition(3)).collect()]
    key = lambda r: str(sorted(r.items(), key=str))
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_mix_of_nothing(nothing):
    assert mixing.mix(nothing).collect() == []


def test_training_order_follows_the_schedules(spark):
    """Early on, the source whose weight falls is ahead; later the ones whose weights rise."""
    docs = spark.createDataFrame([(i, "w " * 20, "abc"[i % 3]) for i in range(3000)], "doc_id long, text string, source string")
    placed = mixing.in_training_order(mixing.mix(docs)).select("source", "position").collect()
    assert [r["position"] for r in placed] == sorted(r["position"] for r in placed)
    early = Counter(r["source"] for r in placed if r["position"] < 0.2)
    late = Counter(r["source"] for r in placed if r["position"] > 0.8)
    assert early["a"] / early["c"] > 4 * late["a"] / late["c"]
    assert late["b"] > early["b"]


def test_inverse_of_an_integral(spark):
    for schedule in mixing.SCHEDULES:
        got = spark.range(101).select((F.col("id") / 100).alias("x"), mixing.invert(schedule, F.col("id") / 100).alias("t")).collect()
        total = mixing.integral(schedule)
        for x, t in got:
            cut = [k for k in schedule if k[0] < t] + [(t, next(
                w0 + (w1 - w0) * (t - t0) / (t1 - t0) for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False) if t0 <= t <= t1))]
            assert mixing.integral(cut) / total == pytest.approx(x, abs=1e-9)


# --- sharding -----------------------------------------------------------------------

def test_shards_of_awkward_rows(awkward):
    rows = [r.asDict() for r in sharding.shard(awkward, 7).collect()]
    assert len(rows) == awkward.count()
    texts = Counter((r["doc_id"], zlib.crc32((r["text"] or "").encode()), len((r["text"] or "").encode()) + 16)
                    for r in awkward.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["text_crc32"], r["size"]) for r in rows) == texts
    slots, home = defaultdict(list), {}
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        assert home.setdefault(r["doc_id"], r["shard"]) == r["shard"]
        assert r["grown_shard"] in (r["shard"], 7)
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))


def test_growing_step_by_step_moves_little(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    got = keys.select(*[c.alias(f"n{n}") for n, c in zip(range(1, 12), sharding.jump(F.col("key"), list(range(1, 12))), strict=True)]).collect()
    for n in range(1, 11):
        moved = [r[f"n{n + 1}"] for r in got if r[f"n{n + 1}"] != r[f"n{n}"]]
        assert set(moved) == {n}
        assert abs(len(moved) - 20_000 / (n + 1)) < 500


def test_shards_of_nothing(nothing):
    assert sharding.shard(nothing).collect() == []
    with pytest.raises(ValueError, match="shards"):
        sharding.shard(nothing, 0)


# --- quality ------------------------------------------------------------------------

def counts(text):
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_base_counts_of_awkward_rows(awkward):
    got = quality.judged(awkward).collect()
    want = Counter((r["doc_id"], *counts(r["text"])) for r in awkward.select("doc_id", "text").collect())
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"]) and r["kept"] is not None


def test_sketches_merge(awkward):
    """The sketch of a whole is the sum of the sketches of its parts, however it is parted."""
    rows = quality.measured(awkward).cache()
    whole = {tuple(r)[:4]: r["docs"] for r in quality.sketches(rows).collect()}
    parts = Counter()
    for k in range(3):
        for r in quality.sketches(rows.where(F.coalesce("doc_id", F.lit(0)) % 3 == k)).collect():
            parts[tuple(r)[:4]] += r["docs"]
    for r in quality.sketches(rows.where("doc_id % 3 < 0")).collect():
        parts[tuple(r)[:4]] += r["docs"]
    assert whole == dict(parts)


def test_thresholds_adapt_to_the_group(spark):
    """Twice the symbols are odd in one source and usual in another."""
    plain = [(i, " ".join(f"word{j}" for j in range(80)) + " #" * (i % 3), "en", "plain") for i in range(200)]
    noisy = [(1000 + i, " ".join(f"word{j} #" for j in range(60 + i % 30)), "en", "noisy") for i in range(200)]
    odd = (5000, " ".join(f"word{j} #" for j in range(70)), "en", "plain")
    docs = spark.createDataFrame([*plain, *noisy, odd], "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(docs).collect()}
    assert not kept.pop(5000)
    assert all(kept.values())


def test_small_groups_use_their_language(spark):
    rows = [(i, " ".join(f"word{j}" for j in range(80)), "en", "large") for i in range(100)]
    rows += [(900, " ".join(f"word{j} ###" for j in range(80)), "en", "tiny"), (901, " ".join(f"word{j}" for j in range(80)), "en", "tiny")]
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[900] and kept[901]


def test_quality_of_nothing(nothing):
    assert quality.judged(nothing).collect() == []
