"""The sorted layout that takes loads: the sweep against brute force, files left alone, range reads, replays."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import folders, landings
from weir.sinks import layout

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("v", T.LongType())])
KEYS = ["k", "s"]
PLACE = "struct<k:bigint,s:string>"


def _frame(spark, ks):
    return spark.createDataFrame([(k, f"s{k}" if k is not None else None, i) for i, k in enumerate(ks)], SCHEMA)


def _files(spark, path):
    rows = layout.layout_manifest(spark, path, SCHEMA, KEYS).collect()
    return {r["file"]: (r["low"]["k"], r["high"]["k"], r["rows"]) for r in rows}


def _sweep_by_force(old, new):
    """(touched names, groups as sets) by comparing all pairs."""
    meet = lambda a, b: a[1] <= b[2] and b[1] <= a[2]
    touched = {a[0]: a for a in old if any(meet(a, b) for b in new)} | {b[0]: b for b in new if any(meet(a, b) for a in old)}
    groups = {n: {n} for n in touched}
    for a in touched.values():
        for b in touched.values():
            if meet(a, b) and groups[a[0]] is not groups[b[0]]:
                groups[a[0]] |= groups[b[0]]
                for n in groups[a[0]]:
                    groups[n] = groups[a[0]]
    return set(touched), {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("seed", range(3))
def test_sweep_equals_all_pairs(spark, seed):
    rng = random.Random(seed)

    def some(prefix, n):
        lows = [rng.randrange(300) for _ in range(n)]
        return [(f"{prefix}{i}", low, low + rng.randrange(12)) for i, low in enumerate(lows)]

    def frame(rows):
        rows = [(n, (a, "a"), (b, "a"), 1) for n, a, b in rows]
        return spark.createDataFrame(rows, f"file string, low {PLACE}, high {PLACE}, rows long")

    old, new = some("o", 25), some("n", 12)
    found = layout.sweep(frame(old), frame(new)).collect()
    touched, groups = _sweep_by_force(old, new)
    assert len(found) == 37
    assert {r["file"] for r in found if r["touched"]} == touched
    got = {}
    for r in found:
        if r["touched"]:
            got.setdefault(r["group"], set()).add(r["file"])
        else:
            assert r["group"] is None
    assert {frozenset(g) for g in got.values()} == groups


def test_a_load_merges_only_what_it_overlaps(spark, scratch):
    path = scratch("layout")
    for n, ks in enumerate([range(0, 100), range(200, 300), range(400, 500)]):
        layout.add_load(_frame(spark, ks), path, KEYS, n)
    before = _files(spark, path)
    done = layout.add_load(_frame(spark, [*range(250, 260), *range(600, 610)]), path, KEYS, 3)
    after = _files(spark, path)
    away = {f for f, (low, high, _) in before.items() if high >= 250 and low < 260} - set(after)
    assert away and all(200 <= before[f][0] <= 299 for f in away)
    untouched = {f: r for f, r in before.items() if r[1] < 200 or r[0] >= 400}
    assert untouched.items() <= after.items()
    assert done["merged"] == len(set(before) - set(after)) and done["kept"] == len(set(before) & set(after))
    got = sorted(r["k"] for r in layout.read_layout(spark, path, SCHEMA, KEYS).collect())
    assert got == sorted([*range(100), *range(200, 300), *range(400, 500), *range(250, 260), *range(600, 610)])


def test_no_merged_file_reaches_over_one_left_alone(spark, scratch):
    path = scratch("layout")
    for n, ks in enumerate([range(0, 10), range(20, 30), range(40, 50)]):
        layout.add_load(_frame(spark, ks), path, KEYS, n)
    layout.add_load(_frame(spark, [5]), path, KEYS, 3)
    layout.add_load(_frame(spark, [45]), path, KEYS, 4)
    middle = {f for f, r in _files(spark, path).items() if 20 <= r[0] <= 29}
    # both ends in one load: its files don't reach over the middle
    layout.add_load(_frame(spark, [3, 47]).coalesce(1), path, KEYS, 5, rows_per_file=1000)
    assert middle and middle <= set(_files(spark, path))
    ranges = sorted((low, high) for low, high, _ in _files(spark, path).values())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False)), ranges


def test_range_reads_open_only_the_files_they_need(spark, scratch):
    path = scratch("layout")
    for n in range(4):
        layout.add_load(_frame(spark, range(100 * n, 100 * n + 50)), path, KEYS, n)
    part = layout.read_layout(spark, path, SCHEMA, KEYS, low=(110,), high=(120, "s120"))
    assert sorted(r["k"] for r in part.collect()) == list(range(110, 121))
    needed = {f for f, (low, high, _) in _files(spark, path).items() if high >= 110 and low <= 120}
    assert len(part.inputFiles()) == len(needed) < len(_files(spark, path))
    assert layout.read_layout(spark, path, SCHEMA, KEYS, low=(160,), high=(180,)).count() == 0


def test_null_keys_and_hot_keys(spark, scratch):
    path = scratch("layout")
    ks = [None, None, *[7] * 200, *range(20)]
    layout.add_load(_frame(spark, ks), path, KEYS, 0)
    layout.add_load(_frame(spark, [None, 7, 7, 30]), path, KEYS, 1)
    rows = layout.read_layout(spark, path, SCHEMA, KEYS)
    assert rows.count() == len(ks) + 4 and rows.where("k IS NULL").count() == 3
    assert layout.read_layout(spark, path, SCHEMA, KEYS, low=(7,), high=(7,)).count() == 203


def test_replays_and_empty_loads(spark, scratch):
    path = scratch("layout")
    layout.add_load(_frame(spark, []), path, KEYS, 0)
    assert layout.read_layout(spark, path, SCHEMA, KEYS).count() == 0
    layout.add_load(_frame(spark, [1, 2]), path, KEYS, 1)
    assert layout.add_load(_frame(spark, [1, 2]), path, KEYS, 1) is None
    assert layout.read_layout(spark, path, SCHEMA, KEYS).count() == 2


def test_a_load_that_fails_before_its_pointer_changes_nothing(spark, scratch, monkeypatch):
    path = scratch("layout")
    layout.add_load(_frame(spark, [1, 2]), path, KEYS, 0)
    with monkeypatch.context() as m:
        m.setattr(landings, "point", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            layout.add_load(_frame(spark, [1, 3]), path, KEYS, 1)
    assert sorted(r["k"] for r in layout.read_layout(spark, path, SCHEMA, KEYS).collect()) == [1, 2]
    layout.add_load(_frame(spark, [1, 3]), path, KEYS, 1)
    assert sorted(r["k"] for r in layout.read_layout(spark, path, SCHEMA, KEYS).collect()) == [1, 1, 2, 3]


def test_files_no_version_names_are_deleted(spark, scratch):
    path = scratch("layout")
    for n in range(4):
        layout.add_load(_frame(spark, [1, 2, 3]), path, KEYS, n)
    known = [v for _, v in landings.pointers(spark, path)]
    named = {r["file"] for v in known for r in spark.read.parquet(f"{path}/{v}").collect()}
    there = {p.split(path, 1)[1].lstrip("/") for p, _, _ in folders.statuses(spark, path) if p.endswith(".parquet")}
    data = {f for f in there if f.startswith(("data-", "merged-"))}
    first_loads = {f for f in data if f.startswith(("data-000000000000", "merged-000000000001"))}
    assert named <= there and not first_loads
    assert layout.read_layout(spark, path, SCHEMA, KEYS).agg(F.count("*")).first()[0] == 12
