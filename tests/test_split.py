"""Multi-line files read by many tasks: every cut, against the json and csv modules."""

from __future__ import annotations

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import sources
from weir.plans import jobs
from weir.schemas import RECORD
from weir.sources import split

DOCUMENT = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("inner", T.StructType([T.StructField("a", T.ArrayType(T.LongType())), T.StructField("b", T.StringType())]))])
#: All that could mislead a scan: quotes, backslashes, brackets, separators, line ends.
AWKWARD = ['"', "\\", "\\\\", '\\"', "[", "]", "{", "}", ",", "\n", "\r\n", " ", "a", "é", "日本", '","', "}]", '{"id":', '""']


def text(rng):
    return "".join(rng.choice(AWKWARD) for _ in range(rng.randint(0, 25)))


def documents(rng, n):
    return [{"id": i, "text": rng.choice([None, text(rng)]), "inner": rng.choice([None, {"a": [1, i, 3], "b": text(rng)}])} for i in range(n)]


def write(folder, files):
    import pathlib

    path = pathlib.Path(folder.removeprefix("file:"))
    path.mkdir(parents=True)
    for i, content in enumerate(files):
        (path / f"part{i}.txt").write_text(content, encoding="utf-8", newline="")
    return str(path)


@pytest.fixture(params=[(1, "301b"), (60, "997b"), (1 << 20, "1m")])
def cuts(request, spark, monkeypatch):
    """Chunks of one separator up to whole files, and splits that fall anywhere."""
    monkeypatch.setattr(split, "CHUNK", request.param[0])
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], request.param[1])
    spark.conf.set(keys[1], "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plain(row):
    return json.loads(json.dumps(row.asDict(recursive=True)))


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_of_arrays(spark, scratch, cuts, indent):
    rng = random.Random(indent)
    files = [documents(rng, n) for n in (0, 1, 9)]
    texts = [json.dumps(f, indent=indent, ensure_ascii=False) + rng.choice(["", "\n"]) for f in files]
    texts += [json.dumps({"id": 99, "text": '[,"', "inner": None}, indent=indent), "", " \n "]
    want = [d for f in files for d in f] + [{"id": 99, "text": '[,"', "inner": None}]
    got = [plain(r) for r in sources.read_json_arrays(spark, write(scratch("json"), texts), DOCUMENT).collect()]
    key = lambda d: json.dumps(d, sort_keys=True)
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_an_unreadable_element_is_a_row_of_nulls(spark, scratch, cuts):
    path = write(scratch("json"), ['[{"id": 1}, {"id": }, nope, {"id": 4}]', '[{"id": 5}, {"id": '])
    ids = sorted((r["id"] for r in sources.read_json_arrays(spark, path, DOCUMENT).collect()), key=str)
    assert ids == [1, 4, 5, None, None, None]


@pytest.mark.parametrize("header", [False, True])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_of_csv(spark, scratch, cuts, header, end):
    rng = random.Random(5)
    fields = lambda: [rng.choice(["x", "1 2", 'say "hi"', "a\nb", ",", '"', "\n\n", "é;", '",\n"']) for _ in range(3)]
    files = [[fields() for _ in range(n)] for n in (1, 12)]
    texts = []
    for rows in files:
        out = io.StringIO()
        csv.writer(out, lineterminator=end).writerows([["c1", "c2", "c3"], *rows] if header else rows)
        texts.append(out.getvalue() if rng.random() < 0.5 else out.getvalue().removesuffix(end))
    path = write(scratch("csv"), texts)
    got = sources.read_csv_records(spark, path, header=header)
    assert got.columns == (["c1", "c2", "c3"] if header else ["_c0", "_c1", "_c2"])
    assert sorted(map(str, map(list, got.collect()))) == sorted(str(r) for rows in files for r in rows)


def test_typed_records(spark, scratch):
    path = write(scratch("csv"), ['id,name\n1,"a\nb"\n,\n3,c\n'])
    got = sources.read_csv_records(spark, path, header=True, schema="id long, name string").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "a\nb"), (None, None), (3, "c")], key=str)


def test_one_file_is_read_by_many_tasks(spark, sf_small, monkeypatch):
    """The scan of a single landed array has as many tasks as it has splits."""
    from weir.plans import staging

    path = staging.record_array(spark, sf_small)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        scan = spark.read.option("lineSep", ",").text(path)
        assert len(set(scan.inputFiles())) == 1 and scan.rdd.getNumPartitions() >= 8
        many = sources.read_json_arrays(spark, path, RECORD)
        assert many.exceptAll(jobs.json_records_scan(spark, sf_small)).count() == 0
        assert many.count() == staging.table(spark, sf_small, "documents").count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_large_arrays_are_written_by_a_task_each(spark, scratch, monkeypatch):
    """No task writes more than about one array, however many rows there are; rows come once, also with repeated and null keys."""
    from weir.plans import staging

    n = 4000
    docs = spark.range(n).select(F.when(F.col("id") % 10 != 3, F.col("id") - F.col("id") % 2).alias("doc_id"), F.lit("en").alias("lang"),
                                 F.lit("web").alias("source"), F.concat(F.lit('[",'), F.repeat(F.lit("x"), 900), F.col("id").cast("string")).alias("text"))
    folder = scratch("sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(staging, "BYTES_PER_LARGE_ARRAY", 500_000)
    path = staging.record_array(spark, folder)
    scan = spark.read.text(path)
    sizes = [r["n"] for r in scan.groupBy(F.input_file_name()).agg(F.sum(F.length("value")).alias("n")).collect()]
    assert len(sizes) == 9 and max(sizes) < 750_000
    got = sources.read_json_arrays(spark, path, RECORD)
    want = staging.records_frame(docs).select(*RECORD.fieldNames())
    assert got.exceptAll(want).isEmpty() and got.count() == n
