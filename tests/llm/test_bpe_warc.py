from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weir.llm import bpe, warc
from weir.llm.queries import vocabulary_path
from weir.session import fresh_path


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_spec(vocabulary_path()))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


PARTS = st.sampled_from(["<|endoftext|>", "<|startoftext|>", "'s", "'re", "don't", "HELLO", "été", "Σίσυφος", "İ", "é", "\x1c", "\x85",
                         "\xa0", "   ", "\n", "123", "½", "🙂", "中文", "...", "'", "q", "x" * 40, "aaaa", "the "])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS | st.text(max_size=6), max_size=12).map("".join))
def test_ids_and_texts_are_the_library_s(codec, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert ids_of(codec, text) == want
    assert codec.decode(want) == library.decode(want, skip_special_tokens=False)


def test_long_words(codec, library):
    rng = random.Random(1)
    for alphabet in ("ab", "qxzj", "étu", "a1!"):
        text = "".join(rng.choice(alphabet) for _ in range(3_000))
        assert ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_no_token_spans_a_cut(codec):
    """The cuts are certain: each lies between tokens of the whole word."""
    for word in ("qxqx", "jqé", "vqxzthe", "été", "über"):
        fragments = codec.cut(word.encode())
        assert b"".join(fragments) == word.encode()
        for a, b in zip(fragments[:-1], fragments[1:], strict=True):
            assert not codec.inside[a[-1], b[0]]


def test_full_tables_change_nothing(codec, library):
    small = bpe.Codec(bpe.read_spec(vocabulary_path()))
    small.pieces, small.fragments = bpe.Recent(3), bpe.Recent(3)
    text = " ".join(f"word{i % 17} other{i % 5}" for i in range(200))
    assert ids_of(small, text) == ids_of(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_only_what_comes_again_is_kept(codec, monkeypatch):
    """A worker keeps its tables for later tasks: words that come once take no place in them."""
    monkeypatch.setattr(bpe, "MARKS", 1 << 16)
    own = bpe.Codec(bpe.read_spec(vocabulary_path()))
    once = " ".join(f"w{i}x{i * 7919}" for i in range(2_000))
    found = [ids_of(own, f"{once} again") for _ in range(2)]
    assert found[0] == found[1] == ids_of(codec, f"{once} again")
    assert "again" in own.pieces.new

    table = bpe.Recent(100)
    for i in range(5_000):
        table.put(f"once {i}", i)
        table.put("often", -1)
    assert table.get("often") == -1
    assert len(table.new) + len(table.old) <= 200
    table = bpe.Recent(1_000)
    for i in range(500):
        table.put(f"once {i}", i)
    assert len(table.new) < 50


def test_awkward_rows_round_trip(awkward, nothing, library):
    rows = bpe.encode(awkward, vocabulary_path(), ["doc_id", "text", "ids"], decoded=True).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        want = library.encode(r["k1"] or "", add_special_tokens=False).ids
        assert r["ids"] == want
        assert r["decoded"] == library.decode(want, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(awkward, vocabulary_path(), ["doc_id"]).withColumnRenamed("k0", "doc_id"), vocabulary_path()).collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in rows)
    assert bpe.encode(nothing, vocabulary_path(), ["doc_id"]).collect() == []


# --- archives -------------------------------------------------------------------------

FAKE = warc.MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:7>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def awkward_pages(n=300):
    rng = random.Random(2)
    kinds = [lambda: "x" * rng.randint(0, 3_000), lambda: "pre" + FAKE * rng.randint(1, 4) + "post", lambda: warc.MAGIC * rng.randint(1, 5),
             lambda: None, lambda: "", lambda: FAKE + warc.MAGIC + "Content-Length: 10\r\n\r\n", lambda: "é" * rng.randint(0, 400) + "\r\n\r\n",
             lambda: "same payload", lambda: warc.MAGIC + "Content-Length: " + "9" * 30 + "\r\n\r\n", lambda: FAKE]
    return [(i, None if i % 9 == 0 else f"http://a/{i}\n", rng.choice(kinds)()) for i in range(n)]


def test_archives_round_trip(spark):
    pages = awkward_pages()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")  # records and magics across many splits
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        path = fresh_path(spark, "archives")
        warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), path)
        archived = warc.read_archives(spark, path).cache()
        payloads = {r["page_id"]: bytes(r["payload"]) for r in archived.collect()}
        got = {r["page_id"]: tuple(r) for r in warc.summary(spark, path).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(got) == len(pages)
    last = {}
    for i, _, html in pages:
        last[html or ""] = i
    for i, _, html in pages:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = last[html or ""]
        assert got[i] == (i, len(body), digest, "response" if first == i else "revisit", None if first == i else first)
        if first == i:
            assert payloads[i] == body


@pytest.mark.parametrize("read", [warc.summary, warc.read_archives])
def test_splits_that_change_between_scans_lose_nothing(spark, monkeypatch, read):
    """The second scan may be cut otherwise than the first: another number of cores does that."""
    pages = awkward_pages()
    path = fresh_path(spark, "archives")
    warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2), path)
    want = sorted(map(str, read(spark, path).collect()))
    assert len(want) == len(pages)
    reachable, before = warc.reachable, {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut_otherwise(links):
        found = reachable(links)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5k")
        return found

    monkeypatch.setattr(warc, "reachable", cut_otherwise)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        assert sorted(map(str, read(spark, path).collect())) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_place_without_a_text_is_an_error(spark):
    places = spark.createDataFrame([("f", 0), ("f", 7)], "file string, start long")
    texts = spark.createDataFrame([("f", 0, bytearray(b"x"))], "file string, start long, text binary")
    with pytest.raises(Exception, match="no text at byte 7 of f"):
        warc._with_text(places, texts).collect()


def test_small_payloads_are_no_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    path = fresh_path(spark, "archives")
    warc.write_archives(pages, path, least_bytes=5)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.summary(spark, path).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_archives_of_nothing_and_of_repeated_rows(spark):
    schema = "page_id long, url string, html string, extra string"
    for rows, want in (([], []), ([(5, "u", "same", "x"), (5, "u", "same", "y"), (None, None, "same", None)],
                                  [(5, "response", None), (5, "response", None), (None, "revisit", 5)])):
        path = fresh_path(spark, "archives")
        warc.write_archives(spark.createDataFrame(rows, schema), path)
        got = [(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.summary(spark, path).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_only_chains_from_the_start_count(spark):
    links = [("f", 0, 10), ("f", 10, 40), ("f", 20, 30), ("f", 30, 40), ("f", 40, 90), ("g", 5, 9), ("h", 0, None)]
    got = warc.reachable(spark.createDataFrame(links, "file string, start long, next long")).collect()
    assert sorted(map(tuple, got)) == [("f", 0), ("f", 10), ("f", 40), ("h", 0)]


def test_tables_of_the_rounds_are_deleted(spark, monkeypatch):
    """Of the rounds only what is reached stays; the caller's links are left alone."""
    import os

    kept, write = [], warc.written

    def noted(df, name, **options):
        kept.append(write(df, name, **options))
        return kept[-1]

    monkeypatch.setattr(warc, "written", noted)
    links = spark.createDataFrame([("a", i, i + 1) for i in range(20)], "file string, start long, next long")
    got = warc.reachable(links)
    assert got.count() == 20 and len(kept) > 8
    assert [t.written_at for t in kept if os.path.exists(t.written_at.removeprefix("file:"))] == [got.written_at]


@pytest.mark.parametrize("bits", [1, 64, warc._BITS])
def test_digests_that_occur_again_are_told_by_the_map(spark, monkeypatch, bits):
    """Every repeated payload is told, and with room in the map no other one; a full map changes no record."""
    monkeypatch.setattr(warc, "_BITS", bits)
    pages = spark.createDataFrame([(i, f"http://a/{i}", f"page {i % 700}") for i in range(1_000)], "page_id long, url string, html string")
    first = warc._repeated(pages, 0).cache()
    assert first.count() == 300
    again = {r["page_id"] for r in warc._may_repeat(warc._payloads(pages), first).where("again").select("page_id").collect()}
    repeated = {i for i in range(1_000) if i % 700 < 300}
    assert again == repeated if bits > 64 else again >= repeated
    got = {r["page_id"]: r["record"] for r in warc.records(pages).collect()}
    assert len(got) == 1_000
    for i, record in got.items():
        assert ("WARC-Type: revisit" in record) == (i < 300)
        assert record.endswith("\r\n\r\n\r\n" if i < 300 else f"\r\n\r\npage {i % 700}\r\n")
        assert i >= 300 or f"WARC-Refers-To: <urn:page:{i + 700}>" in record


def test_payloads_without_copies_are_not_exchanged(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = []
        for kinds in (500, 400):
            pages = spark.createDataFrame([(i, None, f"page {i % kinds}") for i in range(500)], "page_id long, url string, html string")
            found = warc.records(pages)
            assert len(found.collect()) == 500
            plans.append(found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ["Exchange hashpartitioning(digest" in plan for plan in plans] == [False, True]
