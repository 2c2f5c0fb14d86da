from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from weir.llm import text

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="abAB é中\t\n\x0b.", max_size=30) | st.none(), max_size=8)


def low(t):
    return (t or "").translate({k: k + 32 for k in range(65, 91)})


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_are_those_of_the_pattern(texts, size):
    found = []
    for _, _, raw, offsets in text.slices(pa.array(texts, pa.string()), size):
        starts, ends, bounds = text.word_spans(raw, offsets)
        data = raw.tobytes()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            found.append([data[s:e].decode() for s, e in zip(starts[a:b], ends[a:b], strict=True)])
    assert found == [WORD.findall(t or "") for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_equal_hashes_are_equal_words(texts):
    names: dict[int, str] = {}
    for first, last, raw, offsets in text.slices(pa.array(texts, pa.string())):
        starts, ends, _ = text.word_spans(raw, offsets)
        words = [w for t in texts[first:last] for w in WORD.findall(low(t))]
        for h, w in zip(text.word_hashes(raw, starts, ends).tolist(), words, strict=True):
            assert names.setdefault(h, w) == w
    assert len(set(names.values())) == len(names)


def test_shingles_of_short_sequences():
    h = np.arange(1, 6, dtype=np.uint64)
    assert len(text.shingles(h, 3)) == 3
    assert len(text.shingles(h[:2], 3)) == 1
    assert len(text.shingles(h[:0], 3)) == 0
    assert text.shingles(h[:2], 3)[0] != text.shingles(h[1::-1], 3)[0]


def test_characters_know_letters():
    (_, _, raw, offsets), = text.slices(pa.array(["Aé1", "", "ß中"]))
    points, letter, bounds = text.characters(raw, offsets)
    assert "".join(map(chr, points)) == "aé1ß中"
    assert letter.tolist() == [True, True, False, True, True]
    assert bounds.tolist() == [0, 3, 3, 5]
