"""Byte-pair encoding and decoding with forced boundaries.

A vocabulary file of the ``tokenizers`` JSON format (byte-level BPE whose words
end in a suffix) is read once on the driver and broadcast; its size is the
bound.  Text is normalised (NFC, white space, lower case) and parted into words
as the file's pattern says.

Inside a word, a pair of neighbouring bytes that no vocabulary token contains is
a certain cut: no merge can ever span it.  A word falls into fragments there,
each fragment is merged by itself, and the ids are put one after the other.
Fragments recur far more often than words, so a task keeps a bounded table of
what it has merged; emptying a full table costs time, never a result.  A worker
keeps its tables for later tasks, so only what comes again is put into them.

Defined cases: a null or empty text has no ids and decodes to the empty text;
texts of any length are processed whole, document by document; special tokens
written out in a text are those tokens, as the library reads them; repeated
rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from weir.llm.common import carried_columns, scored

#: Entries of a task's table of pieces, and of its table of fragments.
TABLE = 150_000
#: Marks (a byte each) by which a table tells what it has met before; a power of 2.
MARKS = 1 << 20
#: Bytes up to which a word's cuts are found one pair at a time.
SHORT_WORD = 100
#: Symbols up to which the next merge is found by looking at all of them.
SHORT = 32
#: Documents a task sends on at a time.
ROWS = 256

# The classes of characters that vocabulary files name.
LETTER, NUMBER, WHITE = r"\p{L}", r"\p{N}", r"\s"

Batches = Iterator[pa.RecordBatch]


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte.

    Printable Latin-1 bytes stand for themselves; the rest count up from U+0100.
    """
    letters, extra = [], 0
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            letters.append(chr(b))
        else:
            letters.append(chr(256 + extra))
            extra += 1
    return letters


class Recent:
    """A bounded table: what was not asked for while a whole table filled up is forgotten.

    Most words of a corpus come once: a key enters when it is offered again.  Two
    keys with one mark only enter early.
    """

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}
        self.met, self.marks = 0, bytearray(MARKS)

    def get(self, key):
        found = self.new.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self._enter(key, found)
        return found

    def put(self, key, value) -> None:
        mark = hash(key) & MARKS - 1
        if self.marks[mark]:
            self._enter(key, value)
            return
        if self.met >= MARKS // 4:
            self.met, self.marks = 0, bytearray(MARKS)
        self.met += 1
        self.marks[mark] = 1

    def _enter(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value


@lru_cache(maxsize=8)
def letter_ranges(pattern: str) -> str:
    """The code points that the library's own ``pattern`` matches, as ranges of a character class.

    The library's Unicode tables need not be those of this Python.
    """
    from tokenizers import Regex, pre_tokenizers

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    runs = pre_tokenizers.Split(Regex(f"(?:{pattern})+"), "removed", invert=True).pre_tokenize_str(every)
    return "".join(f"\\U{ord(run[0]):08x}-\\U{ord(run[-1]):08x}" for run, _ in runs)


def first_ranges(ranges: str, end: int) -> str:
    """The part of a class's ranges that begins up to ``end``."""
    pairs = regex.findall(r"\\U([0-9a-f]{8})-\\U([0-9a-f]{8})", ranges)
    return "".join(f"\\U{a}-\\U{b}" for a, b in pairs if int(a, 16) <= end)


class Codec:
    """Ids of texts and texts of ids, by one vocabulary file and its classes of characters."""

    def __init__(self, spec: bytes):
        full = json.loads(spec)
        classes = full["classes"]
        model = full["model"]
        if model["type"] != "BPE" or full.get("decoder") or model.get("continuing_subword_prefix"):
            raise ValueError("not a vocabulary that this codec reads")
        self.end = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: (id << 32 | id of the next symbol) -> rank of their merge; rank -> id of the merged symbol
        self.ranks: dict[int, int] = {}
        self.made = [self.ids[x + y] for x, y in merges]
        for rank, (x, y) in enumerate(merges):
            self.ranks.setdefault(self.ids[x] << 32 | self.ids[y], rank)
        self.special = {t["content"]: t["id"] for t in full["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")") if self.special else None
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        source = full["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The full classes are long; most texts need none but their first ranges.
        self.words = [(chr(end), regex.compile(self._written_out(source, {c: first_ranges(r, end) for c, r in classes.items()})))
                      for end in (0x7F, 0x24F, 0x10FFFF)]
        self.white = regex.compile(f"[{classes[WHITE]}]+")
        # white space to Python and not to the library, or the other way round
        self.odd_white = regex.compile("[\\x1c-\\x1f]")
        self.letters = byte_letters()
        self.first = [self.ids.get(x) for x in self.letters]
        self.last = [self.ids.get(x + self.end) for x in self.letters]
        self.inside = self._inside()
        self.inside_flat = self.inside.astype(np.uint8).tobytes()
        self.pieces, self.fragments = Recent(TABLE), Recent(TABLE)

    @staticmethod
    def _written_out(pattern: str, classes: dict[str, str]) -> str:
        """The pattern with its classes as ranges; a class stands in brackets, or alone (white space in brackets)."""
        for name, ranges in classes.items():
            pattern = pattern.replace(name, ranges)
        return pattern

    def _inside(self) -> np.ndarray:
        """For each pair of bytes, whether some token has them next to each other."""
        byte = {letter: b for b, letter in enumerate(self.letters)}
        found = np.zeros((256, 256), bool)
        for token in self.ids:
            bare = token.removesuffix(self.end) if self.end else token
            try:
                own = [byte[c] for c in bare]
            except KeyError:  # not a byte-level token: no text gets it
                continue
            found[own[:-1], own[1:]] = True
        return found

    def cut(self, word: bytes) -> list[bytes]:
        """The fragments of a word: parted where no token can hold both neighbours."""
        if len(word) <= SHORT_WORD:
            inside, before, at = self.inside_flat, word[0], []
            for i, b in enumerate(word):
                if i and not inside[before << 8 | b]:
                    at.append(i)
                before = b
            if not at:
                return [word]
        else:
            own = np.frombuffer(word, np.uint8)
            at = (np.flatnonzero(~self.inside[own[:-1], own[1:]]) + 1).tolist()
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)], strict=True)]

    def merged(self, fragment: bytes, last: bool) -> bytes:
        """The ids of a fragment, as packed 32-bit numbers; ``last``: it ends its word."""
        key = fragment + b" " if last else fragment  # no fragment holds a space
        found = self.fragments.get(key)
        if found is None:
            symbols = [self.first[b] for b in fragment]
            if last:
                symbols[-1] = self.last[fragment[-1]]
            symbols = [i for i in symbols if i is not None]
            found = array("i", self._few(symbols) if len(symbols) <= SHORT else self._many(symbols)).tobytes()
            self.fragments.put(key, found)
        return found

    def _few(self, symbols: list[int]) -> list[int]:
        """Merge the pair of the least rank, the leftmost of equals, until no pair has one."""
        rank_of, none = self.ranks.get, len(self.made)
        ranks = [rank_of(x << 32 | y, none) for x, y in zip(symbols[:-1], symbols[1:], strict=True)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i] = made = self.made[best]
            del symbols[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of(symbols[i - 1] << 32 | made, none)
            if i < len(ranks):
                ranks[i] = rank_of(made << 32 | symbols[i + 1], none)
        return symbols

    def _many(self, symbols: list[int]) -> list[int]:
        """The same merges in the same order off a heap, for long fragments."""
        ranks, n = self.ranks, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], i, p) for i, p in enumerate(x << 32 | y for x, y in zip(symbols[:-1], symbols[1:], strict=True)) if p in ranks]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or symbols[i] << 32 | symbols[j] != pair:
                continue
            symbols[i] = self.made[rank]
            alive[j] = False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    new = symbols[left] << 32 | symbols[after[left]]
                    if new in ranks:
                        heapq.heappush(heap, (ranks[new], left, new))
        return [s for s, live in zip(symbols, alive, strict=True) if live]

    def _piece(self, piece: str) -> bytes:
        """The ids of a stretch of text without white space."""
        out: list[bytes] = []
        highest = "" if piece.isascii() else max(piece)
        for word in next(pattern for end, pattern in self.words if highest <= end).findall(piece):
            fragments = self.cut(word.encode())
            out += [self.merged(f, False) for f in fragments[:-1]]
            out.append(self.merged(fragments[-1], True))
        packed = b"".join(out)
        self.pieces.put(piece, packed)
        return packed

    def _plain(self, text: str) -> list[bytes]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        # lowered letter by letter: a final sigma is no special letter here
        text = text.replace("Σ", "σ").lower()
        pieces = [p for p in self.white.split(text) if p] if self.odd_white.search(text) else text.split()
        get, new = self.pieces.get, self._piece
        return [get(p) or new(p) for p in pieces]

    def encode(self, text: str) -> bytes:
        """The ids of a text as packed 32-bit numbers."""
        if self.special_pattern and self.special_pattern.search(text):
            out = []
            for part in self.special_pattern.split(text):
                if part in self.special:
                    out.append(np.array([self.special[part]], np.int32).tobytes())
                else:
                    out += self._plain(part)
            return b"".join(out)
        return b"".join(self._plain(text))

    def decode(self, ids: list[int]) -> str:
        """The text of ids.  The file names no decoder: tokens are written with spaces between."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(spec: bytes) -> Codec:
    return Codec(spec)


def _encoder(spec: object, decoded: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        codec = _codec(spec.value)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                packed = [codec.encode(t) if t else b"" for t in part.column("text").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(packed), np.int32))
                kept, names = carried_columns(part)
                outputs, kinds = [*kept, ids], [*names, "ids"]
                if decoded:
                    outputs.append(pa.array([codec.decode(np.frombuffer(p, np.int32).tolist()) for p in packed], pa.string()))
                    kinds.append("decoded")
                yield pa.RecordBatch.from_arrays(outputs, kinds)
    return run


def read_spec(path: str) -> bytes:
    """The vocabulary file and the classes of characters its patterns name."""
    with open(path, "rb") as file:
        full = json.load(file)
    return json.dumps(full | {"classes": {c: letter_ranges(c) for c in (LETTER, NUMBER, WHITE)}}).encode()


def encode(docs: DataFrame, path: str, keep: list[str], decoded: bool = False) -> DataFrame:
    """The columns ``keep`` of ``docs`` as k0, k1, ..., with ``ids`` (and ``decoded``, the ids' text).

    ``path`` is the vocabulary file, on the driver.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(path))
    outputs = "ids array<int>" + (", decoded string" if decoded else "")
    return scored(docs, keep, _encoder(spec, decoded), outputs)


def _decoder(spec: object) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        codec = _codec(spec.value)
        for batch in batches:
            kept, names = carried_columns(batch)
            texts = [codec.decode(i) if i else "" for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[k for k, n in zip(kept, names, strict=True) if n != "ids"], pa.array(texts, pa.string())],
                [*[n for n in names if n != "ids"], "decoded"])
    return run


def decode(rows: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, decoded) of rows with ``ids``."""
    spec = rows.sparkSession.sparkContext.broadcast(read_spec(path))
    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, "ids").mapInArrow(_decoder(spec), f"`{key}` {kind}, decoded string")
