"""Words and characters of Arrow batches of texts as flat numpy arrays.

Used inside tasks: a batch is cut into runs of documents of about
``SLICE_BYTES`` (one document at least), so memory follows the longest document
and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18

# Odd multipliers of a 64-bit hash (arbitrary, fixed so that runs agree).
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_K = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
_MASK = (1 << 64) - 1

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(_M1)
    x ^= x >> np.uint64(27)
    x *= np.uint64(_M2)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    return _powers(1 << max(n - 1, 1).bit_length())


def slices(texts: pa.Array | pa.ChunkedArray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets): runs of texts as one UTF-8 buffer each; null reads as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(at, at[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last, raw[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


#: For word_spans: all of ASCII but letters and digits parts words.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, bounds): words of the run (between bytes in ``gaps``), and where each document's words begin."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~gaps[raw]
    # A document ends its last word: mark the edges where one document meets the next.
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    if len(cuts):
        cuts = np.unique(cuts)
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
        if len(cuts):
            starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends, np.searchsorted(starts, offsets, "left")


def prefix_sums(raw: np.ndarray, lower: bool = True) -> np.ndarray:
    """Running sums of bytes times powers: differences hash any stretch of bytes."""
    up, _ = powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(((_LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=total[1:])
    return total


def stretch_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((total[ends] - total[starts]) * powers(len(total))[1][starts])


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes (A-Z lowered first, if asked)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return stretch_hashes(prefix_sums(raw, lower), starts, ends)


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; of the whole sequence, if it is shorter."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        # position-dependent odd multipliers: derived, so any size works
        total = total * np.uint64(_K[0]) + hashes[j:n - width + 1 + j] * np.uint64(_K[1 + j % 4])
    return mix(total)


def document_shingles(raw: np.ndarray, offsets: np.ndarray, size: int, lower: bool = True) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a run."""
    starts, ends, bounds = word_spans(raw, offsets)
    hashes = word_hashes(raw, starts, ends, lower)
    for a, b in zip(bounds[:-1], bounds[1:], strict=False):
        yield np.unique(shingles(hashes[a:b], size))


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    chars = np.arange(0x110000, dtype=np.uint32)
    lower, letter = chars.copy(), np.zeros(0x110000, bool)
    for k in range(0x110000):
        if 0xD800 <= k < 0xE000:
            continue
        c = chr(k)
        if c.isalpha():
            letter[k] = True
        low = c.lower()
        if low != c and len(low) == 1:
            lower[k] = ord(low)
    return lower, letter


def characters(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lowered code points, is a letter, bounds of documents) of a run."""
    first = (raw & 0xC0) != 0x80
    count = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(first, out=count[1:])
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    lower, letter = _letters()
    return lower[points], letter[points], count[offsets]
