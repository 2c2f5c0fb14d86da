"""Language-model scoring by cross-entropy difference.

Two bigram models with one vocabulary, order and smoothing, one of a target
corpus and one of a background corpus, price every word of a document; the
score is the mean of the differences of the two losses (in nats a word, below
0: more like the target).

P(w | c) = W * count(c, w) / count(c) + (1 - W) * (count(w) + D) / (all + D * V)

Every word is a word of its own, named by its 64-bit hash; V is one more than the
distinct words of both corpora.  Each document begins with a start mark.  Counts
of words are a distributed table.  The ``COMMON`` commonest are broadcast with
theirs, as a shortcut that changes no result: their bigrams are counted and
priced in buckets, where counts come first and occurrences stream after them,
packed, and leave as sums by document.  Bigrams of the ``HOT`` commonest words,
which fill most documents, don't travel: their counts are a dense table of fixed
size, summed beforehand.

A bigram with a rarer word goes to the bucket of that word (of the second, if
both are rare), where the counts of words are sent, too; so the common one's
count is at hand by broadcast and the rare one's in the bucket.  Only contexts
that are rare before rare words are looked up by a join.  Where the documents are
the background, a bucket's own occurrences are its counts.  A rare word has less
than one in ``COMMON`` of all words, and a bucket holds about ``RARE_BUCKET``
occurrences beside those of one word.

Defined cases: a null text, or one without words, has 0 words and score 0; an
empty target makes every unigram of the target model equally likely; repeated
rows count and are scored each; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.common import written
from weir.llm.text import mix, slices, word_hashes, word_spans

#: The hash that stands for the start mark.
START = np.uint64(0x9E3779B97F4A7C15)
#: The commonest words, the start mark among them, that are broadcast with their counts: ids are below 2 ** 16.
COMMON = 1 << 16
#: Those of them whose bigrams are counted densely.
HOT = 256
BIGRAM_WEIGHT = 0.6
SMOOTHING = 0.5
#: Bytes of text a task works on at a time.
CHUNK = 2 << 20
#: Counts of chunks that a task adds up before it sends them.
TOGETHER = 3_000_000
#: Rows with equal numbers but for these bits get their sums together.
HOME_BITS = 12
#: Bigrams that a bucket holds at most, about.
BUCKET = 2_000_000
RARE_BUCKET = 1_000_000
#: Counts of words that a task sends at a time.
COUNTS_SENT = 300_000

Batches = Iterator[pa.RecordBatch]


class Vocabulary(NamedTuple):
    """Sorted hashes of common words, and their ids: the commonest word has the least."""

    hashes: np.ndarray
    ids: np.ndarray

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The ids, -1 for other words."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.searchsorted(self.hashes, hashes).clip(0, len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.ids[at], -1)


class Models(NamedTuple):
    """The common words, the start mark first, with what prices their bigrams: shares and counts by id, dense counts."""

    words: Vocabulary
    names: np.ndarray
    unigram: np.ndarray
    contexts: np.ndarray
    hot: np.ndarray

    def losses(self, model: int, context: np.ndarray, word: np.ndarray, times: np.ndarray) -> np.ndarray:
        seen = self.contexts[model][context]
        given = np.divide(times, seen, out=np.zeros(len(times)), where=seen > 0)
        weight = np.where(seen > 0, BIGRAM_WEIGHT, 0.0)
        return -np.log(weight * given + (1 - weight) * self.unigram[model][word])


def _ids(vocabulary: Vocabulary, before: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of contexts and words; the start mark has 0."""
    b = vocabulary.of(words)
    a = np.empty_like(b)
    a[1:] = b[:-1]
    a[before == START] = 0
    return a, b


def _bigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, words, bounds of documents): a bigram for each word."""
    starts, ends, bounds = word_spans(raw, offsets)
    words = word_hashes(raw, starts, ends)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[bounds[:-1][np.diff(bounds) > 0]] = START
    return before, words, bounds


def _key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(context) + word)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Grows with the key, so what is sorted by key is sorted by bucket."""
    high = key.astype(np.uint64) if key.dtype == np.uint32 else key >> np.uint64(32)
    return ((high * np.uint64(buckets)) >> np.uint64(32)).astype(np.int32)


class _Sums:
    """Counts by key of several chunks, so that a task sends a frequent one seldom."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, times: np.ndarray) -> bool:
        """Whether it is time to send them."""
        self.parts.append((keys, times))
        self.waiting += len(keys)
        return self.waiting > TOGETHER

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        keys, which = np.unique(np.concatenate([k for k, _ in self.parts]), return_inverse=True)
        times = np.bincount(which, np.concatenate([t for _, t in self.parts]), len(keys)).astype(np.int64)
        self.parts, self.waiting = [], 0
        return keys, times


def _words(batches: Batches) -> Batches:
    """(word, times) of some chunks; the start mark counts documents with words."""
    sums = _Sums()

    def sent() -> pa.RecordBatch:
        names, times = sums.taken()
        return pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(times)], ["word", "times"])

    for batch in batches:
        for _, _, raw, offsets in slices(batch.column("text"), CHUNK):
            _, words, bounds = _bigrams(raw, offsets)
            if len(words):
                names, times = np.unique(words, return_counts=True)
                if sums.add(np.append(names, START), np.append(times, (np.diff(bounds) > 0).sum())):
                    yield sent()
    if sums.parts:
        yield sent()


def _both(run: Callable, columns: str, background: DataFrame, target: DataFrame, docs: DataFrame | None) -> DataFrame:
    """Sums of ``times`` in the background and in the target; what ``docs`` have gets a row, too."""
    keys = [c.split(" ")[0] for c in columns.split(", ")]

    def counted(df: DataFrame, in_background: int, in_target: int) -> DataFrame:
        rows = df.select("text").mapInArrow(run, columns + ", times long")
        return rows.select(*keys, (F.col("times") * in_background).alias("background"), (F.col("times") * in_target).alias("target"))

    every = counted(background, 1, 0).unionByName(counted(target, 0, 1))
    if docs is not None and docs is not background:
        every = every.unionByName(counted(docs, 0, 0))
    return every.groupBy(*keys).agg(F.sum("background").alias("background"), F.sum("target").alias("target"))


def _commonest(words: DataFrame, size: int) -> list:
    start = int(START.view(np.int64))
    return words.where(F.col("word") != start).orderBy(F.desc("background"), "word").limit(size).collect()


def _vocabulary(hashes: list[int]) -> Vocabulary:
    names = np.array(hashes, np.int64).view(np.uint64)
    by = np.argsort(names)
    return Vocabulary(names[by], by)


def _dense(words: object) -> Callable[[Batches], Batches]:
    """Counts of hot bigrams, summed over the task."""
    def run(batches: Batches) -> Batches:
        total = np.zeros(HOT * HOT, np.int64)
        for batch in batches:
            for _, _, raw, offsets in slices(batch.column("text"), CHUNK):
                before, names, _ = _bigrams(raw, offsets)
                a, b = _ids(words.value, before, names)
                both = _hot(a, b)
                total += np.bincount(a[both] * HOT + b[both], minlength=HOT * HOT)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "times"])
    return run


def _hot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a >= 0) & (b >= 0) & (a < HOT) & (b < HOT)


class Totals(NamedTuple):
    """Words of both corpora, and the kinds of words that the smoothing allows for."""

    background: int
    target: int
    kinds: int


def _totals(words: DataFrame) -> Totals:
    sums = words.where(F.col("word") != int(START.view(np.int64))).agg(
        F.sum("background").alias("b"), F.sum("target").alias("t"), F.sum((F.col("background") + F.col("target") > 0).cast("long")).alias("n")).first()
    return Totals(sums["b"] or 0, sums["t"] or 0, (sums["n"] or 0) + 1)


def fit(background: DataFrame, target: DataFrame, words: DataFrame, totals: Totals) -> Models:
    """What prices the bigrams of common words: all of fixed size."""
    start = int(START.view(np.int64))
    top = words.where(F.col("word") == start).collect() or [{"word": start, "background": 0, "target": 0}]
    top = [*top, *_commonest(words, COMMON - 1)]
    known = _vocabulary([r["word"] for r in top])
    contexts = np.array([[r["background"] for r in top], [r["target"] for r in top]], float)
    sums = np.array([[totals.background], [totals.target]], float)
    shared = background.sparkSession.sparkContext.broadcast(known)
    hot = np.zeros((2, HOT * HOT))
    for r in _both(_dense(shared), "cell long", background, target, None).collect():  # HOT x HOT rows
        hot[:, r["cell"]] = r["background"], r["target"]
    names = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    return Models(known, names, (contexts + SMOOTHING) / (sums + SMOOTHING * totals.kinds), contexts, hot)


_PACKED = "bucket int, turn int, home long, keys binary, values binary"
_NAMES = ["bucket", "turn", "home", "keys", "values"]
# turns in a bucket: counts of bigrams in both corpora, then occurrences
_BACKGROUND, _TARGET, _OCCURRENCES = 0, 1, 2
# Keys of common bigrams are ids times an odd number modulo 2 ** 32, so that buckets get alike shares.
_ODD = 0x9E3779B1
_BACK = pow(_ODD, -1, 1 << 32)


def _rows(turn: int, home: int, key: np.ndarray, values: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row a bucket of what is sorted by key."""
    ids, at = np.unique(_bucket(key, buckets), return_index=True)
    cuts = list(zip(at, np.append(at, len(key))[1:], strict=True))
    cut = lambda x: pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([turn] * len(ids), pa.int32()), pa.array([home] * len(ids), pa.int64()),
                                       cut(key), cut(values)], _NAMES)


def _common_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint32) << np.uint32(16) | b.astype(np.uint32)) * np.uint32(_ODD)


def _common_counts(models: object, buckets: int, turn: int) -> Callable[[Batches], Batches]:
    """Counts of some chunks' bigrams of common words that are not hot, by bucket."""
    def run(batches: Batches) -> Batches:
        sums = _Sums()

        def sent() -> pa.RecordBatch:
            key, times = sums.taken()
            return _rows(turn, 0, key, times.astype(np.uint32), buckets)

        for batch in batches:
            for _, _, raw, offsets in slices(batch.column("text"), CHUNK):
                before, words, _ = _bigrams(raw, offsets)
                a, b = _ids(models.value.words, before, words)
                pick = (a >= 0) & (b >= 0) & ~_hot(a, b)
                if sums.add(*np.unique(_common_keys(a[pick], b[pick]), return_counts=True)):
                    yield sent()
        if sums.parts:
            yield sent()
    return run


def _sent(models: object, buckets: int) -> Callable[[Batches], Batches]:
    """Occurrences of common bigrams that are not hot, by bucket, with the numbers of their rows."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            numbers = batch.column("row").to_numpy()
            for first, last, raw, offsets in slices(batch.column("text"), CHUNK):
                before, words, bounds = _bigrams(raw, offsets)
                a, b = _ids(models.value.words, before, words)
                pick = (a >= 0) & (b >= 0) & ~_hot(a, b)
                key = _common_keys(a[pick], b[pick])
                row = np.repeat(numbers[first:last], np.diff(bounds))[pick]
                by = np.argsort(key)
                key, row = key[by], row[by]
                homes = row >> HOME_BITS
                for home in np.unique(homes):
                    own = homes == home
                    yield _rows(_OCCURRENCES, int(home), key[own], _places(row[own]), buckets)
    return run


def _places(row: np.ndarray) -> np.ndarray:
    return (row & ((1 << HOME_BITS) - 1)).astype(np.uint16)


class _Counts:
    """Sums of counts by key, of which only the distinct keys are kept."""

    def __init__(self) -> None:
        self.keys, self.sums, self.parts, self.more = np.zeros(0, np.uint32), np.zeros(0), [], 0

    def add(self, key: bytes, times: bytes) -> None:
        self.parts.append((np.frombuffer(key, np.uint32), np.frombuffer(times, np.uint32)))
        self.more += len(key) // 4
        if self.more > BUCKET + len(self.keys):
            self.settle()

    def settle(self) -> None:
        if self.parts:
            every = np.concatenate([self.keys, *(k for k, _ in self.parts)])
            times = np.concatenate([self.sums, *(t for _, t in self.parts)])
            self.keys, which = np.unique(every, return_inverse=True)
            self.sums, self.parts, self.more = np.bincount(which, times, len(self.keys)), [], 0

    def of(self, wanted: np.ndarray) -> np.ndarray:
        self.settle()
        if not len(self.keys):
            return np.zeros(len(wanted))
        at = np.searchsorted(self.keys, wanted).clip(0, len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.sums[at], 0.0)


def _summed(homes: list, place: np.ndarray, home: int, losses: list[np.ndarray]) -> None:
    which, of = np.unique(place, return_inverse=True)
    homes.append((home, which.tobytes(), np.stack([np.bincount(of, x, len(which)) for x in losses], axis=1).tobytes()))


def _sums(out: list[tuple]) -> Batches:
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                         ["home", "places", "sums"])


def _priced_common(models: object) -> Callable[[Batches], Batches]:
    """Bucket by bucket: for each row of occurrences, the documents' losses, from the counts that came before."""
    def run(batches: Batches) -> Batches:
        now, counts = None, ()
        for batch in batches:
            out = []
            for bucket, turn, home, key, value in zip(*(batch.column(c).to_pylist() for c in _NAMES), strict=True):
                if bucket != now:
                    now, counts = bucket, (_Counts(), _Counts())
                if turn != _OCCURRENCES:
                    counts[turn].add(key, value)
                    continue
                wanted = np.frombuffer(key, np.uint32)
                ids = wanted * np.uint32(_BACK)
                context, word = (ids >> np.uint32(16)).astype(np.int64), (ids & np.uint32(0xFFFF)).astype(np.int64)
                _summed(out, np.frombuffer(value, np.uint16), home,
                        [models.value.losses(m, context, word, counts[m].of(wanted)) for m in (_BACKGROUND, _TARGET)])
            yield from _sums(out)
    return run


_SUMS = "home long, places binary, sums binary"

# --- bigrams with a rare word, in the bucket of that word -------------------------------------

_RARE = "bucket int, turn int, home long, owners binary, partners binary, values binary"
_RARE_NAMES = ["bucket", "turn", "home", "owners", "partners", "values"]
# turns: counts of words; counts of bigrams by key; occurrences after a common word, before one, and after a rare one
_WORDS, _RARE_BACKGROUND, _RARE_TARGET, _AFTER, _BEFORE, _RARE_PAIR = range(6)


def _rare_rows(turn: int, home: int, owners: np.ndarray, partners: np.ndarray, values: np.ndarray, buckets: int) -> Batches:
    """One row a bucket, for any order of ``owners``; partners may be none."""
    if not len(owners):
        return
    by = np.argsort(owners, kind="stable")
    owners, partners, values = owners[by], partners[by] if len(partners) else partners, values[by]
    ids, at = np.unique(_bucket(owners, buckets), return_index=True)
    cuts = list(zip(at, np.append(at, len(owners))[1:], strict=True))
    cut = lambda x: pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([turn] * len(ids), pa.int32()), pa.array([home] * len(ids), pa.int64()),
                                      cut(owners), cut(partners), cut(values)], _RARE_NAMES)


def _kinds(a: np.ndarray, b: np.ndarray) -> list[tuple[int, np.ndarray]]:
    return [(_AFTER, (a >= 0) & (b < 0)), (_BEFORE, (a < 0) & (b >= 0)), (_RARE_PAIR, (a < 0) & (b < 0))]


def _rare_sent(models: object, buckets: int) -> Callable[[Batches], Batches]:
    """Occurrences of bigrams with a rare word: it, its partner (an id, if common), and the place of the row."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            numbers = batch.column("row").to_numpy()
            for first, last, raw, offsets in slices(batch.column("text"), CHUNK):
                before, words, bounds = _bigrams(raw, offsets)
                a, b = _ids(models.value.words, before, words)
                row = np.repeat(numbers[first:last], np.diff(bounds))
                homes = row >> HOME_BITS
                for home in np.unique(homes):
                    here = homes == home
                    for turn, kind in _kinds(a, b):
                        pick = here & kind
                        partners = {_AFTER: a[pick].astype(np.uint16), _BEFORE: b[pick].astype(np.uint16), _RARE_PAIR: before[pick]}[turn]
                        yield from _rare_rows(turn, int(home), (before if turn == _BEFORE else words)[pick], partners, _places(row[pick]), buckets)
    return run


def _rare_counts(models: object, buckets: int, turn: int) -> Callable[[Batches], Batches]:
    """Counts of each chunk's bigrams with a rare word, by key."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for _, _, raw, offsets in slices(batch.column("text"), CHUNK):
                before, words, _ = _bigrams(raw, offsets)
                a, b = _ids(models.value.words, before, words)
                for kind, pick in _kinds(a, b):
                    key, at, times = np.unique(_key(before[pick], words[pick]), return_index=True, return_counts=True)
                    yield from _rare_rows(turn, 0, (before if kind == _BEFORE else words)[pick][at], key, times.astype(np.uint32), buckets)
    return run


def _asked(models: object, buckets: int) -> Callable[[Batches], Batches]:
    """(word, bucket): the rare contexts of rare words, and where their counts are needed."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for _, _, raw, offsets in slices(batch.column("text"), CHUNK):
                before, words, _ = _bigrams(raw, offsets)
                a, b = _ids(models.value.words, before, words)
                pick = (a < 0) & (b < 0)
                names, where = before[pick], _bucket(words[pick], buckets)
                by = np.lexsort((names, where))
                names, where = names[by], where[by]
                new = np.append(True, (names[1:] != names[:-1]) | (where[1:] != where[:-1]))[:len(names)]
                yield pa.RecordBatch.from_arrays([pa.array(names[new].view(np.int64)), pa.array(where[new], pa.int32())], ["word", "bucket"])
    return run


def _counts_sent(batches: Batches) -> Batches:
    """Counts of words, packed by bucket, many at a time."""
    columns = ("bucket", "word", "background", "target")
    waiting: list[tuple[np.ndarray, ...]] = []

    def sent() -> Batches:
        bucket, names, background, target = (np.concatenate(x) for x in zip(*waiting, strict=True))
        by = np.lexsort((names, bucket))
        bucket, names = bucket[by], names[by]
        # a rare word has less than one in COMMON of the background's words, but may fill the target
        background, target = background[by].astype(np.uint32), target[by].astype(np.uint64)
        ids, at = np.unique(bucket, return_index=True)
        cuts = list(zip(at, np.append(at, len(bucket))[1:], strict=True))
        cut = lambda x: pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array([_WORDS] * len(ids), pa.int32()), pa.array([0] * len(ids), pa.int64()),
                                          cut(names), cut(background), cut(target)], _RARE_NAMES)

    for batch in batches:
        waiting.append(tuple(batch.column(c).to_numpy() for c in columns))
        if sum(len(w[0]) for w in waiting) > COUNTS_SENT:
            yield from sent()
            waiting = []
    if any(len(w[0]) for w in waiting):
        yield from sent()


def _joined(rows: list[tuple], column: int, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(r[column] for r in rows), kind)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values (rows) of ``wanted`` among sorted keys, 0 where there are none."""
    if not len(keys):
        return np.zeros((len(wanted), *values.shape[1:]))
    at = np.searchsorted(keys, wanted).clip(0, len(keys) - 1)
    hit = keys[at] == wanted
    return np.where(hit[:, None] if values.ndim > 1 else hit, values[at], 0.0)


def _bucket_sums(turns: list[list[tuple]], models: Models, totals: Totals, same: bool) -> list[tuple]:
    """The losses of a bucket's occurrences, summed by home and place."""
    known, first = np.unique(_joined(turns[_WORDS], 1, np.uint64), return_index=True)
    of_word = np.stack([_joined(turns[_WORDS], 2, np.uint32), _joined(turns[_WORDS], 3, np.uint64)], axis=1)[first].astype(np.float64)
    key, place, home, context, word = [], [], [], [], []
    for turn in (_AFTER, _BEFORE, _RARE_PAIR):
        rows = turns[turn]
        owner, partner = _joined(rows, 1, np.uint64), _joined(rows, 2, np.uint64 if turn == _RARE_PAIR else np.uint16)
        own = _found(known, of_word, owner)
        if turn == _RARE_PAIR:
            other, name = _found(known, of_word, partner), partner
        else:
            other, name = models.contexts.T[partner], models.names[partner]
        key.append(_key(owner, name) if turn == _BEFORE else _key(name, owner))
        context.append(own if turn == _BEFORE else other)
        word.append(other if turn == _BEFORE else own)
        place.append(_joined(rows, 3, np.uint16))
        home.append(np.repeat(np.array([r[0] for r in rows], np.int64), [len(r[1]) // 8 for r in rows]))
    key, place, home, context, word = (np.concatenate(x) for x in (key, place, home, context, word))
    if not len(key):
        return []

    def counted(turn: int) -> np.ndarray:
        names, which = np.unique(_joined(turns[turn], 2, np.uint64), return_inverse=True)
        return _found(names, np.bincount(which, _joined(turns[turn], 3, np.uint32), len(names)), key)

    if same:
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        background = times[which].astype(float)
    else:
        background = counted(_RARE_BACKGROUND)
    losses = []
    for m, (times, every) in enumerate(((background, totals.background), (counted(_RARE_TARGET), totals.target))):
        seen = context[:, m]
        one = (word[:, m] + SMOOTHING) / (every + SMOOTHING * totals.kinds)
        given = np.divide(times, seen, out=np.zeros(len(times)), where=seen > 0)
        weight = np.where(seen > 0, BIGRAM_WEIGHT, 0.0)
        losses.append(-np.log(weight * given + (1 - weight) * one))
    spot, which = np.unique(home << HOME_BITS | place, return_inverse=True)
    sums = np.stack([np.bincount(which, x, len(spot)) for x in losses], axis=1)
    homes, at = np.unique(spot >> HOME_BITS, return_index=True)
    return [(int(h), _places(spot[a:b]).tobytes(), sums[a:b].tobytes()) for h, a, b in zip(homes, at, np.append(at, len(spot))[1:], strict=True)]


def _rare_priced(models: object, totals: Totals, same: bool) -> Callable[[Batches], Batches]:
    """Bucket by bucket, one in memory at a time: the documents' losses over their bigrams with rare words."""
    def run(batches: Batches) -> Batches:
        now, turns = None, [[] for _ in range(6)]
        for batch in batches:
            for bucket, turn, *row in zip(*(batch.column(c).to_pylist() for c in _RARE_NAMES), strict=True):
                if bucket != now:
                    yield from _sums(_bucket_sums(turns, models.value, totals, same))
                    now, turns = bucket, [[] for _ in range(6)]
                turns[turn].append(row)
        yield from _sums(_bucket_sums(turns, models.value, totals, same))
    return run


def _own(models: object) -> Callable[[Batches], Batches]:
    """The documents by home: their places, ids, words, and losses over the hot bigrams."""
    def run(batches: Batches) -> Batches:
        model = models.value
        for batch in batches:
            numbers = batch.column("row").to_numpy()
            for first, last, raw, offsets in slices(batch.column("text"), CHUNK):
                before, words, bounds = _bigrams(raw, offsets)
                a, b = _ids(model.words, before, words)
                both = _hot(a, b)
                doc = np.repeat(np.arange(last - first), np.diff(bounds))[both]
                a, b = a[both], b[both]
                sums = np.stack([np.bincount(doc, model.losses(m, a, b, model.hot[m][a * HOT + b]), last - first) for m in (0, 1)], axis=1)
                ids = batch.column("doc_id").slice(first, last - first).cast(pa.int64())
                row, n = numbers[first:last], np.diff(bounds).astype(np.int64)
                for home in np.unique(row >> HOME_BITS):
                    own = np.flatnonzero(row >> HOME_BITS == home)
                    taken = ids.take(pa.array(own))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(home)], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), taken),
                         pa.array([n[own].tobytes()], pa.binary()),
                         pa.array([(row[own] & ((1 << HOME_BITS) - 1)).astype(np.uint16).tobytes()], pa.binary()), pa.array([sums[own].tobytes()], pa.binary())],
                        ["home", "doc_ids", "words", "places", "sums"])
    return run


def _added(batches: Batches) -> Batches:
    """Home by home: the documents' rows, once all sums are added to their own."""
    now, ids, words, own, total = None, [], [], [], None

    def rows() -> Batches:
        if not ids:
            return
        n = np.concatenate(words)
        mean = np.divide(total[np.concatenate(own)], n[:, None], out=np.zeros((len(n), 2)), where=n[:, None] > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n), pa.array(mean[:, 1]), pa.array(mean[:, 0]), pa.array(mean[:, 1] - mean[:, 0])],
            ["doc_id", "n_words", "target_loss", "background_loss", "score"])

    for batch in batches:
        for home, doc_ids, n, places, sums in zip(*(batch.column(c).to_pylist() for c in ("home", "doc_ids", "words", "places", "sums")), strict=True):
            if home != now:
                yield from rows()
                now, ids, words, own, total = home, [], [], [], np.zeros((1 << HOME_BITS, 2))
            at = np.frombuffer(places, np.uint16)
            if doc_ids is not None:
                ids.extend(doc_ids)
                words.append(np.frombuffer(n, np.int64))
                own.append(at)
            total[at] += np.frombuffer(sums).reshape(-1, 2)
    yield from rows()


def numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row) of ``docs``: a number for each row, written with it, so all passes see the same."""
    return written(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), "lm-documents", compression="zstd")


def score(docs: DataFrame, background: DataFrame, target: DataFrame) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) of ``docs`` (doc_id, text).

    The background may be ``docs`` or a table of its own; bigrams of ``docs``
    that the background lacks have count 0 there.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    words = written(_both(_words, "word long", background, target, docs), "lm-words")
    totals = _totals(words)
    models = spark.sparkContext.broadcast(fit(background, target, words, totals))
    texts = numbered(docs)

    buckets = max(parts, totals.background // BUCKET + 1)
    counts = [df.select("text").mapInArrow(_common_counts(models, buckets, turn), _PACKED) for turn, df in ((_BACKGROUND, background), (_TARGET, target))]
    packed = counts[0].unionByName(counts[1]).unionByName(texts.mapInArrow(_sent(models, buckets), _PACKED))
    sums = _losses(packed, _priced_common(models), parts)
    if words.count() > COMMON:  # the start mark is one of them
        sums = sums.unionByName(_rare_sums(texts, words, models, totals, None if docs is background else background, target))
    own = (texts.mapInArrow(_own(models), "home long, doc_ids array<long>, words binary, places binary, sums binary")
           .select("home", F.lit(0).alias("turn"), "doc_ids", "words", "places", "sums"))
    return (own.unionByName(sums).repartition(parts, "home").sortWithinPartitions("home", "turn")
            .mapInArrow(_added, "doc_id long, n_words long, target_loss double, background_loss double, score double"))


def _losses(packed: DataFrame, priced: Callable, parts: int) -> DataFrame:
    """Sums by home of what comes packed by bucket."""
    rows = packed.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "turn").mapInArrow(priced, _SUMS)
    return rows.select("home", F.lit(1).alias("turn"), F.lit(None).cast("array<long>").alias("doc_ids"),
                       F.lit(None).cast("binary").alias("words"), "places", "sums")


def _rare_sums(texts: DataFrame, words: DataFrame, models: object, totals: Totals, background: DataFrame | None, target: DataFrame) -> DataFrame:
    """Losses over bigrams with a rare word; without a ``background`` of its own, the texts are it."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rare = words.join(F.broadcast(spark.createDataFrame([(int(w),) for w in models.value.names.view(np.int64)], "word long")), "word", "left_anti")  # COMMON at most
    # a word of rare ones is in two bigrams
    buckets = int(max(parts, 2 * (rare.agg(F.sum("background")).first()[0] or 0) // RARE_BUCKET + 1))
    of_owner = rare.mapInArrow(_owner_bucket(buckets), "word long, bucket int, background long, target long")
    of_context = texts.mapInArrow(_asked(models, buckets), "word long, bucket int").distinct().join(rare, "word").select("word", "bucket", "background", "target")
    packed = of_owner.unionByName(of_context).mapInArrow(_counts_sent, _RARE)
    for turn, corpus in ((_RARE_BACKGROUND, background), (_RARE_TARGET, target)):
        if corpus is not None:
            packed = packed.unionByName(corpus.select("text").mapInArrow(_rare_counts(models, buckets, turn), _RARE))
    packed = packed.unionByName(texts.mapInArrow(_rare_sent(models, buckets), _RARE))
    return _losses(packed, _rare_priced(models, totals, background is None), parts)


def _owner_bucket(buckets: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            names = batch.column("word").to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(_bucket(names, buckets), pa.int32()), batch.column("background"), batch.column("target")],
                                             ["word", "bucket", "background", "target"])
    return run
