"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Documents are sets of word n-grams (64-bit hashes; equal hashes count as equal
n-grams).  Two sets of Jaccard similarity t or more share at least
``need = ceil(t * n)`` n-grams of either.  With all n-grams in one global order,
the first ``n - need + l`` of both sets share at least l: the l-prefix.  A
document picks the l that makes its estimated candidate cost least, and a pair
must share ``min`` of its two l's among the prefixes before it is verified on
the whole sets.

The work, in steps that each only keep what can still link:

1. *Classes.*  Documents with equal sets are one class from here on.
2. *Screens.*  A class of which more than a share 1 - t of all n-grams is seen
   to be in no other class can link with none.  The first screen looks up a
   fixed quarter of all n-grams (by hash), the second, among the classes that
   the first leaves, all of theirs.  N-grams travel packed, at most once per
   task and class, and one that several classes of a task have is sent once: a
   common passage costs each task a row, not each document.
3. *Order.*  The classes left get the document frequency of all their n-grams,
   which orders them, rarest first.  What only one class has counts in its set
   size alone; it also bounds the partner's size.
4. *Stars.*  Each prefix n-gram names one class of two different groups as
   centres; a class is compared with the centre that most of its prefix n-grams
   name.  In a large group of near copies this links nearly all of them without
   looking at pairs.
5. *Pairs.*  Classes of different groups whose prefixes still share an n-gram
   are dealt into blocks by the most frequent such n-gram, so that most partners
   share a block; a class travels once to each block that shares an n-gram with
   it.  Where two blocks meet, classes of different groups that share min(l, l)
   n-grams of their prefixes, and could still be similar by what lies behind, are
   verified on whole sets.  Classes of one group are not compared, nor are
   groups that a link has joined already.

Components of verified links give each document the smallest id it can reach.

Defined cases: a text with fewer words than n is one n-gram, its whole word
sequence; a null text, or one without words, has an empty set and links with
nothing; a null id takes part but is never the smallest; repeated rows are one
class; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import discard, written
from weir.llm.graph import components
from weir.llm.text import document_shingles, mix, slices

#: Share of n-grams in the screens: one in 2 ** bits.
SCREENS = (2, 0)
#: N-grams that a task sends at a time, that a bucket of a screen holds, and that a block of sets holds, about.
SENT, BUCKET, BLOCK = 1_000_000, 2_000_000, 1_000_000
#: Classes whose counts are added up in one place, about.
TALLY = 2_000_000
#: Classes that are compared with one centre in one place, at most, about.
SPOKES = 10_000
#: Rounds of stars before pairs are looked at; they change no result.
STAR_ROUNDS = 1
#: Words of 64 bits in the bitmap that keeps rows from a shuffle: its size is fixed, however many rows it is for.
BITMAP = 1 << 17
#: Longest multi-match tried, and the cost of verifying a pair against reading one posting.
MAX_MATCHES = 16
VERIFY_COST = 16.0

_SET = "doc_id long, row long, n_shingles long, screened long, node binary"
_GRAMS = "bucket int, kind int, grams binary, nodes binary, runs binary"
# kinds of rows: n-grams of one class of a task, n-grams of several, classes with counts
_ALONE, _COMMON, _COUNTED = 0, 1, 2
Batches = Iterator[pa.RecordBatch]


def _two(grams: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set: its fingerprint."""
    with np.errstate(over="ignore"):
        return (int(mix(grams ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)),
                int(mix(grams ^ np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64)))


def _node(grams: np.ndarray) -> bytes:
    a, b = _two(grams)
    return a.to_bytes(8, "big") + b.to_bytes(8, "big")


def _sets(size: int) -> Callable[[Batches], Batches]:
    """Fingerprint and size of each document's set."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for first, last, raw, offsets in slices(batch.column("text")):
                sizes, screened, nodes = [], [], []
                for grams in document_shingles(raw, offsets, size):
                    sizes.append(len(grams))
                    screened.append(len(_screened(grams, SCREENS[0])))
                    nodes.append(_node(grams) if len(grams) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first).cast(pa.int64()), batch.column("row").slice(first, last - first), pa.array(sizes, pa.int64()),
                     pa.array(screened, pa.int64()), _binary(nodes)], ["doc_id", "row", "n_shingles", "screened", "node"])
    return run


def _screened(grams: np.ndarray, bits: int) -> np.ndarray:
    return grams[(grams & np.uint64((1 << bits) - 1)) == 0]


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _packed(size: int, bits: int, buckets: int) -> Callable[[Batches], Batches]:
    """A screen's n-grams with the first half of their class's fingerprint, by bucket.

    An n-gram that one class of the batch has is sent with that class.  One that
    several have is sent once without; those classes are counted here and now.
    In its bucket an n-gram goes by 32 bits of its hash: two that fall together
    only look seen.
    """
    names = ["bucket", "kind", "grams", "nodes", "runs"]

    def sent(sets: dict[int, np.ndarray]) -> Batches:
        grams = np.concatenate(list(sets.values()))
        nodes = np.repeat(np.fromiter(sets, np.uint64, len(sets)), [len(g) for g in sets.values()])
        order = np.argsort(grams, kind="stable")
        grams, nodes = grams[order], nodes[order]
        new = np.ones(len(grams), bool)
        new[1:] = grams[1:] != grams[:-1]
        alone = new & np.append(new[1:], True)[:len(new)]
        known, times = np.unique(nodes[~alone], return_counts=True)
        if len(known):
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(known[0]) % buckets], pa.int32()), pa.array([_COUNTED], pa.int32()),
                 _binary([b""]), _binary([known.tobytes()]), _binary([times.astype(np.uint32).tobytes()])], names)
        for kind, pick in ((_ALONE, alone), (_COMMON, new & ~alone)):
            g, n = grams[pick], nodes[pick]
            if not len(g):
                continue
            bucket = ((g >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((n, bucket)) if kind == _ALONE else np.argsort(bucket, kind="stable")
            g, n, bucket = ((g[by] >> np.uint64(8)) & np.uint64(0xFFFFFFFF)).astype(np.uint32), n[by], bucket[by]
            ids, at = np.unique(bucket, return_index=True)
            ends = np.append(at[1:], len(g))
            heads, runs = [b""] * len(ids), [b""] * len(ids)
            if kind == _ALONE:
                for k, (a, b) in enumerate(zip(at, ends, strict=True)):
                    first = np.flatnonzero(np.append(True, n[a + 1:b] != n[a:b - 1]))
                    heads[k] = n[a:b][first].tobytes()
                    runs[k] = np.diff(np.append(first, b - a)).astype(np.uint32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int32()), pa.array([kind] * len(ids), pa.int32()),
                 _binary([g[a:b].tobytes() for a, b in zip(at, ends, strict=True)]), _binary(heads), _binary(runs)], names)

    def run(batches: Batches) -> Batches:
        sets: dict[int, np.ndarray] = {}
        waiting = 0
        for batch in batches:
            for _, _, raw, offsets in slices(batch.column("text")):
                for grams in document_shingles(raw, offsets, size):
                    if len(grams):
                        node = _two(grams)[0]
                        if node not in sets:
                            sets[node] = _screened(grams, bits)
                            waiting += len(sets[node])
                if waiting > SENT:
                    yield from sent(sets)
                    sets, waiting = {}, 0
        if sets:
            yield from sent(sets)
    return run


def _credited(nodes: np.ndarray, counts: np.ndarray, ranges: int) -> pa.RecordBatch:
    """Counts of classes, packed by range of their fingerprints."""
    part = ((nodes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
    by = np.argsort(part, kind="stable")
    nodes, counts, part = nodes[by], counts[by].astype(np.uint32), part[by]
    ids, at = np.unique(part, return_index=True)
    cuts = list(zip(at, np.append(at[1:], len(part)), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), _binary([nodes[a:b].tobytes() for a, b in cuts]),
                                       _binary([counts[a:b].tobytes() for a, b in cuts])], ["part", "nodes", "counts"])


def _settled(alone: list[tuple[bytes, bytes, bytes]], common: list[bytes], ranges: int) -> Batches:
    """Classes of one bucket with the number of their n-grams that others have."""
    g = np.frombuffer(b"".join(x for x, _, _ in alone), np.uint32)
    if not len(g):
        return
    n = np.repeat(np.frombuffer(b"".join(x for _, x, _ in alone), np.uint64), np.frombuffer(b"".join(x for _, _, x in alone), np.uint32))
    order = np.lexsort((n, g))
    g, n = g[order], n[order]
    start = np.ones(len(g), bool)
    start[1:] = g[1:] != g[:-1]
    first = np.flatnonzero(start)
    several = n[first] != n[np.append(first[1:], len(g)) - 1]  # classes are sorted within an n-gram
    several |= np.isin(g[first], np.frombuffer(b"".join(common), np.uint32))
    once = start | np.append([True], n[1:] != n[:-1])  # copies in several tasks are one class
    found, times = np.unique(n[several[np.cumsum(start) - 1] & once], return_counts=True)
    if len(found):
        yield _credited(found, times, ranges)


def _credits(ranges: int) -> Callable[[Batches], Batches]:
    """Classes with n-grams that others have, and how many, bucket by bucket: one bucket in memory at a time."""
    def run(batches: Batches) -> Batches:
        now, alone, common = None, [], []
        for batch in batches:
            for bucket, kind, grams, nodes, runs in zip(*(batch.column(c).to_pylist() for c in ("bucket", "kind", "grams", "nodes", "runs")), strict=True):
                if kind == _COUNTED:
                    yield _credited(np.frombuffer(nodes, np.uint64), np.frombuffer(runs, np.uint32), ranges)
                    continue
                if bucket != now:
                    yield from _settled(alone, common, ranges)
                    now, alone, common = bucket, [], []
                if kind == _COMMON:
                    common.append(grams)
                else:
                    alone.append((grams, nodes, runs))
        yield from _settled(alone, common, ranges)
    return run


def _tallied(batches: Batches) -> Batches:
    """(half, shared) of each class of a range, ranges one after the other."""
    now, nodes, sums, parts = None, np.zeros(0, np.uint64), np.zeros(0), []

    def added() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([nodes, *(np.frombuffer(n, np.uint64) for n, _ in parts)])
        times = np.concatenate([sums, *(np.frombuffer(c, np.uint32) for _, c in parts)])
        found, which = np.unique(every, return_inverse=True)
        return found, np.bincount(which, times, len(found))

    def rows() -> Batches:
        found, total = added()
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(total.astype(np.int64))], ["half", "shared"])

    for batch in batches:
        for part, ids, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "nodes", "counts")), strict=True):
            if part != now:
                yield from rows()
                now, nodes, sums, parts = part, np.zeros(0, np.uint64), np.zeros(0), []
            parts.append((ids, counts))
            if len(parts) >= 256:
                nodes, sums = added()
                parts = []
    yield from rows()


def _gram_sets(size: int) -> Callable[[Batches], Batches]:
    """The whole set of each class, from the text of one of its documents."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for first, last, raw, offsets in slices(batch.column("text")):
                sets = list(document_shingles(raw, offsets, size))
                ends = np.concatenate([[0], np.cumsum([len(g) for g in sets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cls").slice(first, last - first), pa.ListArray.from_arrays(ends, np.concatenate(sets).view(np.int64))], ["cls", "grams"])
    return run


def document_sets(docs: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, row, n_shingles, screened, node): set size and fingerprint; node is null for an empty set."""
    return _named(docs).mapInArrow(_sets(size), _SET)


def named() -> Column:
    """A name of a row by its content."""
    return F.xxhash64("doc_id", "text")


def _named(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", named().alias("row"))


def _screen(texts: DataFrame, classes: DataFrame, size: int, percent: int, bits: int) -> DataFrame:
    """Those of ``classes`` that a screen over ``texts`` can't rule out."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    looked_up = F.col("screened") if bits else F.col("n")
    sums = classes.agg(F.sum(looked_up), F.count(F.lit(1))).first()
    buckets, ranges = max(parts, (sums[0] or 0) // BUCKET + 1), max(parts, sums[1] // TALLY + 1)
    seen = (texts.select("text").mapInArrow(_packed(size, bits, buckets), _GRAMS)
            .repartitionById(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_credits(ranges), "part int, nodes binary, counts binary")
            .repartitionById(parts, "part").sortWithinPartitions("part").mapInArrow(_tallied, "half long, shared long"))
    unseen = looked_up - F.coalesce(F.col("shared"), F.lit(0))
    return written(classes.join(seen, "half", "left").where(100 * unseen <= (100 - percent) * F.col("n")).select(*classes.columns), "ngram-screened")


def _texts(docs: DataFrame, left: DataFrame) -> DataFrame:
    """(cls, text): for each class in ``left`` the document that stands for it, as often as it is there.

    A bitmap of the names of the rows that are wanted is broadcast first; it
    keeps most other texts where they are.
    """
    which = left.select("cls", F.col("at.row").alias("of"), F.col("at.doc_id").alias("id"))
    word = lambda c: F.pmod(F.shiftright(c, 6), F.lit(BITMAP))
    bit = lambda c: F.expr(f"shiftleft(1L, cast({c} & 63 as int))")
    bits = which.groupBy(word(F.col("of")).alias("word")).agg(F.bit_or(bit("of")).alias("bits"))
    likely = (_named(docs).withColumn("word", word(F.col("row"))).join(F.broadcast(bits), "word")  # BITMAP rows at most
              .where(F.col("bits").bitwiseAND(bit("row")) != 0))
    return likely.join(which, (F.col("row") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("cls", "text")


def _prepared(docs: DataFrame, left: DataFrame, size: int, percent: int) -> DataFrame:
    """The classes left, with what they share, rarest n-gram first, and the sizes a partner can have."""
    texts = _texts(docs, left).groupBy("cls").agg(F.min("text").alias("text"))
    sets = written(texts.mapInArrow(_gram_sets(size), "cls long, grams array<long>"), "ngram-sets")
    grams = sets.select("cls", F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rows = (grams.join(often, "gram").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("shared"))
            .join(left.select("cls", "n"), "cls"))
    need = F.ceil(F.lit(percent) * F.col("n") / 100).cast("long")
    most = F.floor((100 + percent) * F.size("shared") / F.lit(percent)).cast("long") - F.col("n")
    fitting = rows.withColumn("need", need).withColumn("most", most).where("most >= need").withColumn("matches", _matches())
    # n-grams of one class alone are the rarest; the prefix begins with them
    length = F.col("n") - F.col("need") + F.col("matches") - (F.col("n") - F.size("shared"))
    found = written(fitting.select("cls", "n", "need", "most", "matches", F.greatest(F.least(length, F.size("shared")), F.lit(0)).cast("int").alias("front"),
                                   F.transform("shared", lambda x: x["gram"]).alias("grams")), "ngram-classes")
    discard(sets)
    return found


def _matches() -> Column:
    """The l with the least estimated cost: postings read, and candidates they can make.

    A candidate with l matches takes l of the postings, so postings over l
    bound the candidates.
    """
    unshared = F.col("n") - F.size("shared")

    def cost(matches: Column) -> Column:
        taken = F.greatest(F.col("n") - F.col("need") + matches - unshared, F.lit(0)).cast("int")
        postings = F.aggregate(F.slice("shared", F.lit(1), taken), F.lit(0.0), lambda s, x: s + x["df"])
        return F.struct((postings * (1 + VERIFY_COST / matches)).alias("cost"), matches.alias("matches"))

    tried = F.sequence(F.lit(1), F.least(F.lit(MAX_MATCHES), F.col("need")).cast("int"))
    return F.array_min(F.transform(tried, cost))["matches"]


def _shared(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted ``own`` each of ``others`` has."""
    if not len(own):
        return np.zeros(len(others), np.int64)
    theirs = np.concatenate(others)
    hit = own[np.searchsorted(own, theirs).clip(0, len(own) - 1)] == theirs
    total = np.concatenate([[0], np.cumsum(hit)])
    bounds = np.concatenate([[0], np.cumsum([len(o) for o in others])])
    return total[bounds[1:]] - total[bounds[:-1]]


def _lists(column: pa.Array) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _spokes(percent: int) -> Callable[[Batches], Batches]:
    """Centre by centre, its set first, then the sets to compare with it: those that are similar."""
    def run(batches: Batches) -> Batches:
        now, n, own = None, 0, np.zeros(0, np.int64)
        for batch in batches:
            centres, kinds, classes, sizes = (batch.column(c).to_pylist() for c in ("centre", "kind", "cls", "n"))
            sets = _lists(batch.column("grams"))
            out = []
            at = 0
            while at < len(sets):
                if kinds[at] == 0:
                    now, n, own = centres[at], sizes[at], np.sort(sets[at])
                    at += 1
                    continue
                end = at
                while end < len(sets) and kinds[end] and centres[end] == now:
                    end += 1
                if end == at:
                    raise ValueError("a centre has no set")
                shared = _shared(own, sets[at:end])
                similar = 100 * shared >= percent * (n + np.array(sizes[at:end]) - shared)
                out += [(now, c) for c, s in zip(classes[at:end], similar, strict=True) if s]
                at = end
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])
    return run


class _Block:
    """Classes of a block, with their prefixes in one sorted array."""

    def __init__(self, rows: list[tuple]):
        self.cls, self.root, self.n, self.need, self.most, self.matches = (np.array(c, np.int64) for c in list(zip(*rows, strict=True))[:6])
        self.fronts = [g[:f] for *_, f, g in rows]
        self.behind = np.array([len(g) - f for *_, f, g in rows])
        self.sets = [np.sort(g) for *_, g in rows]
        self.roots, kind = np.unique(self.root, return_inverse=True)
        grams = np.concatenate(self.fronts)
        of = np.repeat(np.arange(len(rows)), [len(f) for f in self.fronts])
        self.grams, rank = np.unique(grams, return_inverse=True)
        # postings in the order of (n-gram, group)
        key = rank * (len(self.roots) + 1) + kind[of]
        by = np.argsort(key, kind="stable")
        self.key, self.of = key[by], of[by]

    def met(self, front: np.ndarray, root: int) -> np.ndarray:
        """For each class, the n-grams of ``front`` in its prefix; those of the group ``root`` meet none."""
        width, at = len(self.roots) + 1, np.searchsorted(self.grams, front)
        at = at[at < len(self.grams)]
        at = at[np.isin(self.grams[at], front)]
        own = int(np.searchsorted(self.roots, root))
        there = own < len(self.roots) and self.roots[own] == root
        cuts = [np.searchsorted(self.key, at * width + k) for k in ((0, own, own + 1, width) if there else (0, width))]
        found = [self.of[a:b] for lo, hi in zip(cuts[::2], cuts[1::2], strict=True) for a, b in zip(lo.tolist(), hi.tolist(), strict=True) if a < b]
        return np.bincount(np.concatenate(found), minlength=len(self.cls)) if found else np.zeros(len(self.cls), np.int64)


def _linked(x: _Block, y: _Block, percent: int) -> list[tuple[int, int]]:
    """Similar pairs of classes in different groups; groups that one joins are one group from then on."""
    joined: dict[int, int] = {}

    def group(r: int) -> int:
        while r in joined:
            r = joined[r]
        return r

    links = []
    for i in range(len(x.cls)):
        n, root = int(x.n[i]), int(x.root[i])
        met = y.met(x.fronts[i], root)
        reach = met + np.maximum(y.behind, x.behind[i])
        # what is shared up to the end of the shorter prefix has been met; of the rest, no more can be shared than either has
        fits = ((met > 0) & (met >= np.minimum(y.matches, x.matches[i])) & (y.n >= x.need[i]) & (y.n <= x.most[i]) & (n >= y.need) & (n <= y.most)
                & (100 * reach >= percent * (n + y.n - reach)))
        if x is y:
            fits[:i + 1] = False
        mine = group(root)
        partners = [j for j in np.flatnonzero(fits).tolist() if group(int(y.root[j])) != mine]
        if not partners:
            continue
        shared = _shared(x.sets[i], [y.sets[j] for j in partners])
        for j in np.array(partners)[100 * shared >= percent * (n + y.n[partners] - shared)].tolist():
            mine, theirs = group(root), group(int(y.root[j]))
            if mine != theirs:
                joined[theirs] = mine
                links.append((int(x.cls[i]), int(y.cls[j])))
    return links


def _meetings(percent: int, blocks: int) -> Callable[[Batches], Batches]:
    """Meeting by meeting of two blocks, or of one with itself: links between groups."""
    def settled(meet: int | None, rows: list[tuple]) -> Batches:
        if meet is None:
            return
        sides = [_Block([r[1:] for r in rows if r[0] == side]) if any(r[0] == side for r in rows) else None
                 for side in dict.fromkeys((meet // blocks, meet % blocks))]
        if None not in sides:
            links = _linked(sides[0], sides[-1], percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])

    def run(batches: Batches) -> Batches:
        now, rows = None, []
        for batch in batches:
            plain = [batch.column(c).to_pylist() for c in ("meet", "block", "cls", "root", "n", "need", "most", "matches", "front")]
            for meet, *row, grams in zip(*plain, _lists(batch.column("grams")), strict=True):
                if meet != now:
                    yield from settled(now, rows)
                    now, rows = meet, []
                rows.append((*row, grams))
        yield from settled(now, rows)
    return run


def _stars(known: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links of classes with a centre, written: of the first and the last group in a posting list, one of another than their own."""
    ends = (known.groupBy("gram", "root").agg(F.min(F.struct("cls", "n", "need", "most")).alias("c"))
            .groupBy("gram").agg(F.min(F.struct("root", "c")).alias("lo"), F.max(F.struct("root", "c")).alias("hi")).where("lo.root <> hi.root"))
    centre = F.when(F.col("root") == F.col("lo.root"), F.col("hi.c")).otherwise(F.col("lo.c"))
    rays = known.join(ends, "gram").select("cls", "n", "need", "most", centre.alias("y"))
    rays = rays.where(F.col("y.n").between(F.col("need"), F.col("most")) & F.col("n").between(F.col("y.need"), F.col("y.most")))
    counted = rays.groupBy("cls", F.col("y.cls").alias("centre")).agg(F.count(F.lit(1)).alias("named"))
    best = written(counted.groupBy("cls").agg(F.max(F.struct("named", "centre")).alias("best")).select("cls", "best.centre"), "ngram-spokes")
    # a large star is split, and its centre is sent to each part
    sizes = best.groupBy("centre").agg(F.ceil(F.count(F.lit(1)) / SPOKES).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("part")
    sets = classes.select("cls", "n", "grams")
    rim = sets.join(best.join(sizes, "centre").select("cls", "centre", part), "cls").select("centre", "part", F.lit(1).alias("kind"), "cls", "n", "grams")
    hubs = (sets.join(sizes.select(F.col("centre").alias("cls"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), "cls")
            .select(F.col("cls").alias("centre"), "part", F.lit(0).alias("kind"), "cls", "n", "grams"))
    found = written(rim.unionByName(hubs).repartition("centre", "part").sortWithinPartitions("centre", "part", "kind")
                    .mapInArrow(_spokes(percent), "a long, b long"), "ngram-links")
    discard(best)
    return found


def _pairs(known: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links between groups that still meet in a prefix n-gram, written: enough of them to connect what is linked."""
    open_grams = (known.groupBy("gram").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"))
                  .where("lo <> hi").select("gram", "size"))
    rest = written(known.join(open_grams, "gram").select("cls", "root", "n", "gram", "size"), "ngram-open")
    keyed = rest.groupBy("cls", "root", "n").agg(F.max(F.struct("size", "gram")).alias("key")).select("cls", "root", "n", "key.gram")
    loads = keyed.groupBy("gram").agg(F.sum("n").alias("load"))
    blocks = int(max(8, (keyed.agg(F.sum("n")).first()[0] or 0) // BLOCK + 1))
    split = F.pmod(F.xxhash64("cls"), F.ceil(F.col("load") / BLOCK))
    placed = written(keyed.join(loads, "gram").select("cls", "root", F.pmod(F.xxhash64("gram", split), F.lit(blocks)).alias("block")), "ngram-blocks")
    postings = rest.select("cls", "gram").join(placed, "cls")
    there = postings.select("gram", F.col("block").alias("other")).distinct()
    meet = (F.least("block", "other") * blocks + F.greatest("block", "other")).alias("meet")
    asked = postings.join(there, "gram").select("cls", "root", "block", meet).distinct()
    found = written(asked.join(classes, "cls").repartition("meet").sortWithinPartitions("meet")
                    .select("meet", "block", "cls", "root", "n", "need", "most", "matches", "front", "grams")
                    .mapInArrow(_meetings(percent, blocks), "a long, b long"), "ngram-links")
    discard(rest, placed)
    return found


def _links(classes: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the classes that link with another, written."""
    prefixes = written(classes.select("cls", "n", "need", "most", F.explode(F.slice("grams", F.lit(1), F.col("front"))).alias("gram")), "ngram-prefixes")

    def grouped(linked: DataFrame | None) -> DataFrame:
        if linked is None:
            return prefixes.withColumn("root", F.col("cls"))
        return prefixes.join(linked.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))

    links, linked = None, None
    for look in [_stars] * STAR_ROUNDS + [_pairs]:
        more = look(grouped(linked), classes, percent)
        if not more.isEmpty():
            links, linked = _joined(links, more, linked)
    discard(prefixes)
    if linked is None:
        return classes.select(F.col("cls").alias("node"), F.col("cls").alias("root")).limit(0)
    discard(links)
    return linked


def _joined(links: DataFrame | None, more: DataFrame, linked: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """All links so far, written, and what they connect."""
    if links is None:
        return more, components(more)
    every = written(links.unionByName(more), "ngram-links")
    found = components(every)
    discard(links, linked)
    return every, found


def join_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, row) of every row of ``docs``.

    Rows link when 100 * shared >= percent * united; component_id is the
    smallest doc_id that links reach, the row's own included; row is the hash
    of id and text that :func:`named` gives it.
    """
    return join_groups(docs, size, percent).drop("root")


def join_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of :func:`join_components` with ``root``, a number that names their group even without any id; null without words."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be in 1..100")
    sets = written(document_sets(docs, size), "ngram-documents")
    full = sets.where("node IS NOT NULL")
    classes = written(full.groupBy("node").agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("first_id"),
                                               F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("at"),
                                               F.first("screened").alias("screened"))
                      .withColumn("cls", F.monotonically_increasing_id()), "ngram-nodes")
    half = F.conv(F.substring(F.hex("node"), 1, 16), 16, -10).cast("long")
    first = _screen(docs, classes.select("cls", "n", "screened", "at", half.alias("half")), size, percent, SCREENS[0])
    left = _screen(_texts(docs, first), first, size, percent, SCREENS[1])
    shared = _prepared(docs, left, size, percent)
    linked = _links(shared, percent)
    discard(first, left, shared)
    named = classes.select("node", "first_id", "cls").join(linked.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    smallest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_node = named.join(smallest, "root").select("node", "component_id", "root")
    found = full.join(of_node, "node").select("doc_id", "n_shingles", "component_id", "row", "root")
    return found.unionByName(sets.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "row",
                                                               F.lit(None).cast("long").alias("root")))
