"""Approximate nearest neighbours by collision counting.

Vectors are projected on ``PROJECTIONS`` random directions, and each block of
vectors keeps the values of each direction as one sorted array.  A query's
window on a direction is centred on its own value; the windows widen together
(virtual rehashing: no array is built anew).  A vector that falls into at least
``THRESHOLD`` of the windows has collided often enough and is verified: its
exact distance is taken.

Windows stop widening when the k-th best verified distance d is small for
their half-width h: a vector no further than d falls into one window with
probability erf(h / (d * sqrt 2)), so when that many windows exceed the
threshold by ``SURE`` standard deviations, hardly a nearer one is left out.
Otherwise they widen until every vector is verified; nothing is capped.

Every block sees every query, vectors first, queries then as a stream: memory
is one block, however many queries there are.  A block returns its k nearest,
and the best k of all blocks are the answer.

Defined cases: vectors that are null, zero, or hold null or non-finite numbers
take no part, nor do rows without an id; vectors of another length than the
query's are no candidates; rows of the query's id are its own; other repeated
rows are candidates each; ties go to the smaller id; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors of a block.
BLOCK = 16_384
PROJECTIONS = 96
THRESHOLD = 58
SURE = 2.0
#: Factor by which windows widen.
WIDEN = 1.2
SEED = 20_240_917
#: A query this many times as long as a block's vectors is compared with all of them.
FAR = 1e100

Batches = Iterator[pa.RecordBatch]


def _power(x: np.ndarray) -> float:
    """The largest power of two that is no larger than the largest number of ``x``."""
    return math.ldexp(0.5, math.frexp(float(np.abs(x).max()))[1])


class Block:
    """The sorted arrays of some vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        # by a power of two, which rounds nothing: squares of what is left neither overflow nor vanish
        self.scale = _power(vectors)
        self.ids, vectors = ids[order], vectors[order] / self.scale
        self.vectors = vectors
        self.axes = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        values = (self.vectors @ self.axes).T
        self.by = np.argsort(values, axis=1, kind="stable").astype(np.int32)
        values = np.take_along_axis(values, self.by, axis=1)
        # one array for all directions: each shifted beyond the one before
        self.middle = float(values.max() + values.min()) / 2
        self.span = float(values.max() - values.min()) + 1.0
        self.shift = np.arange(PROJECTIONS) * (2 * self.span) - self.middle
        self.flat = (values + self.shift[:, None]).ravel()

    def _windows(self, centre: np.ndarray, half: float) -> tuple[np.ndarray, np.ndarray]:
        """First and last place of each direction's window in its sorted array."""
        n, own = len(self.ids), np.arange(PROJECTIONS)
        low = np.searchsorted(self.flat, centre - half, "left") - own * n
        high = np.searchsorted(self.flat, centre + half, "right") - own * n
        return low.clip(0, n), high.clip(0, n)

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest found, nearest first."""
        n = len(self.ids)
        own = self.ids == query_id
        with np.errstate(over="ignore"):
            scaled = query / self.scale
        if not float(np.abs(scaled).max()) <= FAR:  # next to it all vectors are one point: projections tell nothing
            return self._all(query_id, query, k)
        query = scaled
        wanted = min(k, n - int(own.sum()))
        seen, distance = own.copy(), np.full(n, np.inf)
        plain = query @ self.axes
        centre, half = plain + self.shift, self.span / 64
        # this wide, every window holds every vector
        widest = self.span + float(np.abs(plain - self.middle).max())
        while wanted:
            low, high = self._windows(centre, half)
            hits = np.concatenate([self.by[j, a:b] for j, (a, b) in enumerate(zip(low.tolist(), high.tolist(), strict=True))])
            new = np.flatnonzero((np.bincount(hits, minlength=n) >= THRESHOLD) & ~seen)
            seen[new] = True
            distance[new] = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
            if half > widest:
                break
            worst = float(np.partition(distance, wanted - 1)[wanted - 1])
            p = math.erf(half / (worst * math.sqrt(2))) if worst > 0 else 1.0
            if PROJECTIONS * p - SURE * math.sqrt(PROJECTIONS * p * (1 - p)) >= THRESHOLD:
                break
            half *= WIDEN
        found = np.flatnonzero(np.isfinite(distance))
        best = found[np.lexsort((self.ids[found], distance[found]))[:k]]
        with np.errstate(over="ignore"):
            return self.ids[best], distance[best] * self.scale

    def _all(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest by the distances of all vectors."""
        scale = max(_power(query), self.scale)
        distance = np.sqrt(((self.vectors * (self.scale / scale) - query / scale) ** 2).sum(axis=1))
        found = np.flatnonzero(self.ids != query_id)
        best = found[np.lexsort((self.ids[found], distance[found]))[:k]]
        with np.errstate(over="ignore"):
            return self.ids[best], distance[best] * scale


def _vectors(column: pa.Array) -> list[np.ndarray]:
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _search(k: int) -> Callable[[Batches], Batches]:
    """Over blocks one after the other, each with its vectors first and then the queries."""
    def run(batches: Batches) -> Batches:
        now, waiting, built = None, [], {}
        for batch in batches:
            out: list[tuple[int, np.ndarray, np.ndarray]] = []
            for block, kind, vec_id, vector in zip(batch.column("block").to_pylist(), batch.column("kind").to_pylist(),
                                                   batch.column("vec_id").to_pylist(), _vectors(batch.column("vector")), strict=True):
                if block != now:
                    now, waiting, built = block, [], {}
                if kind == 0:
                    waiting.append((vec_id, vector))
                    continue
                if waiting:
                    built = {size: Block(np.array([i for i, v in waiting if len(v) == size]),
                                         np.array([v for _, v in waiting if len(v) == size]))
                             for size in {len(v) for _, v in waiting}}
                    waiting = []
                if len(vector) in built:
                    ids, distances = built[len(vector)].nearest(vec_id, vector, k)
                    out.append((vec_id, ids, distances))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _ in out], [len(i) for _, i, _ in out]), pa.int64()),
                     pa.array(np.concatenate([i for _, i, _ in out]), pa.int64()),
                     pa.array(np.concatenate([d for _, _, d in out]), pa.float64())], ["query_id", "vec_id", "score"])
    return run


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of ``vectors`` to each of ``queries``.

    Both have vec_id and embedding; score is the Euclidean distance.
    """
    def part(df: DataFrame) -> DataFrame:
        return df.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
            F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))

    rows = part(vectors)
    blocks = int(max(1, -(-rows.count() // block)))
    # a hash of the row's number deals evenly, whatever the partitions hold
    dealt = rows.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"), "vec_id", "vector")
    asked = part(queries).groupBy("vec_id").agg(F.min("vector").alias("vector")).select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "vec_id", "vector")
    found = (dealt.unionByName(asked).repartitionById(blocks, "block").sortWithinPartitions("block", "kind")
             .mapInArrow(_search(k), "query_id long, vec_id long, score double"))
    first = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
