"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts lower-cased n-grams of 1 to 3 characters (anything but letters
reads as a space) in 2 ** HASH_BITS cells per label.  Tasks add up their own
counts; the sums travel in blocks of cells and are merged as a stream.  The
finished log-probability matrix, labels x cells, is the only thing broadcast:
at most ``MAX_LABELS`` x 256 KiB, whatever the size of the corpus.  Scoring
goes label by label over the flat n-grams of a run of documents in numpy.

Defined cases: a null text, or one without a letter, is ``und`` with score 0,
as is every text when there is nothing to learn from; documents without a label
do not train; repeated rows each count; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import carried_columns, id_text, scored
from weir.llm.text import characters, slices

HASH_BITS = 15
CELLS = 1 << HASH_BITS
BLOCK = 1 << 10
#: Bound of the broadcast matrix; more labels than this are refused.
MAX_LABELS = 256
#: Labels a task sums up before it sends them on.
LABELS_AT_ONCE = 64
SMOOTHING = 0.5
UNKNOWN = "und"

Batches = Iterator[pa.RecordBatch]


def _cells(raw: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(cells of n-grams by n, bounds, has a letter); cell CELLS: no n-gram begins here."""
    points, letter, bounds = characters(raw, offsets)
    x = np.where(letter, points, np.uint32(32)).astype(np.uint32)
    ends = bounds[1:][np.diff(bounds) > 0]
    out, key = [], np.zeros(len(x), np.uint32)
    for n in (1, 2, 3):
        follow = np.zeros(len(x), np.uint32)
        follow[:len(x) - (n - 1)] = x[n - 1:]
        key = key * np.uint32(0x01000193) + follow + np.uint32(n)
        cell = ((key ^ (key >> np.uint32(15))) * np.uint32(0x9E3779B1) >> np.uint32(32 - HASH_BITS)).astype(np.int32)
        for back in range(1, n):
            # n-grams that would run into the next document
            at = ends - back
            cell[at[at >= 0]] = CELLS
        out.append(cell)
    seen = np.zeros(len(letter) + 1, np.int64)
    np.cumsum(letter, out=seen[1:])
    return out, bounds, seen[bounds[1:]] > seen[bounds[:-1]]


def _counted(batches: Batches) -> Batches:
    """Blocks of n-gram counts per label, summed over the task."""
    sums: dict[str, np.ndarray] = {}

    def sent() -> Batches:
        for label, total in sums.items():
            for block, part in enumerate(total.reshape(-1, BLOCK)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label]), pa.array([block], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    ["label", "block", "counts"])
        sums.clear()

    for batch in batches:
        labels = batch.column("lang").to_pylist()
        for first, last, raw, offsets in slices(batch.column("text")):
            names, of = np.unique(np.array(labels[first:last], object).astype(str), return_inverse=True)
            cells, bounds, _ = _cells(raw, offsets)
            base = np.repeat(of * (CELLS + 1), np.diff(bounds))
            total = sum(np.bincount(base + c, minlength=len(names) * (CELLS + 1)) for c in cells)
            for name, row in zip(names, np.asarray(total).reshape(len(names), CELLS + 1), strict=True):
                sums[str(name)] = sums.get(str(name), 0) + row[:CELLS].astype(np.int64)
            if len(sums) > LABELS_AT_ONCE:
                yield from sent()
    yield from sent()


def _merged(batches: Batches) -> Batches:
    """Sums of equal (label, block), which arrive next to each other."""
    now, total = None, None
    for batch in batches:
        for label, block, counts in zip(*(batch.column(c).to_pylist() for c in ("label", "block", "counts")), strict=True):
            part = np.frombuffer(counts, np.int64)
            if (label, block) == now:
                total = total + part
                continue
            if now is not None:
                yield _block(now, total)
            now, total = (label, block), part
    if now is not None:
        yield _block(now, total)


def _block(key: tuple[str, int], total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([total.tobytes()], pa.binary())],
        ["label", "block", "counts"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(labels, matrix) from the rows of ``docs`` (text, lang) that have a lang.

    A row of the matrix has the log-probabilities of the cells for a label,
    then 0 (for no n-gram), then the level (mean log-probability of an n-gram)
    of the label's own training texts, then the log prior.
    """
    known = docs.where(F.col("lang").isNotNull())
    many = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MAX_LABELS + 1).collect()}
    if len(many) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: the broadcast matrix has no bound")
    labels = sorted(many)
    kind = "label string, block int, counts binary"
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = (known.select("text", "lang").mapInArrow(_counted, kind)
              .repartition(parts, "label", "block").sortWithinPartitions("label", "block").mapInArrow(_merged, kind))
    counts = np.zeros((len(labels), CELLS))
    row = {name: i for i, name in enumerate(labels)}
    for r in blocks.collect():  # labels x CELLS numbers
        counts[row[r["label"]], r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(bytes(r["counts"]), np.int64)
    matrix = np.zeros((len(labels), CELLS + 3))
    if labels:
        smooth = counts + SMOOTHING
        matrix[:, :CELLS] = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True))
        matrix[:, -2] = (counts * matrix[:, :CELLS]).sum(axis=1) / np.maximum(counts.sum(axis=1), 1)
        docs_of = np.array([many[name] for name in labels], float)
        matrix[:, -1] = np.log(docs_of / docs_of.sum())
    return labels, matrix


def _scorer(labels: list[str], model: object) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        matrix = model.value
        names = np.array([*labels, UNKNOWN], object)
        for batch in batches:
            best, score, fit = [], [], []
            for _, _, raw, offsets in slices(batch.column("text")):
                cells, bounds, lettered = _cells(raw, offsets)
                n = len(bounds) - 1
                full = np.diff(bounds) > 0
                logs = np.zeros((len(labels), n))
                for i in range(len(labels)):
                    row = matrix[i]
                    logs[i] = row[-1]
                    for c in cells:
                        if full.any():
                            logs[i, full] += np.add.reduceat(row[c], bounds[:-1][full])
                grams = np.zeros(n)
                for c in cells:
                    if full.any():
                        grams[full] += np.add.reduceat(c < CELLS, bounds[:-1][full], dtype=np.int64)
                if len(labels):
                    top = logs.argmax(axis=0)
                    sure = 1 / np.exp(logs - logs.max(axis=0)).sum(axis=0)
                    own = logs[top, np.arange(n)] - matrix[top, -1]
                    level = matrix[top, -2]
                else:
                    top, sure, own, level = np.zeros(n, int), np.zeros(n), np.zeros(n), np.zeros(n)
                unknown = ~lettered if len(labels) else np.ones(n, bool)
                best.append(np.where(unknown, len(labels), top))
                score.append(np.where(unknown, 0.0, sure))
                fit.append(np.where(unknown, 0.0, own / np.maximum(grams, 1) - level))
            if not best:
                continue
            kept, kept_names = carried_columns(batch)
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names[np.concatenate(best)], pa.string()), pa.array(np.concatenate(score)), pa.array(np.concatenate(fit))],
                [*kept_names, "lang_pred", "score", "fit"])
    return run


def identify(docs: DataFrame, training: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` as k0, k1, ..., with ``lang_pred``, ``score`` and ``fit``.

    ``score`` is the posterior of the language.  ``fit`` is the mean
    log-probability of the text's n-grams under it, less that of the language's
    training texts: near 0 for a text in a learned language, however long, far
    below for one that only is less unlike this language than the others.
    Learns from ``training`` (text, lang) alone.
    """
    labels, matrix = train(training)
    model = docs.sparkSession.sparkContext.broadcast(matrix)
    return scored(docs, keep, _scorer(labels, model), "lang_pred string, score double, fit double")


def held_out(doc_id: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    """Whether a document's id puts it in the held-out part."""
    return F.crc32(id_text(F.col(doc_id)).cast("binary")) % parts == part
