"""Hard negatives by exact inner products of whole numbers.

Anchors are a stated part of the rows; they go to the tasks in chunks of bounded size, and each task meets them tile by
tile with the rows it reads. A tile of scores is a product of two int64 matrices by Strassen's recursion. What is best
in a task stays in heaps of a few entries for each anchor (its positives) or each window (an anchor and one of its
positives); heaps of different tasks are merged by the same rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliogrid.llm.common import with_row_id
from heliogrid.session import new_folder, stage_table

LEAF = 8  # tiles with a side of this length or less are multiplied directly
TILE = 1024  # rows of a tile
CHUNK = 8192  # anchors that are sent to the tasks at once, about
CHUNK_BYTES = 64 * 1024 * 1024  # of their vectors
WAITING = 2**18  # entries that wait to be put into heaps together
LAST = 2**63 - 1  # stands for a null identity, which ranks behind the others
MOST = 2**54  # largest score, so that a hundred times it is still a long


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` by seven products of half the size; odd sides get a line of zeros.

    Sums are exact whole numbers. They wrap at 64 bits, so that the result is right whenever it fits 64 bits itself.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return a @ b
    if m % 2 or k % 2 or n % 2:
        return strassen(np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2))))[:m, :n]
    m, k, n = m // 2, k // 2, n // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    both = strassen(a11 + a22, b11 + b22)
    low, right = strassen(a21 + a22, b11), strassen(a11, b12 - b22)
    left, top = strassen(a22, b21 - b11), strassen(a11 + a12, b22)
    out = np.empty((2 * m, 2 * n), dtype=np.int64)
    out[:m, :n] = both + left - top + strassen(a12 - a22, b21 + b22)
    out[:m, n:] = right + top
    out[m:, :n] = low + left
    out[m:, n:] = both - low + right + strassen(a21 - a11, b11 + b12)
    return out


class Rows(NamedTuple):
    """Vectors with their row numbers, identities and labels (numbers of labels)."""

    rid: np.ndarray
    vec: np.ndarray
    label: np.ndarray
    q: np.ndarray

    def part(self, at) -> Rows:
        return Rows(*(x[at] for x in self))


class Heaps:
    """The ``size`` best entries (score, identity, row) of every slot; higher scores first, then smaller identities."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.floor = np.full(slots, np.iinfo(np.int64).min)  # an entry of a full heap has to reach this
        self.parts = [[np.zeros(0, dtype=np.int64)] * 4]  # slot, score, identity, row
        self.waiting = 0

    def push(self, *entries: np.ndarray) -> None:
        if len(entries[0]):
            self.parts.append(list(entries))
            self.waiting += len(entries[0])
            if self.waiting >= WAITING:
                self.merge()

    def merge(self) -> list[np.ndarray]:
        """Only the best of all entries stay."""
        slot, score, vec, rid = map(np.concatenate, zip(*self.parts, strict=True))
        order = np.lexsort((rid, vec, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        best = order[rank < self.size]
        full = rank == self.size - 1
        self.floor[slot[full]] = score[order[full]]
        self.parts, self.waiting = [[slot[rank < self.size], score[best], vec[best], rid[best]]], 0
        return self.parts[0]


def _rows(batch: pa.RecordBatch, dims: int) -> Rows:
    """A batch as arrays; vectors of fewer than ``dims`` components are continued with zeros."""
    rid, vec, label = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rid", "vec", "label"))
    q = batch.column("q")
    values, ends = q.flatten().to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(q).to_numpy(zero_copy_only=False))
    out = np.zeros((len(rid), dims), dtype=np.int64)
    sizes = np.diff(np.r_[0, ends])
    at = np.repeat(np.arange(len(rid)), sizes)
    out[at, np.arange(len(values)) - np.repeat(ends - sizes, sizes)] = values
    return Rows(rid, vec, label, out)


def _tiles(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Rows]:
    for batch in batches:
        for start in range(0, batch.num_rows, TILE):
            yield _rows(batch.slice(start, TILE), dims)


def _best_positives(anchors: Rows, size: int):
    """Entries of the rows that share a label with an anchor; the slot is the anchor's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(anchors.rid), size)
        places = {label: np.flatnonzero(anchors.label == label) for label in np.unique(anchors.label)}
        for tile in _tiles(batches, anchors.q.shape[1]):
            for label in np.intersect1d(tile.label, anchors.label):
                some = tile.part(tile.label == label)
                for start in range(0, len(places[label]), TILE):
                    at = places[label][start : start + TILE]
                    score = strassen(anchors.q[at], some.q.T)
                    i, j = np.nonzero((score >= heaps.floor[at][:, None]) & (anchors.rid[at][:, None] != some.rid))
                    heaps.push(at[i], score[i, j], some.vec[j], some.rid[j])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in heaps.merge()], ENTRY_NAMES)

    return run


def _best_in_windows(anchors: Rows, place: np.ndarray, low: np.ndarray, high: np.ndarray, size: int):
    """Entries of the rows with another label whose score lies in a window; the slot is the window's place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(place), size)
        order = np.argsort(place, kind="stable")
        for tile in _tiles(batches, anchors.q.shape[1]):
            for start in range(0, len(anchors.rid), TILE):
                end = min(start + TILE, len(anchors.rid))
                windows = order[slice(*np.searchsorted(place[order], [start, end]))]
                score = strassen(anchors.q[start:end], tile.q.T)
                other = anchors.label[start:end, None] != tile.label
                # One window of each anchor at a time, so that no array is larger than the tile.
                turn = np.arange(len(windows)) - np.searchsorted(place[windows], place[windows])
                for k in range(turn.max(initial=-1) + 1):
                    w = windows[turn == k]
                    mine = score[place[w] - start]
                    fits = other[place[w] - start] & (mine >= np.maximum(low[w], heaps.floor[w])[:, None]) & (mine <= high[w][:, None])
                    i, j = np.nonzero(fits)
                    heaps.push(w[i], mine[i, j], tile.vec[j], tile.rid[j])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in heaps.merge()], ENTRY_NAMES)

    return run


ENTRY_NAMES = ["slot", "score", "vec", "rid"]
ENTRIES = "slot long, score long, vec long, rid long"


def _merged(entries: DataFrame, size: int) -> DataFrame:
    """Heaps of all tasks as one for each slot, with ranks from 1."""
    best = Window.partitionBy("slot").orderBy(F.desc("score"), "vec", "rid")
    return entries.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size)


def whole_vectors(vector: Column, scale: int = 256) -> Column:
    """floor(``scale`` * x) of every component; null for a vector with a null or a component that is not finite."""
    x = F.transform(vector.cast("array<double>"), lambda v: v * F.lit(float(scale)))
    good = F.forall(vector.cast("array<double>"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    return F.when(good, F.transform(x, lambda v: F.floor(v)))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    n_positives: int = 5,
    n_negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = 256,
    chunk: int = CHUNK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the hardest allowed negatives.

    An anchor's positives are its ``n_positives`` best other rows of the same label. A negative has another label and
    a score between ``window`` per cent of the positive's; the best ``n_negatives`` stay. Scores are inner products of
    ``whole_vectors``; equal ones go by the smaller identity. Rows with a null label or a vector that is null or has a
    null or non-finite component take no part. Identities may be null (they rank last and come out as null) or repeated:
    each row stands for itself, and an anchor's copy is another row. Shorter vectors count as continued with zeros, empty
    ones score 0. A table without anchors, positives or negatives gives no rows. Only the three columns named and those
    of ``is_anchor`` are read; extra columns don't matter. ValueError if scores could pass 2**54.

    Anchors pass the driver ``chunk`` at a time, as do the scores of their positives. Each chunk takes two scans of the
    rows, which are stored once, and leaves at most n_positives * n_negatives entries an anchor and task to shuffle.
    """
    spark = rows.sparkSession
    stored = rows.select(
        F.coalesce(F.col(f"`{vec_id}`").cast("long"), F.lit(LAST)).alias("vec"),
        F.xxhash64(F.col(f"`{label}`").cast("string")).alias("label"),
        whole_vectors(F.col(f"`{vector}`"), scale).alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        F.col(f"`{label}`").isNotNull().alias("labelled"),
    )
    stored = stage_table(with_row_id(stored.filter("labelled AND q IS NOT NULL").drop("labelled")), "vectors")
    folder = new_folder(spark, "negatives")
    size = stored.agg(
        F.max(F.size("q")), F.max(F.aggregate("q", F.lit(0.0), lambda m, v: F.greatest(m, F.abs(v.cast("double"))))), F.count_if("is_anchor")
    ).first()
    dims, largest, n_anchors = max(size[0] or 0, 1), size[1] or 0.0, size[2]
    if dims * largest**2 > MOST:
        raise ValueError(f"components of up to {largest:.0f} give scores beyond 2**54; choose a smaller scale")
    found = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], found)
    # As few heaps as there are cores to fill them.
    read = stored.select("rid", "vec", "label", "q").coalesce(spark.sparkContext.defaultParallelism)
    chunks = -(-n_anchors // max(1, min(chunk, CHUNK_BYTES // (8 * dims))))
    for c in range(chunks):
        some = stored.filter("is_anchor").filter(F.pmod(F.xxhash64("rid"), F.lit(chunks)) == c)
        batches = some.select("rid", "vec", "label", "q").toArrow().combine_chunks().to_batches()
        if batches:
            _mine_chunk(read, _rows(batches[0], dims), n_positives, n_negatives, window).write.mode("append").parquet(folder)
    null_last = [F.nullif(F.col(c), F.lit(LAST)).alias(c) for c in ("anchor_id", "positive_id")]
    return spark.read.schema(found).parquet(folder).select(*null_last, "rank", F.nullif("negative_id", F.lit(LAST)).alias("negative_id"), "positive_score", "negative_score")


def _mine_chunk(rows: DataFrame, anchors: Rows, n_positives: int, n_negatives: int, window: tuple[int, int]) -> DataFrame:
    """Negatives of some anchors."""
    spark = rows.sparkSession
    best = _merged(rows.mapInArrow(_best_positives(anchors, n_positives), ENTRIES), n_positives)
    positives = best.select("slot", "score", "vec").toArrow()
    place, score, vec = (positives.column(c).to_numpy() for c in ("slot", "score", "vec"))
    low, high = -((-window[0] * score) // 100), window[1] * score // 100
    entries = rows.mapInArrow(_best_in_windows(anchors, place, low, high, n_negatives), ENTRIES)
    windows = pa.table({"slot": np.arange(len(place)), "anchor_id": anchors.vec[place], "positive_id": vec, "positive_score": score})
    joined = _merged(entries, n_negatives).join(F.broadcast(spark.createDataFrame(windows)), "slot")
    return joined.select("anchor_id", "positive_id", "rank", F.col("vec").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
