"""Exact deduplication with two Bloom passes.

First pass: every task counts, for the text hashes it reads, how often each cell of a segmented filter is hit, up to
two. The tasks' sparse counts meet by segment, and only the cells hit twice or more are kept. Second pass: a hash
all of whose cells were hit twice may repeat; every other text is certainly unique and its row passes through
without a shuffle. The candidates, and nothing else, are grouped by their full hash, so a false positive costs a
small row in a shuffle and never a wrong answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliogrid.llm.common import SPACES, with_row_id
from heliogrid.session import broadcast_if_small, stage_table

CELLS = 4  # cells of one hash
SEGMENT_CELLS = 1 << 16
HASHES_PER_SEGMENT = 4096  # 16 cells per hash: about one unique hash in a thousand is a candidate
FLUSH = 1 << 20  # hashes that a task counts before it hands its cells on


def digest(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Row number, identity, code points of the text and SHA-256 of the text without white space."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    plain = F.translate(body, SPACES, "")
    return with_row_id(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.length(body).cast("long").alias("n_points"), F.unhex(F.sha2(plain, 256)).alias("sha")))


def _segments_and_cells(sha: list[bytes], segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes 0 to 6 of a hash name its segment, bytes 8 to 15 its cells, as in :func:`_may_repeat`."""
    raw = np.frombuffer(b"".join(sha), dtype=np.uint8).reshape(-1, 32)
    head = raw[:, :7].astype(np.int64)
    segment = np.zeros(len(raw), dtype=np.int64)
    for i in range(7):
        segment = segment * 256 + head[:, i]
    return segment % segments, raw[:, 8 : 8 + 2 * CELLS].copy().view(">u2").astype(np.int64)


def _count_cells(segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                codes, counts = np.unique(np.concatenate(held), return_counts=True)
                where = codes // SEGMENT_CELLS
                cells = (codes % SEGMENT_CELLS).astype(np.uint16)
                starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
                once, twice = [], []
                for a, b in zip(starts, np.r_[starts[1:], len(where)], strict=True):
                    many = counts[a:b] > 1
                    once.append(cells[a:b][~many].tobytes())
                    twice.append(cells[a:b][many].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(where[starts], pa.int64()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], ["segment", "once", "twice"])
                held.clear()

        for batch in batches:
            sha = batch.column("sha").to_pylist()
            if sha:
                segment, cells = _segments_and_cells(sha, segments)
                held.append((segment[:, None] * SEGMENT_CELLS + cells).ravel())
                size += len(sha)
            if size >= FLUSH:
                yield from flush()
                size = 0
        yield from flush()

    return run


def _merge_cells(rows: pd.DataFrame) -> pd.DataFrame:
    """The cells of one segment hit at least twice, as a bitmap (bit i % 8 of byte i // 8)."""
    hits = np.zeros(SEGMENT_CELLS, dtype=np.int64)
    for once, twice in zip(rows["once"], rows["twice"], strict=True):
        hits[np.frombuffer(once, dtype=np.uint16)] += 1
        hits[np.frombuffer(twice, dtype=np.uint16)] += 2
    many = hits > 1
    if not many.any():
        return pd.DataFrame({"segment": [], "bitmap": []}).astype({"segment": "int64", "bitmap": "object"})
    return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "bitmap": [np.packbits(many, bitorder="little").tobytes()]})


def repeat_filter(hashes: DataFrame, segments: int) -> DataFrame:
    """First pass: a bitmap of 8 KB for each segment that has a cell hit twice. ``hashes`` has a column ``sha``."""
    cells = hashes.select("sha").mapInArrow(_count_cells(segments), "segment bigint, once binary, twice binary")
    return cells.groupBy("segment").applyInPandas(_merge_cells, "segment bigint, bitmap binary")


def _number(binary: Column) -> Column:
    """Up to seven bytes as an unsigned number, first byte highest."""
    return F.conv(F.hex(binary), 16, 10).cast("long")


def _may_repeat() -> Column:
    """Second pass: whether all cells of ``sha`` are set in ``bitmap``."""
    sha, bitmap = F.col("sha"), F.col("bitmap")
    cells = [_number(F.substring(sha, 9 + 2 * k, 2)) for k in range(CELLS)]
    set_ = [F.getbit(_number(F.substring(bitmap, (F.floor(c / 8) + 1).cast("int"), F.lit(1))), (c % 8).cast("int")) == 1 for c in cells]
    return F.coalesce(set_[0] & set_[1] & set_[2] & set_[3], F.lit(False))


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space; null and empty texts are equal to each other. The
    row with the most code points stays, then the smallest doc_id (null last), then the first in the table, so of
    fully repeated rows exactly one stays. Only the two columns named are read, so other columns may have any name.
    An empty table gives an empty table.
    """
    rows = stage_table(digest(docs, text, doc_id), "digest")
    segments = -(-max(1, rows.count()) // HASHES_PER_SEGMENT)
    bitmaps, _ = broadcast_if_small(stage_table(repeat_filter(rows, segments), "bloom"))
    tested = rows.withColumn("segment", _number(F.substring("sha", 1, 7)) % segments).join(bitmaps, "segment", "left")
    tested = stage_table(tested.select("rid", "doc_id", "n_points", "sha", _may_repeat().alias("candidate")), "tested")

    candidates = tested.filter("candidate").drop("candidate")
    best = F.min(F.struct((-F.col("n_points")).alias("points"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    groups = candidates.groupBy("sha").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size")).filter("group_size > 1")
    groups, _ = broadcast_if_small(stage_table(groups.select("sha", F.col("best.doc_id").alias("keep_id"), F.col("best.rid").alias("keep_rid"), "group_size"), "groups"))
    found = candidates.join(groups, "sha", "left").select(
        "doc_id",
        F.when(F.col("keep_rid").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("rid") == F.col("keep_rid"), F.lit(True)).alias("kept"),
        "sha",
    )
    single = tested.filter("NOT candidate").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    return single.unionByName(found).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")
