"""Line deduplication with a segment-partition edit join.

Lines within an edit distance of t share one of t + 1 segments: cut a line into t + 1 even segments, and any line that
close holds one of them unchanged, at a place that the two lengths bound. Every different line hands on a key for each
of its segments and for each substring of its own that could be a segment of a line of equal or smaller length. How many
edits a pair may differ in, and so t, follows from the length of the shorter line.

Lines that meet at a key are compared by a sketch of 64 parity bits over pairs of characters, which one edit changes in
four bits at most; those of a busy key are dealt to blocks, every two of which meet in a task of their own. What is left
forms clusters; their lines are sent to one task (large ones by blocks again), and there every line looks for an earlier
one: segments are probed in an index by length, and candidates verified with a banded bit-parallel edit distance until
one is close enough.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliogrid.llm.common import document_key, refuse, slices, strings
from heliogrid.llm.jaccard import place_clusters
from heliogrid.llm.links import components
from heliogrid.session import broadcast_if_small, stage_table

SEED = 42  # of Spark's xxhash64
HAS_WORD = r"[^\x20\x09-\x0D]"
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
EDIT_BITS = np.uint64(7)
WIDE = 2000  # lines compared with one another at once


@dataclass(frozen=True)
class Closeness:
    """One edit for every ``per_edit`` code points of the shorter line, and ``edits`` at most (up to seven).

    A task compares up to ``busy`` different lines at one segment key; those of a busier key go to several tasks.
    """

    edits: int = 2
    per_edit: int = 5
    busy: int = 16_384

    def allowed(self, length):
        """Edits that a line of this length, or an array of them, and a line that is not shorter may differ in."""
        return np.minimum(self.edits, length // self.per_edit)

    def near(self, a: str, b: str) -> bool:
        return edit_distance_within(a, b, int(self.allowed(min(len(a), len(b)))))


def segments(length, edits: int):
    """(start, length) of the edits + 1 segments, the last ones longer by one where it does not divide."""
    parts = edits + 1
    base, more = length // parts, length % parts
    start = base * 0
    for i in range(parts):
        size = base + (more >= parts - i)
        yield start, size
        start = start + size


def shifts(i: int, delta: int, edits: int) -> range:
    """How far from its own place segment i may be found in a line that is ``delta`` longer."""
    return range(max(-i, delta - (edits - i)), min(i, delta + edits - i) + 1)


def edit_distance_within(a: str, b: str, limit: int) -> bool:
    """Whether at most ``limit`` edits turn a into b: one word of 2 * limit + 1 diagonals for each number of edits."""
    if abs(len(a) - len(b)) > limit:
        return False
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    band = (1 << (2 * limit + 1)) - 1
    # Bit limit + d stands for d more characters of b than of a used up.
    reach = [(((1 << (e + 1)) - 1) << limit) & band for e in range(limit + 1)]
    for i, x in enumerate(a):
        same = 0
        for d in range(max(-limit, -i), min(limit, len(b) - 1 - i) + 1):
            if b[i + d] == x:
                same |= 1 << (limit + d)
        new = [reach[0] & same]
        for e in range(1, limit + 1):
            new.append(((reach[e] & same) | reach[e - 1] | (reach[e - 1] >> 1) | (new[e - 1] << 1)) & band)
        reach = new
    return bool(reach[limit] >> (limit + len(b) - len(a)) & 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_hash(line: str) -> int:
    """The same as Spark's xxhash64 of the line."""
    return _signed(xxhash.xxh64_intdigest(line.encode(), seed=SEED))


def sketches(lines: list[str]) -> np.ndarray:
    """64 parity bits of each line over its pairs of neighbouring characters."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    owner = np.repeat(np.arange(len(lines)), sizes)
    cell = ((chars[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + chars[1:] * BASE) >> np.uint64(58)).astype(np.int64)
    inside = owner[:-1] == owner[1:]
    bits = np.bincount(owner[:-1][inside] * 64 + cell[inside], minlength=64 * len(lines)) & 1
    return np.packbits(bits.astype(np.uint8).reshape(-1, 64), axis=1).view(np.uint64).ravel()


def _keys(lines: list[str], close: Closeness) -> tuple[np.ndarray, np.ndarray]:
    """(line number, key) of the lines' own segments and of their substrings that may be segments of other lines."""
    chars = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    chars = (chars + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    chars = (chars ^ (chars >> np.uint64(29))) * np.uint64(0x8EBC6AF09C88C6E3)
    chars ^= chars >> np.uint64(32)
    power = np.cumprod(np.full(len(chars) + 1, BASE, dtype=np.uint64))
    back = np.cumprod(np.full(len(chars) + 1, BASE_INVERSE, dtype=np.uint64))
    # Sums of characters times rising powers; a substring's sum is divided by the power it starts at.
    sums = np.r_[np.uint64(0), np.cumsum(chars * power[:-1])]
    sizes = np.array([len(x) for x in lines], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    numbers, keys = [], []
    for edits in range(1, close.edits + 1):
        for delta in range(edits + 1):
            some = np.flatnonzero(close.allowed(sizes - delta) == edits)
            length = sizes[some] - delta
            for i, (at, size) in enumerate(segments(length, edits)):
                for shift in shifts(i, delta, edits):
                    a = at + shift
                    fits = np.flatnonzero((a >= 0) & (a + size <= sizes[some]))
                    first = starts[some[fits]] + a[fits]
                    value = (sums[first + size[fits]] - sums[first]) * back[first]
                    value += (length[fits] * (close.edits + 1) + i).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
                    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xE7037ED1A0B428DB)
                    numbers.append(some[fits])
                    # The lowest bits tell how many edits lines that meet here may differ in.
                    keys.append(value & ~EDIT_BITS | np.uint64(edits))
    return np.concatenate(numbers), np.concatenate(keys)


def _signatures(close: Closeness):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, 500):
            lines, hashes = [], []
            for text in strings(batch.column(0)):
                for line in text.split("\n"):
                    if close.edits and len(line) >= close.per_edit:
                        h = line_hash(line)
                        if h not in seen:
                            seen.add(h)
                            lines.append(line)
                            hashes.append(h)
            if lines:
                number, key = _keys(lines, close)
                h = np.array(hashes, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(h[number]), pa.array(sketches(lines).view(np.int64)[number])], ["key", "h", "sketch"])

    return run


def _stars(h: np.ndarray, sketch: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (u, v) of different lines that chains of close sketches join: one star for each part of them."""
    sketch, part = sketch.view(np.uint64), np.arange(len(h))
    members: dict[int, np.ndarray] = {}
    for i in range(len(h) - 1):
        for a in range(i + 1, len(h), WIDE):
            found = a + np.flatnonzero(np.bitwise_count(sketch[a : a + WIDE] ^ sketch[i]) <= limit)
            for other in np.unique(part[found]).tolist() if len(found) else ():
                own = int(part[i])
                if other != own:
                    # The smaller part takes the name of the larger one.
                    one, two = members.pop(own, np.array([own])), members.pop(other, np.array([other]))
                    name = own if len(one) >= len(two) else other
                    part[two if name == own else one] = name
                    members[name] = np.concatenate([one, two])
    far = np.flatnonzero(part != np.arange(len(h)))
    return h[part[far]], h[far]


def _meet(close: Closeness):
    """From rows sorted by key and line: links (u, v) of lines whose sketches are close.

    The lines of a busy key come out as they are, as (key, u = v, sketch). No more than a batch and ``busy`` lines are held.
    """

    def table(u, v, key=None, sketch=None) -> pa.RecordBatch:
        none = pa.nulls(len(u), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), none if key is None else pa.array(key), none if sketch is None else pa.array(sketch)], ["u", "v", "key", "sketch"])

    def links(key: np.ndarray, h: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
        edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        u, v = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for k in np.flatnonzero(np.diff(edges) > 1).tolist():
            a, b = edges[k], edges[k + 1]
            x, y = _stars(h[a:b], sketch[a:b], 4 * int(key[a] & int(EDIT_BITS)))
            u.append(x)
            v.append(y)
        return table(np.concatenate(u), np.concatenate(v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, full = tuple(np.empty(0, dtype=np.int64) for _ in range(3)), None
        for batch in batches:
            rows = tuple(np.concatenate([x, batch.column(i).to_numpy()]) for i, x in enumerate(held))
            if not len(rows[0]):
                continue
            new = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])]
            key, h, sketch = (x[new] for x in rows)
            if full is not None and key[0] == full:
                n = int(np.searchsorted(key, full, side="right"))
                yield table(h[:n], h[:n], key[:n], sketch[:n])
                key, h, sketch = key[n:], h[n:], sketch[n:]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=np.int64)
            sizes = np.diff(np.r_[starts, len(key)])
            busy = np.repeat(sizes > close.busy, sizes)
            if busy.any():
                yield table(h[busy], h[busy], key[busy], sketch[busy])
            # The last key may go on in the next batch.
            last = starts[-1] if len(starts) else 0
            full = key[-1] if len(key) and busy[-1] else full
            done = ~busy & (np.arange(len(key)) < last)
            yield links(key[done], h[done], sketch[done])
            left = ~busy & (np.arange(len(key)) >= last)
            held = key[left], h[left], sketch[left]
        yield links(*held)

    return run


def _links(keys: DataFrame, close: Closeness) -> DataFrame:
    """Links (u, v) of all lines that meet at a key and have close sketches, or chains of them.

    The lines of a busy key are dealt to blocks of half of ``busy``, and block i meets block j in a task of its own.
    """
    sorted_ = keys.repartition("key").sortWithinPartitions("key", "h")
    met = stage_table(sorted_.mapInArrow(_meet(close), "u bigint, v bigint, key bigint, sketch bigint"), "meetings")
    rows = met.filter("key IS NOT NULL").select("key", F.col("u").alias("h"), "sketch").distinct()
    blocks = rows.groupBy("key").agg(F.ceil(2 * F.count(F.lit(1)) / F.lit(close.busy)).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("h"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other != block")
    dealt = dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "h", "sketch")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        u, v = _stars(pdf["h"].to_numpy(), pdf["sketch"].to_numpy(), 4 * int(pdf["key"].iloc[0] & int(EDIT_BITS)))
        return pd.DataFrame({"u": u, "v": v})

    return met.filter("key IS NULL").select("u", "v").unionByName(dealt.groupBy("key", "i", "j").applyInPandas(compare, "u bigint, v bigint"))


def _search(close: Closeness):
    """The lines of a task that have an earlier line close to them."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("c").sort_values(["no_id", "doc_id", "k", "pos"], na_position="last")
        lines, names = rows["line"].tolist(), rows["c"].tolist()
        sketch, sizes = sketches(lines), np.array([len(x) for x in lines], dtype=np.int64)
        index: dict[tuple, list[int]] = defaultdict(list)
        found = []
        for n, line in enumerate(lines):
            candidates: set[int] = set()
            for delta in range(-close.edits, close.edits + 1):
                length = len(line) - delta
                edits = int(close.allowed(length))
                if edits < abs(delta):
                    continue
                for i, (at, size) in enumerate(segments(length, edits)):
                    for shift in shifts(i, delta, edits):
                        a = at + shift
                        if 0 <= a and a + size <= len(line):
                            candidates.update(index.get((length, i, line[a : a + size]), ()))
            if candidates:
                some = np.sort(np.fromiter(candidates, dtype=np.int64, count=len(candidates)))
                limit = 4 * close.allowed(np.minimum(sizes[some], len(line)))
                if any(close.near(lines[j], line) for j in some[np.bitwise_count(sketch[some] ^ sketch[n]) <= limit].tolist()):
                    found.append(names[n])
            for i, (at, size) in enumerate(segments(len(line), int(close.allowed(len(line))))):
                index[(len(line), i, line[at : at + size])].append(n)
        return pd.DataFrame({"h": pd.Series(found, dtype="int64")})

    return run


def _texts_of(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """The lines of ``placed`` (c and where it goes); all others are dropped in the task that reads them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, 500):
            lines = {line_hash(x): x for text in strings(batch.column(0)) for x in text.split("\n")}
            new = [h for h in lines if h not in seen]
            seen.update(new)
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.int64()), pa.array([lines[h] for h in new], pa.string())], ["c", "line"])

    small, _ = broadcast_if_small(placed)
    return rows.select("text").mapInArrow(run, "c bigint, line string").join(small, "c")


def removed_lines(docs: DataFrame, close: Closeness = Closeness(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(k, removed): the numbers (from 0) of the lines to remove, of each document that loses any.

    k is the hash of doc_id and text. A line goes if the same line, or one within the allowed edits, comes earlier: in a
    document of smaller doc_id (null last), or before it in the same one. It does not matter whether that line stays.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    lines = rows.select(document_key(F.col("doc_id"), F.col("text")).alias("k"), "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.filter(F.col("line").rlike(HAS_WORD))
    occurs = stage_table(lines.select("k", "doc_id", "pos", F.xxhash64("line").alias("h"), F.length("line").cast("long").alias("n")), "lines")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k", "pos")
    first = stage_table(occurs.groupBy("h").agg(F.min(place).alias("at"), F.first("n").alias("n")).select("h", "n", "at.*"), "first")

    keys = rows.select("text").mapInArrow(_signatures(close), "key bigint, h bigint, sketch bigint")
    clusters = components(_links(keys, close)).toDF("h", "cluster").join(first.select("h", "n"), "h").select(F.col("h").alias("c"), "n", "cluster")
    placed = place_clusters(stage_table(clusters, "clusters"))
    where = first.select(F.col("h").alias("c"), "no_id", "doc_id", "k", "pos")
    gathered = _texts_of(rows, stage_table(placed.join(where, "c"), "gathered"))
    near = stage_table(gathered.groupBy("cluster", "i", "j").applyInPandas(_search(close), "h bigint").distinct(), "near")

    stays = first.join(near, "h", "left_anti").select("k", "pos")
    goes = occurs.join(stays, ["k", "pos"], "left_anti").groupBy("k").agg(F.sort_array(F.collect_set("pos")).alias("removed"))
    return stage_table(goes, "removed")


def dedup_lines(docs: DataFrame, close: Closeness = Closeness(), text: str = "text", doc_id: str = "doc_id", counts: str | None = None) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one; all rows and columns stay.

    Lines end at line feeds. A line without a word is never removed. Two lines repeat one another if they differ in no
    more edits than the shorter one allows: with two edits and five code points an edit, lines of up to four code points
    are compared exactly, those of five to nine with one edit, longer ones with two. Null texts stay null; a text that loses all its lines with words keeps the rest, if only an empty
    string. Rows that agree in doc_id and text are one document and lose the same lines. An empty table gives an empty
    table. ``counts`` names a column to add with the number of lines removed. Raises ValueError if _k, _removed or the name in
    ``counts`` is a column of ``docs``.
    """
    refuse(docs, "_k", "_removed", *filter(None, [counts]))
    goes, _ = broadcast_if_small(removed_lines(docs, close, text, doc_id).select(F.col("k").alias("_k"), F.col("removed").alias("_removed")))
    body = F.col(f"`{text}`")
    rows = docs.withColumn("_k", document_key(F.col(f"`{doc_id}`"), body)).join(goes, "_k", "left")
    kept = F.array_join(F.filter(F.split(body, "\n"), lambda x, i: ~F.array_contains("_removed", i)), "\n")
    out = rows.withColumn(text, F.when(F.col("_removed").isNull(), body).otherwise(kept))
    if counts:
        out = out.withColumn(counts, F.coalesce(F.size("_removed"), F.lit(0)).cast("long"))
    return out.drop("_k", "_removed")
