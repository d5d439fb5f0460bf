"""Removal of long repeated byte strings, with suffixes sorted deep and shallow.

Every string of LENGTH bytes holds one anchor: the gram of GRAM bytes with the smallest hash in it (the first such).
Equal strings have equal anchors at equal places, so suffixes need to be sorted only among those that start at the same
gram, and only where it occurs twice:

1. Tasks find the anchors of their texts, each with the strings it is the anchor of (a run of starts) and a hash of all
   bytes of these. Anchors meet by gram. Where two runs are equal, all their strings are repeated.
2. What is left are the ends of repeated passages, where a gram is repeated but the run is not. These anchors fetch the
   bytes around them. Suffixes to the right of the gram, and reversed prefixes to the left, are each put in order: a
   multikey quicksort by words of eight bytes to a shallow depth, then a blind trie for each group still tied there.
   Neighbours' common prefixes then tell for each start which strings are equal.
3. The spans of each different text are merged, and the rest of its bytes are kept.

A text and its copies are handled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliogrid.llm.common import slices, utf8
from heliogrid.session import broadcast_if_small, stage_table

LENGTH = 200
GRAM = 32
BACK = LENGTH - GRAM  # most bytes of a string before its anchor
SHALLOW = 32  # bytes that the quicksort orders by
PIECE = 1 << 22  # starts of strings handled at once
CHUNK = 40_000  # anchors whose surroundings are sorted at once, about

LOW = np.uint64((1 << 24) - 1)
TABLE = np.array([xxhash.xxh3_64_intdigest(bytes([i])) for i in range(256)], dtype=np.uint64)
FACTORS = np.array([xxhash.xxh3_64_intdigest(b"factor", seed=i) | 1 for i in range(5)], dtype=np.uint64)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram hash and place of each anchor, first and last start of its strings."""
    h = TABLE[np.frombuffer(data, dtype=np.uint8)]
    for i, width in enumerate((1, 2, 4, 8, 16)):
        h = h[:-width] * FACTORS[i] + h[width:]
    # The place in the low bits makes the first of equal grams the smallest.
    least = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)
    for width in (1, 2, 4, 8, 16, 32, 64):
        least = np.minimum(least[:-width], least[width:])
    least = np.minimum(least[: -(BACK + 1 - 128)], least[BACK + 1 - 128 :])
    at = (least & LOW).astype(np.int64)
    cut = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.r_[0, cut]
    return h[at[first]], at[first], first, np.r_[cut, len(at)] - 1


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, run, c, at, reach): gram, hash of the run's bytes, text, place, and how far back its starts reach."""
    seen: dict[int, int] = {}
    for batch in slices(batches):
        hs, runs, cs, ats, reaches = [], [], [], [], []
        for c, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            # Two copies tell that a text is repeated.
            seen[c] = seen.get(c, 0) + 1
            if len(data) < LENGTH or seen[c] > 2:
                continue
            for offset in range(0, len(data) - LENGTH + 1, PIECE):
                part = data[offset : offset + PIECE + LENGTH - 1]
                h, at, first, last = anchors(part)
                hs.append(h.view(np.int64))
                runs.append(np.fromiter((xxhash.xxh3_64_intdigest(part[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist(), strict=True)), dtype=np.uint64, count=len(h)).view(np.int64))
                cs.append(np.full(len(h), c, dtype=np.int64))
                ats.append(at + offset)
                reaches.append((at - first) * 256 + at - last)
        columns = [np.concatenate([np.empty(0, dtype=np.int64), *x]) for x in (hs, runs, cs, ats, reaches)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns[:4]] + [pa.array(columns[4].astype(np.int32))], ["h", "run", "c", "at", "reach"])


WHOLE, PART, OTHER = range(3)


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From anchors sorted by gram, run, text, place: (c, at, reach, h, kind).

    WHOLE: the run occurs again. PART: only its gram does. OTHER: a repeated run that a PART must be compared with.
    """
    out: list[tuple] = []
    gram = run = None
    count = runs = 0
    first = last = pending = None

    def end_run() -> None:
        nonlocal pending, runs
        if not count:
            return
        row = (*first, gram, OTHER if count > 1 else PART)
        if runs == 0:
            pending = row
        else:
            if pending:
                out.append(pending)
                pending = None
            out.append(row)
        runs += 1

    def rows() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * 5
        out.clear()
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["c", "at", "reach", "h", "kind"])

    for batch in batches:
        h, r, c, at, reach = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        if not len(h):
            continue
        same = np.r_[h[0] == gram, h[1:] == h[:-1]]
        look = np.flatnonzero(same | np.r_[same[1:], True])
        for g, u, *row in zip(h[look].tolist(), r[look].tolist(), c[look].tolist(), at[look].tolist(), reach[look].tolist(), strict=True):
            row = tuple(row)
            if g != gram or u != run:
                end_run()
                if g != gram:
                    runs, pending = 0, None
                gram, run, count, first = g, u, 0, row
            count += 1
            if count == 2:
                out.append((*first, gram, WHOLE))
            if count >= 2 and row != last:
                out.append((*row, gram, WHOLE))
            last = row
        if len(out) > 100_000:
            yield rows()
    end_run()
    yield rows()


class _Branch:
    __slots__ = ("depth", "ways")

    def __init__(self, depth: int, ways: dict):
        self.depth, self.ways = depth, ways


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """Positions of equally long strings in sorted order.

    Branches hold only the depth and byte at which strings part. A string goes down blindly to a leaf, is compared with
    that leaf once, and is hung in at the depth where the two differ.
    """
    width = len(strings[0])
    numbers = [int.from_bytes(s, "big") for s in strings]
    root: _Branch | list[int] = [0]
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while isinstance(node, _Branch):
            node = node.ways.get(s[node.depth]) or next(iter(node.ways.values()))
        differ = numbers[i] ^ numbers[node[0]]
        if not differ:
            node.append(i)
            continue
        depth, leaf = width - (differ.bit_length() + 7) // 8, strings[node[0]]
        above, node = None, root
        while isinstance(node, _Branch) and node.depth < depth:
            above, node = node, node.ways[s[node.depth]]
        if isinstance(node, _Branch) and node.depth == depth:
            node.ways[s[depth]] = [i]
            continue
        branch = _Branch(depth, {leaf[depth]: node, s[depth]: [i]})
        if above is None:
            root = branch
        else:
            above.ways[s[above.depth]] = branch
    order: list[int] = []
    stack = [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack.extend(node.ways[b] for b in sorted(node.ways, reverse=True))
        else:
            order += node
    return order


def multikey_quicksort(groups: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Order of the rows by group and then by words, and the ranges of that order that agree in all words.

    ``groups`` ascend. A segment is parted in three by the word of its pivot, the median of three rows: the rows below
    and above it are parted again by the same word, those equal to it by the next one. All open segments take a round
    together, so many small groups cost as few steps as a large one.
    """
    order = np.arange(len(groups))
    start = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]][: len(groups)])
    size = np.diff(np.r_[start, len(groups)])
    start, size = start[size > 1], size[size > 1]
    level = np.zeros(len(start), dtype=np.int64)
    ties: list[tuple[int, int]] = []
    while len(start):
        begin = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(start)), size)
        at = np.arange(len(segment)) + (start - begin)[segment]
        rows = order[at]
        word = words[rows, level[segment]]
        pivot = np.sort([word[begin], word[begin + size // 2], word[begin + size - 1]], axis=0)[1][segment]
        side = 1 + (word > pivot).astype(np.int64) - (word < pivot)
        count = np.bincount(3 * segment + side, minlength=3 * len(start))
        first = np.cumsum(count) - count
        place = np.empty(len(segment), dtype=np.int64)
        for s in range(3):
            here = np.flatnonzero(side == s)
            before = np.cumsum(count[s::3]) - count[s::3]
            place[here] = np.arange(len(here)) + (first[s::3] - before)[segment[here]]
        order[at[place]] = rows
        deeper = np.repeat(level, 3)
        deeper[1::3] += 1
        left = count > 1
        start, size, level = at[first[left]], count[left], deeper[left]
        done = level == words.shape[1]
        ties += zip(start[done].tolist(), (start + size)[done].tolist(), strict=True)
        start, size, level = start[~done], size[~done], level[~done]
    return order, ties


def deep_shallow_sort(groups: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows (bytes) within their groups, and how many bytes each shares with the one before (-1: group).

    ``groups`` ascend.
    """
    words = np.ascontiguousarray(rows[:, :SHALLOW]).view(">u8").astype(np.uint64)
    order, ties = multikey_quicksort(groups, words)
    for a, b in ties:
        some = order[a:b]
        order[a:b] = some[blind_trie_order([x.tobytes() for x in rows[some]])]
    ordered = rows[order]
    differ = ordered[1:] != ordered[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return order, np.r_[-1, np.where(groups[order][1:] == groups[order][:-1], common, -1)][: len(rows)]


def repeated_starts(groups: np.ndarray, left: np.ndarray, right: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance before the anchor at which a repeated string starts (-1: none).

    ``left`` are the bytes before the anchor, read backwards, ``right`` those from the end of its gram on; a row has
    strings that start ``least`` to ``most`` bytes before its anchor.
    """
    m = len(groups)
    low, high = np.full(m, -1), np.full(m, -1)
    parts = []
    for rows in (left, right):
        order, common = deep_shallow_sort(groups, rows)
        rank = np.empty(m, dtype=np.int64)
        rank[order] = np.arange(m)
        parts.append((rank, common))
    (rank_l, common_l), (rank_r, common_r) = parts
    for o in range(BACK + 1):
        own = np.flatnonzero((least <= o) & (o <= most))
        if len(own) < 2:
            continue
        ids = np.cumsum(common_l < o)[rank_l[own]] * (m + 1) + np.cumsum(common_r < BACK - o)[rank_r[own]]
        order = np.argsort(ids, kind="stable")
        same = ids[order][1:] == ids[order][:-1]
        hit = own[order[np.r_[same, False] | np.r_[False, same]]]
        low[hit] = np.where(low[hit] < 0, o, low[hit])
        high[hit] = o
    return low, high


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (c, text, wanted): a row for each anchor with the bytes before it (backwards) and after its gram."""
    for batch in slices(batches, 200):
        out = []
        for c, data, wanted in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            for w in wanted:
                at = w["at"]
                left = data[max(0, at - BACK) : at][::-1].ljust(BACK, b"\0")
                out.append((w["h"], c, at, w["reach"], w["kind"], left + data[at + GRAM : at + LENGTH].ljust(BACK, b"\0")))
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["h", "c", "at", "reach", "kind", "around"])


def _spans_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From surroundings sorted by gram: (c, first, last) of the repeated bytes."""
    held: list[pa.Table] = []

    def solve(rows: pa.Table) -> pa.RecordBatch:
        h, c, at, reach, kind = (rows.column(i).to_numpy() for i in range(5))
        around = np.frombuffer(b"".join(rows.column(5).to_pylist()), dtype=np.uint8).reshape(-1, 2 * BACK)
        low, high = repeated_starts(np.cumsum(np.r_[0, h[1:] != h[:-1]]), around[:, :BACK], around[:, BACK:], reach % 256, reach // 256)
        found = (high >= 0) & (kind == PART)
        return pa.RecordBatch.from_arrays([pa.array(c[found]), pa.array(at[found] - high[found]), pa.array(at[found] - low[found] + LENGTH)], ["c", "first", "last"])

    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column(0).to_numpy()
        # The last gram may go on in the next batch; what is held of it is not touched until it ends.
        last = int(np.searchsorted(h, h[-1], side="left"))
        if size + last > CHUNK and (last or held[-1].column(0)[-1].as_py() != h[0]):
            yield solve(pa.concat_tables([*held, pa.Table.from_batches([batch.slice(0, last)])]).combine_chunks())
            held, size, batch = [], 0, batch.slice(last)
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
    if size:
        yield solve(pa.concat_tables(held).combine_chunks())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (c, text, spans): bytes removed, merged spans, and the text that is left."""
    for batch in slices(batches, 200):
        removed, spans, kept = [], [], []
        for data, some in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
            merged: list[list[int]] = []
            for s in sorted(some, key=lambda s: s["first"]):
                if merged and s["first"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s["last"])
                else:
                    merged.append([s["first"], s["last"]])
            ends = [0, *(x for pair in merged for x in pair), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)))
            removed.append(len(data) - len(kept[-1]))
            spans.append([{"first": a, "last": b} for a, b in merged])
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["c", "n_removed", "spans", "kept"])


def text_class(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(c, n_removed, spans, kept) of each different text with repeated strings; c is :func:`text_class`.

    ``spans`` are the merged byte ranges (last excluded) covered by a string of LENGTH bytes that starts anywhere else
    too, in the same or another text; ``kept`` are the bytes outside them.
    """
    body = F.col(f"`{text}`")
    texts = docs.select(text_class(body).alias("c"), F.coalesce(body, F.lit("")).alias("text"))
    rows = texts.mapInArrow(_anchor_rows, "h bigint, run bigint, c bigint, at bigint, reach int")
    found = rows.repartition("h").sortWithinPartitions("h", "run", "c", "at").mapInArrow(_repeats, "c bigint, at bigint, reach int, h bigint, kind int")
    found = stage_table(found, "repeats")

    needed, _ = broadcast_if_small(stage_table(found.select("c").distinct(), "needed"))
    one = stage_table(texts.join(needed, "c", "left_semi").dropDuplicates(["c"]), "texts")
    wanted = found.filter(F.col("kind") != WHOLE).groupBy("c").agg(F.collect_list(F.struct("h", "at", "reach", "kind")).alias("wanted"))
    around = one.join(wanted, "c").select("c", "text", "wanted").mapInArrow(_surroundings, "h bigint, c bigint, at bigint, reach int, kind int, around binary")
    parts = around.repartition("h").sortWithinPartitions("h").mapInArrow(_spans_of_parts, "c bigint, first bigint, last bigint")
    whole = found.filter(F.col("kind") == WHOLE).select("c", (F.col("at") - F.floor(F.col("reach") / 256)).alias("first"), (F.col("at") - F.col("reach") % 256 + LENGTH).alias("last"))
    spans = whole.unionByName(parts).groupBy("c").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    return one.join(spans, "c").select("c", "text", "spans").mapInArrow(_cut, "c bigint, n_removed bigint, spans array<struct<first: bigint, last: bigint>>, kept binary")


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; what is left of a split character becomes U+FFFD.

    Null texts stay null; all rows and columns stay. ValueError if _class or _kept occurs.
    """
    taken = {"_class", "_kept"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns exist already: {', '.join(sorted(taken))}")
    cut = stage_table(repeated_spans(docs, text).select(F.col("c").alias("_class"), F.make_valid_utf8(F.col("kept").cast("string")).alias("_kept")), "cut")
    out = docs.withColumn("_class", text_class(F.col(f"`{text}`"))).join(cut, "_class", "left")
    return out.withColumn(text, F.coalesce("_kept", F.col(f"`{text}`"))).drop("_class", "_kept")


def repeat_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte is removed where a string of LENGTH bytes that covers it starts anywhere else too. Null texts are empty and
    texts shorter than LENGTH keep all bytes; a text that occurs twice loses all of them. Repeated rows and null
    doc_ids are ordinary rows. An empty table gives an empty table. Only the columns named are read.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_class(F.col(f"`{text}`")).alias("c"), F.octet_length(body).cast("long").alias("n_bytes"), F.sha2(body, 256).alias("sha"))
    rows = stage_table(rows, "documents")
    cut = repeated_spans(docs, text).select("c", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha"))
    cut, _ = broadcast_if_small(stage_table(cut, "cut"))
    zero = F.lit(0).cast("long")
    return rows.join(cut, "c", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha", "sha").alias("kept_sha256")
    )
