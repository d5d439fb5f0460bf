"""Near duplicates by Jaccard similarity of word shingles, with T-occurrence search.

A document is the set of 64-bit hashes of its shingles; documents of equal sets are one class, and all later steps work
on classes. With a threshold t, linked sets of sizes a <= b share at least t * b shingles, so

1. each set sends its rarest n - ceil(t * n) + 1 shingles (its prefix) to the tasks that own them; linked sets meet at
   one of them. Rarity is read from a table of counts of fixed size, so very frequent shingles come last and stay home.
2. Classes that meet are compared by sketches: a sketch has one parity bit for about one shingle, and sets differ in at
   least as many shingles as their sketches in bits. A few classes at a shingle are paired; where more meet, the task of
   the shingle compares them and hands on one star for each part it finds, so what is handed on grows with the classes,
   not the pairs. Classes joined in this way are clusters, whose sets are sent to one task.
3. There the sets become inverted lists and are looked up by DivideSkip: the longest lists are set aside, the short ones
   are merged, and sets that occur often enough in these are probed for in the long lists by binary search. Sets that
   reach the required overlap are linked. (Merging is one vectorised count of all entries instead of a heap.)
4. Sets already linked to one another are not searched again; only links between different parts matter. A cluster too
   large for a task is cut into blocks, and every two blocks meet in a task.

Nothing is sampled or capped: pairs, clusters and blocks only decide where a link is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from heliogrid.llm.common import document_key, refuse, slices, utf8
from heliogrid.llm.links import components
from heliogrid.session import broadcast_if_small, stage_table

CELLS = 1 << 18  # counts of shingles, by their lowest bits
SLICES = 16
FEW = 8  # classes at a shingle that are paired with one another
MANY = 20_000  # classes at a shingle whose sketches are compared in one task
BLOCK_TOKENS = 1 << 20  # shingles of the sets that a task indexes at once, about

# Odd factors that tell the places of a shingle's words apart.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


@dataclass(frozen=True)
class Similarity:
    """Words of a shingle, and the percentage that intersection must be of union."""

    words: int = 5
    percent: int = 80

    def least_overlap(self, n: int) -> int:
        """Shingles that a set of n shares with any set it is linked to."""
        return -(-self.percent * n // 100)

    def prefix(self, n: int) -> int:
        return n - self.least_overlap(n) + 1

    def has_partners(self, n: int) -> bool:
        """Whether a different set can be similar enough to a set of n shingles."""
        return 100 * n >= self.percent * (n + 1)


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct shingles as 64-bit hashes; ASCII letters are lower-cased. Fewer words make one shingle."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=np.uint64, count=len(parts))
    k = min(words, len(parts))
    out = np.full(len(parts) - k + 1, np.uint64(k), dtype=np.uint64)
    for i in range(k):
        out += hashes[i : i + len(out)] * FACTORS[i]
    return np.unique(out)


def _sketch(tokens: np.ndarray) -> bytes:
    """Parities of the tokens in 2^k >= n cells (64 at least), by their highest bits."""
    k = max(6, (len(tokens) - 1).bit_length())
    return np.packbits(np.bincount((tokens >> np.uint64(64 - k)).astype(np.int64), minlength=1 << k) & 1).tobytes()


def _differ(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded; the sets differ in no fewer shingles."""
    if len(a) > len(b):
        a, b = b, a
    x = np.frombuffer(b, dtype=np.uint8)
    if len(a) < len(b):
        x = np.packbits(np.unpackbits(x).reshape(8 * len(a), -1).sum(axis=1) & 1)
    return int(np.bitwise_count(x ^ np.frombuffer(a, dtype=np.uint8)).sum())


def _class_of(tokens: np.ndarray) -> int:
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _summaries(words: int):
    """Rows of documents (n and class) and, at the end of a task, slices of its shingle counts."""
    schema = pa.schema([("doc_id", pa.int64()), ("k", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("sketch", pa.binary()), ("slice", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.uint32)
        seen: set[int] = set()
        for batch in slices(batches):
            ns, cs, sketches, held = [], [], [], []
            for text in utf8(batch.column(2)):
                tokens = shingles(text, words)
                ns.append(len(tokens))
                cs.append(_class_of(tokens))
                sketches.append(None)
                if cs[-1] not in seen:
                    seen.add(cs[-1])
                    held.append(tokens)
                    sketches[-1] = _sketch(tokens)
            if held:
                counts += np.bincount((np.concatenate(held) & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.uint32)
            nulls = pa.nulls(len(ns))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ns, pa.int64()), pa.array(cs, pa.int64()), pa.array(sketches, pa.binary()), nulls.cast(pa.int32()), nulls.cast(pa.binary())], schema=schema)
        if seen:
            nulls = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays([nulls, nulls, nulls, nulls, pa.nulls(SLICES, pa.binary()), pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in np.split(counts, SLICES)], pa.binary())], schema=schema)

    return run


def _add_counts(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(CELLS // SLICES, dtype=np.uint64)
    for x in rows["counts"]:
        total += np.frombuffer(x, dtype=np.uint32 if len(x) == total.size * 4 else np.uint64)
    return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "counts": [total.tobytes()]})


def _rarity(summaries: DataFrame) -> np.ndarray:
    """One byte for each cell that grows with the logarithm of its count. What reaches the driver has a fixed size."""
    parts = summaries.filter("slice IS NOT NULL").select("slice", "counts")
    # Two steps, so that no task adds up the counts of all tasks.
    parts = parts.withColumn("part", F.pmod(F.xxhash64("counts"), F.lit(32))).groupBy("slice", "part").applyInPandas(_add_counts, "slice int, counts binary")
    total = np.zeros(CELLS, dtype=np.uint64)
    for row in parts.groupBy("slice").applyInPandas(_add_counts, "slice int, counts binary").collect():
        at = row["slice"] * (CELLS // SLICES)
        total[at : at + CELLS // SLICES] = np.frombuffer(row["counts"], dtype=np.uint64)
    return np.minimum(255, 12 * np.log2(1 + total.astype(np.float64))).astype(np.uint8)


def _prefixes(sim: Similarity, rarity: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            token, cs, ns = [np.empty(0, dtype=np.uint64)], [], []
            for text in utf8(batch.column(0)):
                tokens = shingles(text, sim.words)
                n = len(tokens)
                if not n or not sim.has_partners(n):
                    continue
                c = _class_of(tokens)
                if c not in seen:
                    seen.add(c)
                    order = np.argsort(rarity[(tokens & np.uint64(CELLS - 1)).astype(np.int64)], kind="stable")
                    token.append(tokens[order[: sim.prefix(n)]])
                    cs.append(c)
                    ns.append(n)
            sizes = [len(x) for x in token[1:]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(token).view(np.int64)), pa.array(np.repeat(np.array(cs, dtype=np.int64), sizes)), pa.array(np.repeat(np.array(ns, dtype=np.int32), sizes))], ["token", "c", "n"]
            )

    return run


PAIR, MEMBER, STAR = range(3)


def _meetings(percent: int):
    """From rows sorted by token, n, c: who meets, as (kind, a, b).

    PAIR: classes a and b, where up to FEW meet. MEMBER: class b is one of those that meet at token a. STAR: class b is
    joined with class a untested, where more than MANY meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, last = None, None
        sizes: list[int] = []
        classes: list[int] = []
        out: tuple[list[int], list[int], list[int]] = ([], [], [])

        def put(kind: int, a: int, b: int) -> None:
            for column, value in zip(out, (kind, a, b), strict=True):
                column.append(value)

        def end() -> None:
            if 1 < len(classes) <= FEW:
                for i, n in enumerate(sizes):
                    for j in range(i + 1, len(sizes)):
                        if 100 * n >= percent * sizes[j]:
                            put(PAIR, classes[i], classes[j])
            sizes.clear()
            classes.clear()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["kind", "a", "b"])
            for column in out:
                column.clear()
            return batch

        for batch in batches:
            t, c, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            if not len(t):
                continue
            # Most tokens have one row; only runs, and the run that may go on in the next batch, are looked at.
            same = np.r_[t[0] == token, t[1:] == t[:-1]]
            for i in np.flatnonzero(same | np.r_[same[1:], True]).tolist():
                item = (n[i], c[i])
                if t[i] != token:
                    end()
                    token, last = t[i], None
                if item == last:
                    continue
                last = item
                met = len(classes)
                if met <= MANY:
                    sizes.append(int(n[i]))
                    classes.append(int(c[i]))
                if met == FEW:
                    for x in classes:
                        put(MEMBER, int(token), x)
                elif FEW < met < MANY:
                    put(MEMBER, int(token), int(c[i]))
                elif met == MANY:
                    for x in classes[1:]:
                        put(STAR, classes[0], x)
                elif met > MANY:
                    put(STAR, classes[0], int(c[i]))
                if len(out[0]) > 200_000:
                    yield rows()
        end()
        yield rows()

    return run


def _join_members(sim: Similarity):
    """From the classes at one token with their sketches: a star (u, v) for each part that similar sketches join."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "c"])
        n, c = rows["n"].to_numpy(), rows["c"].to_numpy()
        sketches = rows["sketch"].tolist()
        length = np.array([len(x) for x in sketches])
        # Partners have at most 100 / percent times the shingles, so sketches of the same length or twice that.
        whole = {k: np.frombuffer(b"".join(x for x in sketches if len(x) == k), dtype=np.uint8).reshape(-1, k) for k in np.unique(length).tolist()}
        first = {k: int(np.flatnonzero(length == k)[0]) for k in whole}
        half = {k: np.packbits(np.unpackbits(x, axis=1).reshape(len(x), -1, 2).sum(axis=2) & 1, axis=1) for k, x in whole.items()}
        ends = np.searchsorted(n, 100 * n // sim.percent, side="right")
        part = np.arange(len(n))
        for i in range(len(n)):
            k = int(length[i])
            for other, table in ((k, whole.get(k)), (2 * k, half.get(2 * k))):
                if table is None:
                    continue
                a, b = max(i + 1, first[other]), min(int(ends[i]), first[other] + len(table))
                if a < b:
                    differ = np.bitwise_count(table[a - first[other] : b - first[other]] ^ whole[k][i - first[k]]).sum(axis=1, dtype=np.int64)
                    found = a + np.flatnonzero((100 + sim.percent) * differ <= (100 - sim.percent) * (n[i] + n[a:b]))
                    parts = np.unique(part[found])
                    if len(parts) and (len(parts) > 1 or parts[0] != part[i]):
                        parts = np.union1d(parts, [part[i]])
                        part[np.isin(part, parts)] = parts[0]
        head = pd.Series(c).groupby(part).transform("min").to_numpy()
        return pd.DataFrame({"u": head[head != c], "v": c[head != c]})

    return run


class Index:
    """Inverted lists over some sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        tokens = np.concatenate(sets) if sets else np.empty(0, dtype=np.uint64)
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owners = tokens[order], owners[order]
        first = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]]) if len(tokens) else np.empty(0, dtype=np.int64)
        self.tokens = tokens[first]
        self.bounds = np.r_[first, len(tokens)]

    def search(self, query: np.ndarray, sim: Similarity) -> np.ndarray:
        """Numbers of the sets that are similar to the query: T-occurrence search by DivideSkip."""
        least = sim.least_overlap(len(query))
        at = np.searchsorted(self.tokens, query)
        at = at[(at < len(self.tokens)) & (self.tokens[np.minimum(at, len(self.tokens) - 1)] == query)] if len(self.tokens) else at[:0]
        if len(at) < least:
            return np.empty(0, dtype=np.int64)
        starts, lengths = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        # Long lists cost a binary search per candidate, short ones a step per entry.
        n_long = min(least - 1, int(least / (0.05 * np.log2(max(2, lengths[0])) + 1)))
        short, count = starts[n_long:], lengths[n_long:]
        ends = np.cumsum(count)
        entries = np.arange(ends[-1]) + np.repeat(short - (ends - count), count)
        hits = np.bincount(self.owners[entries], minlength=len(self.sets))
        found = np.flatnonzero(hits >= least - n_long)
        hits = hits[found]
        for i in range(n_long):
            own = self.owners[starts[i] : starts[i] + lengths[i]]
            where = np.searchsorted(own, found)
            hits = hits + (own[np.minimum(where, len(own) - 1)] == found)
            able = hits + (n_long - 1 - i) >= least
            if not able.all():
                found, hits = found[able], hits[able]
            if not len(found):
                break
        union = len(query) + self.sizes[found] - hits
        return found[100 * hits >= sim.percent * union]


def _search_block(sim: Similarity):
    """Links that join all similar sets of a task, without those inside a part known to be joined."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("c").sort_values("c")
        names = rows["c"].to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["tokens"]]
        index = Index(sets)
        part = np.full(len(sets), -1)
        out: list[tuple[int, int]] = []
        searched = np.zeros(len(sets), dtype=bool)

        def look(i: int) -> None:
            searched[i] = True
            found = index.search(sets[i], sim)
            joined = np.unique(part[found][part[found] >= 0])
            label = i if not len(joined) else int(joined.min())
            # One link to every set without a part, and one to every other part.
            out.extend((names[i], names[j]) for j in found[part[found] < 0] if j != i)
            for p in joined:
                if p != part[i] or part[i] < 0:
                    out.append((names[i], names[found[part[found] == p][0]]))
            if part[i] >= 0:
                joined = np.union1d(joined, [part[i]])
                label = int(joined.min())
            part[np.isin(part, joined)] = label
            part[found] = label
            part[i] = label

        for i in range(len(sets)):
            if part[i] < 0:
                look(i)
        # Sets of the largest part are found by the others, whose searches meet all sets.
        while True:
            sizes = np.bincount(part)
            left = np.flatnonzero(~searched & (part != sizes.argmax()))
            if not len(left):
                break
            look(int(left[0]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return run


def _sets(docs: DataFrame, sim: Similarity, placed: DataFrame) -> DataFrame:
    """The classes of ``placed`` with their shingles; all other sets are dropped in the task that makes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            cs, sets = [], []
            for t in utf8(batch.column(0)):
                tokens = shingles(t, sim.words)
                c = _class_of(tokens)
                if c not in seen:
                    seen.add(c)
                    cs.append(c)
                    sets.append(tokens.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(cs, pa.int64()), pa.array(sets, pa.binary())], ["c", "tokens"])

    small, _ = broadcast_if_small(placed)
    return docs.mapInArrow(run, "c bigint, tokens binary").join(small, "c")


def _similar_sketches(sim: Similarity):
    @F.arrow_udf(BooleanType())
    def run(n: pa.Array, m: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        rows = zip(n.to_pylist(), m.to_pylist(), a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([(100 + sim.percent) * _differ(x, y) <= (100 - sim.percent) * (i + j) for i, j, x, y in rows], pa.bool_())

    return run.asNondeterministic()


def place_clusters(clusters: DataFrame) -> DataFrame:
    """(c, cluster, i, j): where each class goes. ``clusters`` has c, n and cluster.

    Small clusters share a task. A large one is cut into blocks, and block i meets block j in a task of its own.
    """
    sizes = clusters.groupBy("cluster").agg(F.sum("n").alias("tokens"))
    sizes = stage_table(sizes.withColumn("blocks", F.ceil(2 * F.col("tokens") / BLOCK_TOKENS).cast("int")), "sizes")
    small = sizes.filter("blocks = 1").agg(F.sum("tokens")).first()[0] or 0
    placed = clusters.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    bin_ = F.pmod(F.xxhash64("cluster"), F.lit(1 + small // BLOCK_TOKENS))
    alone = placed.filter("blocks = 1").select("c", bin_.alias("cluster"), F.lit(-1).alias("i"), F.lit(-1).alias("j"))
    each = placed.filter("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).filter("other != block")
    return stage_table(alone.unionByName(each.select("c", "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))), "tasks")


def _classes(docs: DataFrame, sim: Similarity, text: str, doc_id: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, k, n, c) of every row, and (c, component) of the linked classes; the component is a class too."""
    narrow = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), document_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("k"), F.col(f"`{text}`").alias("text"))
    summaries = stage_table(narrow.mapInArrow(_summaries(sim.words), "doc_id bigint, k bigint, n bigint, c bigint, sketch binary, slice int, counts binary"), "summaries")
    rows = summaries.filter("slice IS NULL").select("doc_id", "k", "n", "c")
    prefixes = narrow.select("text").mapInArrow(_prefixes(sim, _rarity(summaries)), "token bigint, c bigint, n int")
    met = prefixes.repartition("token").sortWithinPartitions("token", "n", "c").mapInArrow(_meetings(sim.percent), "kind int, a bigint, b bigint")
    met = stage_table(met.distinct(), "meetings")

    classes = met.select("b").unionByName(met.filter(F.col("kind") != MEMBER).select(F.col("a").alias("b"))).distinct().toDF("c")
    needed, _ = broadcast_if_small(stage_table(classes, "needed"))
    sketches = stage_table(summaries.filter("sketch IS NOT NULL").select("c", "n", "sketch").join(needed, "c", "left_semi").dropDuplicates(["c"]), "sketches")
    one = sketches.select(F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    two = sketches.select(F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    pairs = met.filter(F.col("kind") == PAIR).select("a", "b").join(one, "a").join(two, "b").filter(_similar_sketches(sim)("n_a", "n_b", "sketch_a", "sketch_b"))
    members = met.filter(F.col("kind") == MEMBER).select(F.col("a").alias("token"), F.col("b").alias("c")).join(sketches, "c")
    stars = members.groupBy("token").applyInPandas(_join_members(sim), "u bigint, v bigint")
    joined = pairs.select("a", "b").unionByName(met.filter(F.col("kind") == STAR).select("a", "b")).toDF("u", "v").unionByName(stars)
    clusters = components(joined).toDF("c", "cluster").join(sketches.select("c", "n"), "c")

    sets = _sets(narrow.select("text"), sim, place_clusters(stage_table(clusters, "clusters")))
    links = sets.groupBy("cluster", "i", "j").applyInPandas(_search_block(sim), "u bigint, v bigint")
    return rows, stage_table(components(links).toDF("c", "component"), "components")


def near_duplicates(docs: DataFrame, sim: Similarity = Similarity(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Two documents link when their shingle sets are similar enough. Null, empty and blank texts have no shingles and
    link with nothing, so their component is their own doc_id. Null doc_ids never name a component; where all of its
    documents have none, component_id is null. Repeated rows link like any equal texts. An empty table gives an empty
    table. Only the columns named are read.
    """
    rows, linked = _classes(docs, sim, text, doc_id)
    known = _grouped(rows, linked)
    heads = known.groupBy("component").agg(F.min("first").alias("component_id"))
    table, _ = broadcast_if_small(stage_table(known.join(heads, "component").select("c", "component_id", F.lit(True).alias("grouped")), "heads"))
    out = rows.join(table, "c", "left")
    component = F.when(F.col("grouped") & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _grouped(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """(c, first, component) of the classes with several rows or links; ``first`` is the class's smallest doc_id."""
    known = rows.filter("n > 0").groupBy("c").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    known = known.join(linked, "c", "left").filter("copies > 1 OR component IS NOT NULL")
    return stage_table(known.select("c", "first", F.coalesce("component", "c").alias("component")), "known")


def keep_one_each(docs: DataFrame, sim: Similarity = Similarity(), text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id (null last).

    Rows without shingles all stay. Of rows that agree in doc_id and text one stays. Other cases as in
    :func:`near_duplicates`; all columns are kept. Raises ValueError if _k is one of them.
    """
    refuse(docs, "_k")
    rows, linked = _classes(docs, sim, text, doc_id)
    small, _ = broadcast_if_small(_grouped(rows, linked).select("c", "component"))
    members = stage_table(rows.join(small, "c").filter("n > 0").select("component", "k", "doc_id"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k")
    stays = stage_table(members.groupBy("component").agg(F.min(order).alias("at")).select(F.col("at.k").alias("k")), "stays")
    goes, _ = broadcast_if_small(stage_table(members.select("k").distinct().join(stays, "k", "left_anti").withColumnRenamed("k", "_k"), "goes"))
    again = members.groupBy("k").count().filter("count > 1").join(stays, "k", "left_semi").select(F.col("k").alias("_k"))
    again, _ = broadcast_if_small(stage_table(again, "again"))
    out = docs.withColumn("_k", document_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))).join(goes, "_k", "left_anti")
    return out.join(again, "_k", "left_anti").unionByName(out.join(again, "_k", "left_semi").dropDuplicates(["_k"])).drop("_k")
