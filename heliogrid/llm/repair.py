"""Conversations whose roles alternate again, by the cheapest edits.

Each row of a conversation is kept, given another role, or deleted, and rows may be inserted, so that the initials of
the roles read ``(s?(ua)+)?``. The cheapest edits are found by depth-first branch and bound; of equally cheap ones the
least audit (the initials of the edits) wins.

Rows are sorted over the whole cluster, and a conversation is solved where it lies. One that is cut by the borders of
partitions, or longer than a piece, is solved piece by piece for every role that may stand before and behind a piece;
the pieces are then joined in order by a stream that holds one piece at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliogrid.llm.common import WORD
from heliogrid.session import stage_table

PIECE = 128  # rows that are searched at once
ROLE_COST, DELETE_COST, INSERT_COST, CUT_COST = 2, 3, 2, 1
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)  # faults of a row
# What the rows so far end with: nothing, system, user, assistant.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the role that may be written behind each
NAMES = ("", "system", "user", "assistant")
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
NEVER = 1 << 60
CLOSING = ("", "II", "I", "")  # insertions that end a conversation
LEGAL = {"su", "ua", "au"}


class Turn(NamedTuple):
    role: str
    text: str
    fault: int

    @property
    def initial(self) -> str:
        return self.role[:1]

    @property
    def must_go(self) -> bool:
        return self.fault in (BLANK, DUPLICATE)


def lower_bounds(turns: list[Turn], behind: int | None) -> list[list[int]]:
    """What the turns from each one on cost at least, for every state before it.

    The audits are left out of account here: states are followed backwards by cost alone. A bound of NEVER or more means
    that the end cannot be reached.
    """
    bounds = [[(INSERT_COST * len(CLOSING[s]) if behind is None else 0 if s == behind else NEVER) for s in STATES]]
    for turn in reversed(turns):
        rest, extra, done = bounds[-1], CUT_COST if turn.fault == TRUNCATED else 0, []
        for state in STATES:
            least = rest[state] + DELETE_COST
            if not turn.must_go:
                least = min(least, rest[NEXT[state]] + ROLE_COST + extra)
                kept = KEPT.get((state, turn.initial))
                if kept is not None:
                    least = min(least, rest[kept] + extra)
            done.append(least)
        # Two insertions lead back to a user or an assistant, so no more than two are worth trying.
        once = [min(done[s], done[NEXT[s]] + INSERT_COST) for s in STATES]
        bounds.append([min(done[s], once[NEXT[s]] + INSERT_COST) for s in STATES])
    return bounds[::-1]


def cheapest(turns: list[Turn], before: int = NOTHING, behind: int | None = None) -> tuple[int, str] | None:
    """Cost and audit of the best edits that lead from the state ``before`` to ``behind``; None if there are none.

    Without ``behind`` the conversation ends there. A node is a number of turns done and a state; its table holds the
    best (cost, audit) with which it was reached, and worse prefixes end there. A prefix also ends if its cost and the
    bound for the rest pass the best solution, or equal its cost with a greater audit. When the stack is empty, the
    solution is proved. No insertion follows the last turn but those that close a conversation.
    """
    n, best = len(turns), None
    bounds = lower_bounds(turns, behind)
    table: list[dict[int, tuple[int, str]]] = [{} for _ in range(n + 1)]
    stack = [(bounds[0][before], 0, before, 0, "")]
    while stack:
        bound, i, state, cost, audit = stack.pop()
        if bound >= NEVER or (best is not None and (bound > best[0] or (bound == best[0] and audit > best[1][: len(audit)]))):
            continue
        known = table[i].get(state)
        if known is not None and known <= (cost, audit):
            continue
        table[i][state] = (cost, audit)
        if i == n:
            # The bound of a last node is the cost of closing the conversation.
            found = (bound, audit + (CLOSING[state] if behind is None else ""))
            if best is None or found < best:
                best = found
            continue
        turn, after = turns[i], NEXT[state]
        edits = [(i + 1, state, cost + DELETE_COST, audit + "D"), (i, after, cost + INSERT_COST, audit + "I")]
        if not turn.must_go:
            extra = CUT_COST if turn.fault == TRUNCATED else 0
            edits.append((i + 1, after, cost + ROLE_COST + extra, audit + "R"))
            kept = KEPT.get((state, turn.initial))
            if kept is not None:
                edits.append((i + 1, kept, cost + extra, audit + "K"))
        # The most promising goes on top; of equal ones the least letter.
        nodes = [(e[2] + bounds[e[0]][e[1]], *e) for e in edits]
        stack += sorted(nodes, key=lambda node: (node[0], node[4]), reverse=True)
    return best


def apply_audit(turns: list[Turn], audit: str, before: int = NOTHING) -> Iterator[tuple[str, str]]:
    """Role and text of each repaired row."""
    rest, state = iter(turns), before
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield NAMES[state], ""
            continue
        turn = next(rest)
        if edit == "K":
            state = KEPT[state, turn.initial]
            yield turn.role, turn.text
        elif edit == "R":
            state = NEXT[state]
            yield NAMES[state], turn.text


def written(rows: Iterator[tuple[str, str]], first: bool) -> bytes:
    """``role:text`` of each row, with a line feed before each but the first of a conversation."""
    text = "".join(f"\n{role}:{text}" for role, text in rows)
    return (text[1:] if first else text).encode()


class Path(NamedTuple):
    """The best edits of all pieces so far that end in some state."""

    cost: int
    rank: int  # among the paths through the same pieces, by audit; none is the beginning of another
    parts: tuple | None  # (earlier ones, (place of the piece, state before it, audit))
    digest: object

    def in_order(self, closing: str) -> list[dict]:
        """Edits of each piece, with the number of rows that are written before it."""
        parts, at, offset = [], self.parts, 0
        while at:
            at, (place, before, audit) = at
            parts.append({"place": place, "before": before, "audit": audit if parts else audit + closing})
        for part in reversed(parts):
            part["offset"] = offset
            offset += len(part["audit"]) - part["audit"].count("D")
        return parts[::-1]


def joined(paths: dict[int, Path], place: int, turns: list[Turn], solved: dict[tuple[int, int], tuple[int, str]]) -> dict[int, Path]:
    """The best paths through one more piece, by the state that they end in."""
    best = {}
    for (before, behind), (cost, audit) in solved.items():
        if before in paths:
            path = paths[before]
            key = (path.cost + cost, path.rank, audit)
            best[behind] = min(best.get(behind, (key, before)), (key, before))
    rank = {audit: i for i, audit in enumerate(sorted(key[1:] for key, _ in best.values()))}
    out = {}
    for behind, (key, before) in best.items():
        digest = paths[before].digest.copy()
        digest.update(written(apply_audit(turns, key[2], before), before == NOTHING))
        out[behind] = Path(key[0], rank[key[1:]], (paths[before].parts, (place, before, key[2])), digest)
    return out


class Tally:
    """Counts over the rows of a conversation or a piece, in order."""

    def __init__(self):
        self.faults = [0] * 4
        self.illegal, self.initial = 0, None
        self.least = self.most = None
        self.turns = 0

    def add(self, turn_number: int | None, turn: Turn) -> None:
        self.faults[turn.fault] += 1
        self.illegal += self.initial is not None and self.initial + turn.initial not in LEGAL
        self.initial = turn.initial
        if turn_number is not None:
            self.turns += turn_number != self.most
            self.least = turn_number if self.least is None else self.least
            self.most = turn_number

    def row(self) -> dict:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED], "illegal": self.illegal}


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
SOLVED = "array<struct<before: int, behind: int, cost: long, audit: string>>"
TURNS = "array<struct<turn: long, role: string, text: string, fault: int>>"
PIECES = f"conv_id long, place long, whole boolean, {REPORT}, turns {TURNS}, solved {SOLVED}"
JOINED = f"conv_id long, {REPORT}, parts array<struct<place: long, before: int, audit: string, offset: long>>"
REPAIRED = "conv_id long, position long, role string, text string"


def _batches(rows: Iterator[dict], schema: pa.Schema, at_once: int = 64) -> Iterator[pa.RecordBatch]:
    some = []
    for row in rows:
        some.append(row)
        if len(some) >= at_once:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    yield pa.RecordBatch.from_pylist(some, schema)


def _solve(batches: Iterator[pa.RecordBatch], piece_rows: int, with_turns: bool) -> Iterator[dict]:
    """Whole conversations solved, others as pieces solved for every pair of states.

    Rows come sorted. Only the first and the last conversation of a task may go on in another one.
    """
    place = TaskContext.get().partitionId() << 40

    def piece(conv_id, rows: list[tuple], whole: bool) -> dict:
        nonlocal place
        turns = [turn for _, turn in rows]
        out: dict = {"conv_id": conv_id, "place": place, "whole": whole}
        place += 1
        if whole:
            tally = Tally()
            for number, turn in rows:
                tally.add(number, turn)
            cost, audit = cheapest(turns)
            digest = hashlib.sha256(written(apply_audit(turns, audit), True)).hexdigest()
            out |= tally.row() | {"cost": cost, "audit": audit, "repaired_sha256": digest}
        else:
            found = [(before, behind, cheapest(turns, before, behind)) for before in STATES for behind in STATES]
            out["solved"] = [{"before": a, "behind": b, "cost": x[0], "audit": x[1]} for a, b, x in found if x]
        if with_turns or not whole:
            out["turns"] = [{"turn": number, **turn._asdict()} for number, turn in rows]
        return out

    def rows() -> Iterator[tuple]:
        last = None
        for batch in batches:
            for conv_id, turn, role, digest, text, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Rows that agree in all stand side by side; all but the first are duplicates, unless they are blank.
                same, last = (conv_id, turn, role, digest) == last, (conv_id, turn, role, digest)
                yield conv_id, (turn, Turn(role, text, DUPLICATE if same and fault != BLANK else fault))

    first, held = True, None
    for conv_id, own in groupby(rows(), key=lambda row: row[0]):
        if held is not None:
            yield piece(*held)
        held, begun = None, not first
        waiting = []
        for _, row in own:
            waiting.append(row)
            if len(waiting) > piece_rows:
                yield piece(conv_id, waiting[:piece_rows], False)
                waiting, begun = waiting[piece_rows:], False
        # Held back until it is known whether another conversation follows in this task.
        held, first = (conv_id, waiting, begun), False
    if held is not None:
        yield piece(held[0], held[1], False)


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row for each conversation whose pieces come in order."""

    def pieces() -> Iterator[dict]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.slice(i, 1).to_pylist()[0]

    for conv_id, own in groupby(pieces(), key=lambda p: p["conv_id"]):
        paths, tally = {NOTHING: Path(0, 0, None, hashlib.sha256())}, Tally()
        for p in own:
            turns = [Turn(t["role"], t["text"], t["fault"]) for t in p["turns"]]
            for t, turn in zip(p["turns"], turns, strict=True):
                tally.add(t["turn"], turn)
            paths = joined(paths, p["place"], turns, {(s["before"], s["behind"]): (s["cost"], s["audit"]) for s in p["solved"]})
        ends = [(path.cost + INSERT_COST * len(CLOSING[state]), path.rank, CLOSING[state], state) for state, path in paths.items()]
        cost, _, closing, state = min(ends)
        path = paths[state]
        path.digest.update(written(apply_audit([], closing, state), state == NOTHING))
        parts = path.in_order(closing)
        audit = "".join(x["audit"] for x in parts)
        yield {"conv_id": conv_id} | tally.row() | {"cost": cost, "audit": audit, "repaired_sha256": path.digest.hexdigest(), "parts": parts}


def _faults(rows: DataFrame) -> DataFrame:
    """Adds text_md5 and fault; rows that are equal in everything are told apart later, where they stand side by side."""
    keyed = rows.withColumn("text_md5", F.md5("text")).withColumn("at", F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0))))
    firsts = keyed.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_md5").alias("m")).agg(F.min("at").alias("first_at"))
    both = keyed.join(firsts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_md5") == F.col("m")))
    fault = (
        F.when(~F.col("text").rlike(WORD), BLANK)
        .when(F.col("at") > F.col("first_at"), DUPLICATE)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
        .otherwise(FINE)
    )
    return both.select("conv_id", "turn", "role", "text_md5", "text", fault.alias("fault"))


def _arrow(schema: str, rows: Callable[..., Iterator[dict]], *args) -> Callable:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))
    return lambda batches: _batches(rows(batches, *args), fields)


NAMES_OF_REPORT = ["conv_id", *(c.split()[0] for c in REPORT.split(", "))]


def solve(rows: DataFrame, piece_rows: int = PIECE, with_turns: bool = False) -> tuple[DataFrame, DataFrame]:
    """Pieces (stored), and what joins those of conversations that are cut."""
    keys = ["conv_id", F.asc_nulls_first("turn"), "role", "text_md5"]
    ordered = _faults(rows).repartitionByRange(*keys).sortWithinPartitions(*keys)
    pieces = stage_table(ordered.mapInArrow(_arrow(PIECES, _solve, piece_rows, with_turns), PIECES), "conversations")
    cut = pieces.filter("NOT whole").select("conv_id", "place", "turns", "solved")
    cut = cut.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return pieces, cut.mapInArrow(_arrow(JOINED, _join), JOINED)


def standard_rows(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The four columns under their usual names; a null role or text is one space."""
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return df.select(F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"))


def repair_report(df: DataFrame, conversations: DataFrame | None = None, piece_rows: int = PIECE, **columns: str) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn, null turns first; of equal turns by role, then by the MD5 of the text, so that reruns agree. A row's
    first fault counts. Null roles and texts are one space; an empty role has no initial, so such a row is never kept as
    it is. A null conv_id is a conversation of its own. Repeated rows are duplicates of their first. Conversations of
    any length and texts of any length are handled; a long conversation is searched in pieces of ``piece_rows`` rows,
    with the same result. ``conversations`` (one column) adds those that have no rows: zeros, an empty audit, the hash
    of nothing. An empty table gives an empty table. Only the four columns named are read; extra ones don't matter.
    """
    pieces, joined_ones = solve(standard_rows(df, **columns), piece_rows)
    report = pieces.filter("whole").select(*NAMES_OF_REPORT).unionByName(joined_ones.select(*NAMES_OF_REPORT))
    if conversations is None:
        return report
    every = conversations.select(F.col(f"`{conversations.columns[0]}`").cast("long").alias("every_id")).distinct()
    both = every.join(report, F.col("every_id").eqNullSafe(F.col("conv_id")), "left")
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return both.select(F.col("every_id").alias("conv_id"), *[F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in NAMES_OF_REPORT[1:]])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows that are left of each piece."""
    for batch in batches:
        for i in range(batch.num_rows):
            p = batch.slice(i, 1).to_pylist()[0]
            turns = [Turn(t["role"], t["text"], t["fault"]) for t in p["turns"]]
            for number, (role, text) in enumerate(apply_audit(turns, p["audit"], p["before"]), p["offset"]):
                yield {"conv_id": p["conv_id"], "position": number, "role": role, "text": text}


def repaired_rows(df: DataFrame, piece_rows: int = PIECE, **columns: str) -> DataFrame:
    """The repaired conversations themselves: conv_id, position from 0, role, text. Handles what ``repair_report`` does."""
    pieces, joined_ones = solve(standard_rows(df, **columns), piece_rows, with_turns=True)
    edits = joined_ones.select(F.inline("parts")).withColumnRenamed("place", "at")
    cut = pieces.filter("NOT whole").join(edits, F.col("place") == F.col("at")).select("conv_id", "before", "offset", "turns", edits["audit"])
    whole = pieces.filter("whole").select("conv_id", F.lit(0).alias("before"), F.lit(0).cast("long").alias("offset"), "turns", "audit")
    return whole.unionByName(cut).mapInArrow(_arrow(REPAIRED, _repaired), REPAIRED)


def damage(df: DataFrame) -> DataFrame:
    """Conversation rows with faults put in by a hash of their place: lost, emptied, cut, repeated, or a wrong role."""
    rows = standard_rows(df)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    marked = rows.withColumn("kind", F.crc32(key) % 20).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")
