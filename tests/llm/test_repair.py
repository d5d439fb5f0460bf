"""Conversation repair against exhaustive search and a plain table of all states."""

import hashlib
import random
import re
import time
import zlib

from heliogrid.llm import repair
from heliogrid.llm.repair import Turn

CHAT = "conv_id bigint, turn bigint, role string, text string, place string"


def exhaustive(turns, most):
    """Best (cost, audit, rows) of all edits that cost at most ``most``."""
    best = None

    def go(i, cost, audit, rows):
        nonlocal best
        if cost > most:
            return
        if i == len(turns):
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in rows)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, rows)
        else:
            t, cut = turns[i], turns[i].fault == repair.TRUNCATED
            go(i + 1, cost + 3, audit + "D", rows)
            if not t.must_go:
                go(i + 1, cost + cut, audit + "K", [*rows, (t.role, t.text)])
                for role in ("user", "assistant"):
                    go(i + 1, cost + 2 + cut, audit + "R", [*rows, (role, t.text)])
        for role in ("user", "assistant"):
            go(i, cost + 2, audit + "I", [*rows, (role, "")])

    go(0, 0, "", [])
    return best


def some_turns(r, n, roles=("user", "assistant", "system", "tool")):
    return [Turn(r.choice(roles), f"t{i}", r.choice([0, 0, 0, 1, 2, 3])) for i in range(n)]


def test_cheapest_is_proved_by_exhaustion():
    r = random.Random(6)
    for _ in range(150):
        turns = some_turns(r, r.randrange(5))
        cost, audit = repair.cheapest(turns)
        want = exhaustive(turns, cost + 1)
        assert (cost, audit, list(repair.apply_audit(turns, audit))) == want


def table_search(turns):
    """Best (cost, audit) by going through all states of all prefixes."""
    ways = {0: (0, "")}
    for t in [*turns, None]:
        for _ in range(2):
            for state, (cost, audit) in list(ways.items()):
                new = (cost + 2, audit + "I")
                if new < ways.get(repair.NEXT[state], (1 << 40, "")):
                    ways[repair.NEXT[state]] = new
        if t is None:
            break
        after, cut = {}, t.fault == repair.TRUNCATED

        def put(state, way, after=after):
            after[state] = min(after.get(state, way), way)

        for state, (cost, audit) in ways.items():
            put(state, (cost + 3, audit + "D"))
            if not t.must_go:
                put(repair.NEXT[state], (cost + 2 + cut, audit + "R"))
                if (state, t.initial) in repair.KEPT:
                    put(repair.KEPT[state, t.initial], (cost + cut, audit + "K"))
        ways = after
    return min(way for state, way in ways.items() if state in (0, 3))


def test_long_conversations_are_proved_quickly():
    r = random.Random(8)
    cases = [some_turns(r, 300), some_turns(r, 300, ("user", "assistant")), some_turns(r, 200, ("user",)), some_turns(r, 200, ("system", "user"))]
    cases += [[Turn("user", "x", 3)] * 256, [Turn(x, "x", 0) for x in ("assistant", "user") * 128], [Turn("user", "x", 0), Turn("user", "x", 3), Turn("assistant", "x", 0)] * 60]
    for turns in cases:
        began = time.perf_counter()
        assert repair.cheapest(turns) == table_search(turns)
        assert time.perf_counter() - began < 5


def test_lower_bounds_hold():
    r = random.Random(1)
    for _ in range(300):
        turns = some_turns(r, r.randrange(9))
        bounds = repair.lower_bounds(turns, None)
        for i in range(len(turns) + 1):
            assert all(bounds[i][before] <= repair.cheapest(turns[i:], before)[0] for before in repair.STATES)


def report_of(rows):
    """The report by plain code; rows (conv_id, turn, role, text)."""
    out = []
    for conv in {r[0] for r in rows}:
        own = [(t, " " if ro is None else ro, " " if te is None else te) for c, t, ro, te in rows if c == conv]
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).hexdigest()))
        seen, turns = set(), []
        for _, role, text in own:
            words = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not words else 2 if (role, text) in seen else 3 if words[-1] not in ".!?" else 0
            seen.add((role, text))
            turns.append(Turn(role, text, fault))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a.role[:1] + b.role[:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        cost, audit = table_search(turns)
        body = "\n".join(f"{a}:{b}" for a, b in repair.apply_audit(turns, audit))
        out.append((conv, gaps, *(sum(t.fault == f for t in turns) for f in (1, 2, 3)), illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_rows():
    r = random.Random(12)
    rows = [(None, None, None, None), (None, 3, "user", "hi."), (None, 3, "user", "hi."), (1, 0, "", "empty role."), (1, 1, "user", ""), (2, None, "user", "no turn."), (2, None, "assistant", "none.")]
    rows += [(3, 2, "assistant", "é中" * 60_000 + "."), (3, 1, "user", "x" * 200_000), (4, 5, "user", "same."), (4, 5, "user", "same."), (4, 5, "user", "same.")]
    rows += [(c, r.randrange(900), r.choice(["user", "assistant", "system", "tool"]), r.choice(["a.", "b", "", " \n", "c!", "d. "]) + str(r.randrange(3)) + r.choice([".", ""])) for c in range(5, 12) for _ in range(r.randrange(1, 40))]
    rows += [(77, i, "user" if i % 3 else "assistant", f"line {i % 200}.") for i in range(900)]
    return rows


def test_reports_of_odd_and_cut_conversations(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*x, "extra") for x in rows], CHAT).withColumnRenamed("place", "text_md5").repartition(5)
    want = report_of(rows)
    for piece_rows in (3, 16, repair.PIECE):
        assert sorted(map(tuple, repair.repair_report(df, piece_rows=piece_rows).collect()), key=repr) == want


def test_repaired_rows_agree_with_their_hash(spark):
    df = spark.createDataFrame([(*x, "") for x in odd_rows()], CHAT)
    report = {r.conv_id: r.repaired_sha256 for r in repair.repair_report(df).collect()}
    texts = {c: [] for c in report}
    for r in sorted(repair.repaired_rows(df, piece_rows=7).collect(), key=lambda r: r.position):
        assert r.position == len(texts[r.conv_id])
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == report


def test_conversations_without_rows(spark):
    none = spark.createDataFrame([], CHAT)
    assert repair.repair_report(none).collect() == [] and repair.repaired_rows(none).collect() == []
    ids = spark.createDataFrame([(1,), (1,), (None,)], "conv_id bigint")
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert sorted(map(tuple, repair.repair_report(none, ids).collect()), key=repr) == [(1, *empty), (None, *empty)]


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(9) for t in range(9)] + [(None, 1, None, None), (3, None, "user", "x.")]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role or " ", "" if kind == 1 else re.sub("[.!?]", "", text or " ") if kind == 2 else text or " ")
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = repair.damage(spark.createDataFrame([(*x, "") for x in rows], CHAT)).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(want, key=repr)
