"""Hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliogrid.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, vec string"


def test_strassen_is_exact():
    r = np.random.default_rng(2)
    for m, k, n in [(1, 1, 1), (17, 33, 9), (64, 64, 64), (100, 37, 211), (3, 200, 50), (40, 1, 40)]:
        a, b = r.integers(-(2**25), 2**25, (m, k)), r.integers(-(2**25), 2**25, (k, n))
        assert (negatives.strassen(a, b) == a @ b).all()


def test_heaps_merge_like_one_sort():
    r = random.Random(4)
    entries = [(r.randrange(6), r.randrange(9), r.randrange(50), i) for i in range(3000)]
    heaps = negatives.Heaps(6, 7)
    for start in range(0, len(entries), 250):
        heaps.push(*map(np.array, zip(*entries[start : start + 250], strict=True)))
        heaps.merge()
    want = []
    for slot in range(6):
        want += sorted((e for e in entries if e[0] == slot), key=lambda e: (-e[1], e[2], e[3]))[:7]
    assert list(zip(*(x.tolist() for x in heaps.merge()), strict=True)) == want
    assert all(heaps.floor[s] == min(w[1] for w in want if w[0] == s) for s in range(6))


def brute(rows, n_positives=5, n_negatives=10):
    """Rows as tuples; the place in the list is the row's own number."""
    last = 2**63 - 1
    good = [
        (i, r[0], r[2], [math.floor(256 * float(np.float32(x))) for x in r[1]])
        for i, r in enumerate(rows)
        if r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    out = []
    for i, a, label, q in good:
        if a is None or a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(q, p, strict=False)), last if v is None else v, j, other == label) for j, v, other, p in good if j != i]
        for score, v, _, _ in sorted(s for s in scored if s[3])[:n_positives]:
            fits = sorted(s for s in scored if not s[3] and 30 * -score <= 100 * -s[0] <= 90 * -score)[:n_negatives]
            out += [(a, None if v == last else v, k, None if s[1] == last else s[1], -score, -s[0]) for k, s in enumerate(fits, 1)]
    return sorted(out, key=repr)


def test_odd_rows(spark):
    """Nulls anywhere, not finite, short and empty vectors, equal scores, repeated rows, a column named like an own one."""
    r = random.Random(9)
    vector = lambda n=6: [r.choice([-1.0, -0.25, 0.0, 0.3, 0.5, 1.0]) for _ in range(n)]
    rows = [(i * 20, vector(), r.randrange(4), "x") for i in range(120)]
    rows += [(None, vector(), 1, None), (None, vector(), 2, "y"), (100, vector(), 1, "z"), (200, vector(), None, "z"), (300, None, 1, "z")]
    rows += [(400, [0.5, None], 1, "z"), (500, [0.5, float("nan")], 1, "z"), (600, [float("inf")] * 6, 1, "z"), (700, vector(2), 1, "z"), (800, [], 2, "z")]
    rows += [rows[5], rows[5], (200, vector(), 3, "z"), (1_000_003, vector(9), 0, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for chunk in (3, 8192):
        found = negatives.mine(df, F.col("vec_id") % 100 == 0, chunk=chunk)
        assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_tiles_longer_than_one(spark, monkeypatch):
    r = random.Random(5)
    rows = [(i * 5, [r.uniform(-1, 1) for _ in range(8)], r.choice([0, 0, 0, 1, 2]), "") for i in range(700)]
    monkeypatch.setattr(negatives, "TILE", 64)
    found = negatives.mine(spark.createDataFrame(rows, SCHEMA).repartition(2), F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows)


def test_nothing_to_find(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(empty, F.col("vec_id") % 100 == 0).collect() == []
    rows = [(100, [1.0], 1, ""), (101, [1.0], 1, ""), (102, [2.0], 2, "")]
    assert negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 7).collect() == []
    assert negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0).collect() == []
    with pytest.raises(ValueError, match="2\\*\\*54"):
        negatives.mine(spark.createDataFrame([(100, [1e30], 1, "")], SCHEMA), F.col("vec_id") % 100 == 0)
