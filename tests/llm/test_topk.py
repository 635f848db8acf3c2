import math
import random

import numpy as np
import pytest

from sparcel.llm import topk

SCHEMA = "vec_id long, embedding array<double>, score string"


def brute(rows, queries, k):
    def q(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [int(x) * 64 if abs(x) >= 2**53 else math.floor(64 * x) for x in v]

    all_rows = [(i, q(v)) for i, v in rows if i is not None and q(v) is not None]
    asked = {(i, tuple(q(v))) for i, v in queries if i is not None and q(v) is not None}
    out = []
    for i, v in asked:
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in all_rows if j != i and len(w) == len(v))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, queries, k):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)
    asked = spark.createDataFrame([(i, v, "x") for i, v in queries], SCHEMA)
    return sorted(map(tuple, topk.top_k(topk.build_index(df), asked, k).collect()))


@pytest.mark.parametrize(("seed", "dim", "block"), [(0, 1, 1 << 15), (1, 5, 64), (2, 16, 100), (3, 3, 7)])
def test_random(spark, monkeypatch, seed, dim, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERIES", 9)
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(0, (0.02, 0.5, 30)[seed % 3], dim)]) for i in rng.permutation(300)]
    assert run(spark, rows, rows[::7], 11) == brute(rows, rows[::7], 11)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (2, [-1.0, 3.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0])]
    rows += [(7, [1.0, 2.0, 3.0]), (8, []), (9, [0.0, 0.0]), (10, [0.0, 0.0]), (10, [0.0, 0.0]), (11, [-0.001, -0.001])]
    rows += [(100 + i, [0.25, 0.25]) for i in range(50)]
    queries = [*rows, rows[0]]
    assert run(spark, rows, queries, 5) == brute(rows, queries, 5)
    assert run(spark, rows, [], 5) == [] and run(spark, [], queries, 5) == []
    assert len(run(spark, rows[:2], rows[:1], 20)) == 1


def test_components_of_any_size(spark):
    rng = random.Random(5)
    sizes = [0.0, 1e-300, -1e-5, 0.3, 1.0, -7.25, 1e3, 1e9, -3e9, 1e14]
    rows = [(1, [1e9, 0.0]), (2, [3.0, 1e9]), (3, [1e14, 0.5]), (4, [1.0, 1.0]), (5, [0.0, 1e-300]), (6, [-1e14, -1.0]), (7, [1e300, 0.0])]
    rows += [(10 + i, [rng.choice(sizes[:7]), rng.choice(sizes)]) for i in range(200)]
    small = [(i, v) for i, v in rows if abs(v[0]) < 1e4 and abs(v[1]) < 1e4] + [(900, [0.0, 3.0]), (901, [0.0, -2.0]), (902, [0.0, 0.0])]
    queries = [(900, [0.0, 3.0]), (901, [0.0, -2.0]), (902, [0.0, 0.0])] + small[:20]
    assert run(spark, small, queries, 6) == brute(small, queries, 6)
    # against rows of every size, for queries whose scores fit
    asked = [(900, [0.0, 3.0]), (901, [0.0, -2.0]), (902, [0.0, 1e-300])]
    assert run(spark, rows, asked, 6) == brute(rows, asked, 6)
    # products beyond 64 bits that cancel out
    both = [(1, [1e12, 1e12]), (2, [1e12, -1e12]), (3, [2.0**40, -(2.0**40)]), (4, [-1e12, 1e12])]
    assert run(spark, both[:1] + both[1:3], [both[0]], 2) == brute(both[:1] + both[1:3], [both[0]], 2)
    with pytest.raises(Exception, match="does not fit 64 bits"):
        run(spark, both, [both[0], (5, [1e12, 1e12])], 3)
