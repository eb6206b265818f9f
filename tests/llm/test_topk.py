from __future__ import annotations

import numpy as np
import pytest

from boardlens.llm import topk
from boardlens.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences


def brute(rows, asked, k):
    out = []
    for i, q in asked:
        best = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in rows if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def run(spark, rows, asked, k):
    make = lambda x: spark.createDataFrame(x, "id long, vector array<long>")
    return sorted(tuple(r) for r in topk.top_k(make(rows), make(asked), k).collect())


def test_given_vectors_match_sql(spark):
    name, root = "op1_topk_maxscore", "/root/testdata/sf0.01"
    assert not differences(connect(root), ORACLES[name], QUERIES[name](spark, root))


@pytest.mark.parametrize("seed,low,high", [(0, -9, 9), (1, 0, 3), (2, -50, -1), (3, 10**8, 10**8 + 9)])
def test_many_ties_and_signs_over_shards(spark, monkeypatch, seed, low, high):
    monkeypatch.setattr(topk, "SHARD", (64, 64))
    monkeypatch.setattr(topk, "QUERIES", (16, 16))
    rng = np.random.default_rng(seed)
    sparse = rng.random((300, 12)) < 0.4
    rows = [(i, [int(x) for x in v]) for i, v in enumerate(rng.integers(low, high, (300, 12)) * ~sparse)]
    rows += [(300 + i, list(rows[5][1])) for i in range(60)]
    asked = rows[::7]
    assert run(spark, rows, asked, 5) == brute(rows, asked, 5)


def test_small_and_odd_tables(spark):
    rows = [(1, [1, 2]), (2, [3]), (3, []), (3, [0, 0, 7]), (4, [-1, -1, -1])]
    padded = [(i, v + [0] * (3 - len(v))) for i, v in rows]
    assert run(spark, rows, [rows[0], rows[4]], 20) == brute(padded, [padded[0], padded[4]], 20)
    assert run(spark, [], rows[:1], 3) == [] and run(spark, rows, [], 3) == []
    nan, inf = float("nan"), float("inf")
    raw = [(1, [0.5, -0.01], 9, 9), (2, [nan, 1.0], 9, 9), (3, [inf, 1.0], 9, 9), (4, None, 9, 9), (None, [1.0, 1.0], 9, 9), (5, [None, 1.0], 9, 9), (6, [], 9, 9)]
    df = spark.createDataFrame(raw, "vec_id long, embedding array<float>, id long, vector long")
    assert sorted(tuple(r) for r in topk.quantised(df).collect()) == [(1, [32, -1]), (6, [])]
