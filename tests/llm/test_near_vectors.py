from __future__ import annotations

import numpy as np

from boardlens.llm import near_vectors as nv
from boardlens.llm.common import table


def brute(rows, threshold):
    """{vec_id: (links, component)} for rows of (vec_id, vector or None, label)."""
    def good(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ok = [(i, np.array(v, float), label) for i, v, label in rows if i is not None and good(v, label)]
    links, parent = {i: 0 for i, _, _ in rows}, {i: i for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, u, a) in enumerate(ok):
        for j, v, b in ok[x + 1 :]:
            if a == b and len(u) == len(v) and u @ v / (np.linalg.norm(u) * np.linalg.norm(v)) >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = sorted((root(i), root(j)))
                parent[q] = p
    return {i: (links[i], root(i)) for i in links if i is not None}


def run(df, threshold=0.98):
    out = nv.near_vectors(df, threshold=threshold).collect()
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in out)
    return {r.vec_id: (r.n_links, r.component_id) for r in out if r.vec_id is not None}


def test_given_vectors_match_brute_force(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    assert run(df) == brute([(r.vec_id, r.embedding, r.label) for r in df.collect()], 0.98)


def test_groups_over_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(nv, "TILE_NUMBERS", 8 * 20)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 8))
    rows = [(i, [float(x) for x in base[i % 30] + rng.normal(size=8) * 0.1 * (i % 5)], i % 2) for i in range(300)]
    rows += [(300 + i, rows[7][1], 1) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert run(df) == brute(rows, 0.98)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (11, [1e-300, 0.0], 1), (12, [1e300, 0.0], 1),
            (13, [1.0, 0.0, 0.0], 1), (14, [-1.0, 0.0], 1), (None, [1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, label int, id long, h string, n int")
    got = run(df)
    with np.errstate(all="ignore"):
        want = brute([r for r in rows if r[0] not in (11, 12)], 0.98)
    assert {i for i in (1, 2, 11, 12)} == {i for i in got if got[i][1] == 1}
    assert all(got[i] == (3, 1) for i in (1, 2, 11, 12))
    assert all(got[i] == want[i] for i in want if i not in (1, 2))
    assert run(df.limit(0)) == {}


def test_bound_is_never_too_low():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 16)) ** 5
    u, q, s, e, n = nv.quantise(x)
    bound = nv._products(q, q) * s[:, None] * s + e[:, None] * n + e + nv.SLACK
    assert (bound >= u @ u.T).all()
