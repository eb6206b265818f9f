from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlens.llm import mixing
from boardlens.llm.common import table, written
from boardlens.llm.queries import QUERIES, domains_of


def members(spark, n=400, size=3, seed=0):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet([0.3] * size, n)
    tokens = rng.integers(0, 500, n)
    rows = [(int(t), x.tolist()) for t, x in zip(tokens, p)]
    return spark.createDataFrame(rows, "tokens long, p array<double>"), tokens, p


@pytest.mark.parametrize("seed,floor,share", [(0, 0.0, [0.5, 0.3, 0.2]), (1, 0.0, [0.98, 0.01, 0.01]), (2, 0.8, [0.36, 0.34, 0.3]), (3, 0.0, [1, 0, 0])])
def test_rates_meet_targets(spark, seed, floor, share):
    df, tokens, p = members(spark, seed=seed)
    total = tokens.sum()
    found = mixing.fit_rates(df, ["a", "b", "c"], dict(zip("abc", np.array(share) * total)), floor)
    rows = df.select("tokens", "p", mixing.rate(F.col("p"), found.steps, floor).alias("r")).collect()
    got = sum(r.tokens * r.r * np.array(r.p) for r in rows)
    assert min(r.r for r in rows) >= floor - 1e-12
    assert np.allclose(got, found.totals, rtol=1e-9, atol=1e-6)
    # against projected gradient over all documents in one array
    m = np.linalg.pinv((p * tokens[:, None]).T @ p)
    r = np.ones(len(tokens))
    for _ in range(2000):
        r = np.maximum(floor, r + p @ (m @ (np.array(share) * total - (tokens * r) @ p)))
    best = np.abs((tokens * r) @ p - np.array(share) * total).max()
    assert np.abs(got - np.array(share) * total).max() <= max(2e-3 * total, 1.05 * best)
    assert found.met == (np.abs(got - np.array(share) * total).max() <= 1e-3 * total) and (found.met or found.gradient < 0.15)


def test_given_documents(spark):
    root = "/root/testdata/sf0.01"
    docs = table(spark, root, "documents")
    labelled = domains_of(table(spark, root, "labels"))
    model = mixing.fit_domains(docs, labelled)
    found = mixing.fit_mixture(docs, model, {"good": 0.9, "poor": 0.1, "toxic": 0.0}, floor=1.0)
    rows = mixing.memberships(docs, model).withColumn("r", found.rate()).collect()
    assert all(abs(sum(r["__p"]) - 1) < 1e-9 and r.r >= 1 for r in rows)
    likely = {r.doc_id: model.domains[int(np.argmax(r["__p"]))] for r in rows}
    known = [(likely[r.doc_id], r.domain) for r in labelled.collect()]
    assert np.mean([a == b for a, b in known if b != "toxic"]) > 0.9
    out = mixing.mixed(docs, model, found)
    assert out.columns == docs.columns
    count = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(np.floor(r.r) <= count[r.doc_id] <= np.ceil(r.r) for r in rows)


def test_targets_of_the_query(spark):
    """The rows themselves add up to the targets they carry."""
    rows = QUERIES["op2_mixing"](spark, "/root/testdata/sf0.01")
    names = [c.removeprefix("target_") for c in rows.columns if c.startswith("target_")]
    rows.createOrReplaceTempView("rows_of_op2")
    assert rows.filter("NOT targets_met").count() == 0 and set(names) == {"good", "poor", "toxic"}
    for d in names:
        got, want, size = spark.sql(f"SELECT sum(tokens * rate * p_{d}), max(target_{d}), sum(tokens) FROM rows_of_op2").first()
        assert abs(got - want) <= 1e-3 * size


def test_rare_domain_keeps_its_small_share(spark):
    df = spark.createDataFrame([(1000, [1 - 1e-4, 1e-4])] * 500, "tokens long, p array<double>")
    found = mixing.fit_rates(df, ["a", "b"], {"a": 500_000 * (1 - 1e-4), "b": 50.0})
    assert found.met and np.isclose(found.totals[1], 50.0)


def test_written_memberships_give_the_same(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = mixing.fit_domains(docs, domains_of(table(spark, "/root/testdata/sf0.001", "labels")))
    rows = written(mixing.memberships(docs, model, keep=tuple(docs.columns)))
    shares = {"good": 0.7, "poor": 0.3}
    once, again = mixing.fit_mixture(rows, model, shares, 1.0), mixing.fit_mixture(docs, model, shares, 1.0)
    assert np.allclose(once.totals, again.totals)
    assert sorted(mixing.mixed(rows, model, once).collect()) == sorted(mixing.mixed(docs, model, once).collect())


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "x"), (4, "y " * 50_000)]
    docs = spark.createDataFrame([(*r, 1.0, [0.1], "q") for r in rows], "doc_id long, text string, rate double, p array<double>, domain string")
    one = spark.createDataFrame([(3, "a"), (None, "b"), (4, None)], "doc_id long, domain string")
    for labelled in (one, one.limit(0)):
        model = mixing.fit_domains(docs, labelled)
        found = mixing.fit_mixture(docs, model, {"a": 1.0})
        out = mixing.mixed(docs, model, found)
        assert out.columns == docs.columns and out.count() == len(rows)
        empty = docs.limit(0)
        assert mixing.mixed(empty, model, mixing.fit_mixture(empty, model, {"a": 1.0})).count() == 0
