from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from boardlens.llm import exact_dedup
from boardlens.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences

ROOT = "/root/testdata/sf0.01"


def test_given_documents(spark):
    assert not differences(connect(ROOT), ORACLES["op13_exact_dedup"], QUERIES["op13_exact_dedup"](spark, ROOT))


def rows_of(n):
    texts = [f"text {i}" for i in range(n)] + ["hot"] * (n // 2) + [f"pair {i // 2}" for i in range(n // 4)]
    return [(i, t) for i, t in enumerate(texts)] + [(5000, None), (5001, ""), (5002, " "), (5003, "é\u0000"), (5004, "é\u0000"), (5005, "x" * 300_000), (5006, "x" * 300_000)]


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    known = {t: (max((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}
    return sorted(
        ((i, *known[t or ""], i == known[t or ""][0], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows), key=str
    )


@pytest.mark.parametrize("max_bits", [1, exact_dedup.MAX_BITS])
def test_against_plain_groups(spark, max_bits):
    """Results don't depend on how full the filter is."""
    rows = [*rows_of(400), (7, "text 7"), (7, "pair 1"), (None, "text 8"), (None, "only"), (None, "only")]
    docs = spark.createDataFrame([(i, t, "d", 1, True) for i, t in rows], "doc_id long, text string, digest string, group_size int, kept boolean")
    out = exact_dedup.exact_duplicates(docs, max_bits=max_bits)
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.digest).hex()) for r in out.collect()]
    assert sorted(got, key=str) == expected(rows)


def test_rows_alone_pass_straight_through(spark):
    docs = spark.createDataFrame(rows_of(4000), "doc_id long, text string").withColumn("d", exact_dedup.digest_of(F.col("text")))
    marked = exact_dedup.repeat_filter(docs, "d").mark(docs, "d").toPandas()
    sizes = marked.groupby("d")["doc_id"].transform("size")
    assert marked.loc[sizes > 1, "__maybe"].all()
    assert marked.loc[sizes == 1, "__maybe"].mean() < 0.05


def test_surviving_rows(spark):
    rows = [*rows_of(100), (None, "only"), (3, "text 3"), (None, "text 4")]
    docs = spark.createDataFrame([(i, t, {"k": i or 0}, [1], "s") for i, t in rows], "doc_id long, text string, m map<string,int>, `a.b` array<int>, digest string")
    out = exact_dedup.without_duplicates(docs)
    assert out.columns == docs.columns and out.schema["m"].dataType == docs.schema["m"].dataType
    best = {}
    for i, t in rows:
        best[t or ""] = max(best.get(t or "", -1), -1 if i is None else i)
    got = [(-1 if r.doc_id is None else r.doc_id, r.text or "") for r in out.collect()]
    assert sorted(got) == sorted((i, t) for t, i in best.items())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_duplicates(docs).count() == 0 and exact_dedup.without_duplicates(docs).count() == 0


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_exact_dedup"](spark, ROOT)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
