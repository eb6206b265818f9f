from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from boardlens.llm import near_minhash
from boardlens.llm.common import table
from boardlens.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """{doc_id: (n_shingles, component)} over rows of (doc_id, text); ids are distinct."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for x, a in enumerate(ids):
            for b in ids[x + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_given_documents_match_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    out = near_minhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_blocks_of_a_bucket_lose_no_pair(spark, monkeypatch):
    """Chains of edits, compared in blocks of two rows."""
    monkeypatch.setattr(near_minhash, "BLOCK", 2)
    rows, words = [], [f"w{i}" for i in range(60)]
    for i in range(30):
        words = words[:]
        words[(i * 7) % 60] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(near_minhash.near_duplicates(docs)) == brute(rows)


def test_edge_rows(spark):
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
         T.StructField("id", T.StringType()), T.StructField("component", T.LongType()), T.StructField("signature", T.LongType())]
    )
    long = " ".join(f"t{i % 9000}{i % 77}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one\x0btwo"), (6, "one two three"),
            (7, long), (8, long.upper()), (9, "a\xa0b c d e f"), (None, "one two"), (10, "É a b c d"), (11, "é a b c d"),
            (12, "q w e r t y"), (12, "other words that stand alone here"), (13, "other words that stand alone here")]
    docs = spark.createDataFrame([(i, t, "x", 5, 6) for i, t in rows], schema)
    out = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_minhash.near_duplicates(docs).collect()),
                 key=str)
    got = {r[0]: r[1:] for r in out if r[0] is not None and r[0] != 12}
    assert got[1] == (0, 1, True)
    assert got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False) and got[6] == (1, 6, True)
    assert got[7][1:] == (7, True) and got[8][1:] == (7, False)
    assert got[9][0] == 1 and got[10][1] == 10 and got[11][1] == 11
    assert got[13] == (2, 12, False)
    assert [r[1:] for r in out if r[0] is None] == [(1, None, True)]
    assert near_minhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("different", [0, 15, 31])
def test_pigeonhole_finds_every_pair_within_the_distance(spark, different):
    import numpy as np

    rng = np.random.default_rng(different)
    a = rng.integers(0, 65536, (40, 64)).astype("<u2")
    b = a.copy()
    for i in range(40):
        at = rng.choice(64, different, replace=False)
        b[i, at] = b[i, at] ^ 1
    rows = [(i, bytearray(x.tobytes())) for i, x in enumerate([*a, *b])]
    keys = near_minhash.index(spark.createDataFrame(rows, "id long, signature binary")).toPandas()
    held = {i: set(g["key"]) for i, g in keys.groupby("id")}
    assert all(held[i] & held[i + 40] for i in range(40))


@pytest.fixture
def many_partitions(spark):
    """Joins and aggregates in 64 partitions, and batches of three rows."""
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_tables_start_few_tasks(spark, many_partitions, monkeypatch):
    """Near copies, chains of edits and sets of unlike sizes; a written table has no file for each shuffle partition."""
    monkeypatch.setattr(near_minhash, "BLOCK", 2)
    words, rows = [f"w{i}" for i in range(300)], []
    for i in range(60):
        words = words[:]
        words[(i * 7) % 300] = f"x{i}"
        rows.append((i, " ".join(words[: 40 + 4 * i])))
    rows += [(100 + i, " ".join([f"y{j}" for j in range(120)] + [f"own{i}"])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    files = []
    monkeypatch.setattr(near_minhash, "remove", lambda *tables: files.extend(len(t.inputFiles()) for t in tables))
    assert found(near_minhash.near_duplicates(docs)) == brute(rows)
    assert max(files) <= spark.sparkContext.defaultParallelism


def test_components_of_few_edges_lie_in_few_files(spark, many_partitions):
    edges = spark.range(1000).selectExpr("id AS a", "id + (id % 7 = 0)::int * 7 + 1 AS b").localCheckpoint()
    out = components(edges)
    assert len(out.inputFiles()) <= spark.sparkContext.defaultParallelism
    parent = list(range(1010))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in edges.collect():
        a, b = sorted((root(r.a), root(r.b)))
        parent[b] = a
    assert {r.id: r.component for r in out.collect()} == {i: root(i) for e in edges.collect() for i in (e.a, e.b)}
