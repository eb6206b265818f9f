from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from boardlens.llm import packing
from boardlens.llm.common import table

FILE = public_tokenizers.path("word_bpe_49k.json")


def whole(texts):
    t = Tokenizer.from_file(FILE)
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check(rows, ids, capacity):
    """All invariants of a packing; returns the number of sequences."""
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(ids)
    for i, want in ids.items():
        own = sorted(pieces[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [
            (k // capacity, k, min(capacity, len(want) - k)) for k in range(0, len(want), capacity)
        ]
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(want[r.start : r.start + r.length], "<u4").tobytes())
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
        gaps.append((min(fit) if fit else capacity) - n)
    return len(gaps)


def test_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = docs.select("doc_id", "text").collect()
    ids = dict(zip([r.doc_id for r in rows], whole([r.text for r in rows]), strict=True))
    out = packing.pack(docs, FILE).collect()
    n = check(out, ids, 4096)
    lengths = [r.length for r in out]
    assert n <= best_fit_decreasing(lengths, 4096) + 2 and n <= 1.02 * sum(lengths) / 4096 + 2


def test_added_tokens_are_taken_as_the_tokenizer_does():
    texts = ["see <|endoftext|> here", "a<|startoftext|>b", "<|ENDOFTEXT|> x", "<|endoftext|", "plain words", "<|endoftext|><|endoftext|>", None, ""]
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.Encoder(FILE)(texts)]
    assert [[*x, 1] for x in got] == whole(texts) and got[0] == [862, 49407, 763]


def test_edge_rows(spark):
    long = "word " * 30_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, long), (5, "<|endoftext|> x<|endoftext|>"), (6, "É\u00a0ı\x1c!!"), (7, "a" * 5000)]
    docs = spark.createDataFrame([(i, t, 3, "y") for i, t in rows], "doc_id long, text string, length int, task string")
    out = packing.pack(docs, FILE, capacity=64, keep_ids=True).collect()
    check(out, dict(zip([i for i, _ in rows], whole([t for _, t in rows]), strict=True)), 64)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in out)
    assert packing.pack(docs.limit(0), FILE).count() == 0
    twice = packing.pack(docs.filter("doc_id IN (1, 6)").union(docs.filter("doc_id = 6")).unionAll(spark.createDataFrame([(None, "x", 1, "")], docs.schema)), FILE).collect()
    assert sorted((r.doc_id or 0) for r in twice) == [0, 1, 6, 6] and len({(r.sequence_id, r.offset) for r in twice}) == 4


@pytest.mark.parametrize("seed", range(4))
def test_places_of_random_lengths(spark, seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(20, 200))
    n = {int(s): int(c) for s, c in zip(rng.permutation(capacity)[:40] + 1, rng.integers(1, 50, 40))}
    n[1 + seed] = 5000  # one length holds most pieces
    got = packing.places(spark.createDataFrame(list(n.items()), "length long, n long"), capacity).collect()
    used, ranks = defaultdict(list), defaultdict(list)
    for r in got:
        for k in range(r.n):
            ranks[r.size].append(r.first + k)
            used[r.bin + k % r.bins].append((r.offset + k // r.bins * r.size, r.size))
    assert {s: sorted(x) for s, x in ranks.items()} == {s: list(range(c)) for s, c in n.items()}
    for own in used.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= capacity
    lengths = [s for s, c in n.items() for _ in range(c)]
    assert len(used) <= 1.02 * best_fit_decreasing(lengths, capacity) + 1
