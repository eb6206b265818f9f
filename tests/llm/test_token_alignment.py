from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from boardlens.llm import token_alignment as ta
from boardlens.llm.common import table
from boardlens.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(texts):
    """Values of COLUMNS for each text: whole texts through the plain tokenizers, byte by byte."""
    a_tok, b_tok = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    back, signs = {v: k for k, v in a_tok.get_vocab().items()}, ta.byte_signs()
    docs = []
    for t in texts:
        a = a_tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_tok.encode(t) if t else []
        a_bytes = [bytes(signs[c] for c in back[i]) for i in a]
        b_bytes = []
        for i in b:
            p = b_tok.id_to_piece(i)
            b_bytes.append(bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode())
        whole = (" " + (t or "")).encode()
        if not t or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append(None)
            continue
        ends = []
        for parts in (a_bytes, b_bytes):
            at, own = 0, {}
            for k, x in enumerate(parts):
                at += len(x)
                own[at] = k
            ends.append(own)
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, links, i, j = [], [], 0, 0
        for e in common:
            k, m = ends[0][e], ends[1][e]
            groups.append(",".join(map(str, a[i : k + 1])) + "|" + ",".join(map(str, b[j : m + 1])))
            links.append((a[k], b[m]))
            i, j = k + 1, m + 1
        docs.append((len(a), len(b), ";".join(groups), links))
    counts = Counter(p for d in docs if d for p in d[3])
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, shown, links = d
        best = sum(counts[p] == top[p[1]] for p in links)
        out.append((a, b, len(links), len(links), best, sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest()))
    return out


def values(df):
    got = df.collect()
    assert got and [c for c in df.columns if c != "doc_id"] == COLUMNS
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *(r[c] for c in COLUMNS)) for r in got)


def test_given_documents(spark):
    root = "/root/testdata/sf0.01"
    rows = table(spark, root, "documents").select("doc_id", "text").collect()
    want = plain([r.text for r in rows])
    assert values(QUERIES["op11_token_alignment"](spark, root)) == sorted((False, r.doc_id, *w) for r, w in zip(rows, want, strict=True))


def strange(rng):
    alphabet = ["a", "be", "The", " ", " ", "  ", "\n", "\r", "\t", ".", "'s", "'", "12", "é", "é", "ﬁ", "１", " ", "　", " ", "\x1c", "\x85", "​", "😀", "漢字", "\u0000", "<s>", "<|endoftext|>", "<0x41>", "();\r", "{"]
    out = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 30)))
    return out + ("▁x" if rng.random() < 0.03 else "")


def test_strange_texts(spark):
    """Parts give what the tokenizers make of the whole texts."""
    rng = random.Random(11)
    texts = [None, "", " ", "\n", "  ", " x", "x ", "a▁b", "x" * 5000, "word " * 30_000, "<|endoftext|>", "é\n\n  b"] + [strange(rng) for _ in range(4000)]
    rows = [(i, t, i, "z") for i, t in enumerate(texts)] + [(5, texts[20], 0, "z"), (None, "only", 0, "z"), (None, None, 0, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, links string")
    want = plain([r[1] for r in rows])
    assert values(ta.align_documents(df, A, B)) == sorted((r[0] is None, r[0] or 0, *w) for r, w in zip(rows, want, strict=True))


@pytest.mark.parametrize("frequent", [1, 50, 1 << 18])
def test_sums_by_either_way(spark, frequent):
    texts = [" ".join(f"w{i % k}" for i in range(40)) + f" tail{k}" for k in range(1, 30)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = ta.aligned(rows, A, B).cache()
    got = found.join(ta.link_sums(found, ta.pair_counts(found), frequent), "row").collect()
    assert {(r.doc_id, r.n_best, r.count_sum) for r in got} == {(i, w[4], w[5]) for i, w in enumerate(plain(texts))}


def test_pointer_jumping_against_walking():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.choice(n, rng.integers(0, n)) + 1, n)) for _ in "ab")
        common = np.intersect1d(a, b)
        want = [np.searchsorted(b, common[np.searchsorted(common, e)]) for e in [*a, *b]]
        assert ta.terminals(a, b).tolist() == want


def test_groups_as_text(spark):
    docs = spark.createDataFrame([(1, "Hello world"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in ta.aligned(docs, A, B, keep_groups=True).collect()}
    assert hashlib.sha256(rows[1].groups.encode()).hexdigest() == rows[1].groups_sha256 and rows[2].groups == rows[2].groups_sha256 == ""


def test_empty_table(spark):
    assert ta.align_documents(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0
