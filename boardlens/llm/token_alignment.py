"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Every token points to the farthest-right token that overlaps it: a token of the first kind to the one of the
second that holds its last byte, and back if that token reaches further. Doubling the pointers, each then pointing to where its
target points, ends after as many steps as the logarithm of the longest chain, with all tokens of a component at
its last one, whose end is a common boundary. Tokens with the same last one are a group.

Both tokenizers cut between a sign that is no white space and a blank or line end, and no rule or piece of theirs
reaches across. So a text is cut there, the distinct parts new to a task are encoded and aligned together in
one array operation, and a text's groups are those of its parts in a row. Where a vocabulary has pieces across such places, whole
texts are aligned instead.

Counts of linked id pairs are one aggregate over all documents. Pairs that hold more than a fixed part
of all links are looked up by a broadcast bounded by that part; the many rare ones by a shuffled join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import process_table, remove, written

#: Parts that a process remembers (about 400 bytes each) and their longest length.
MEMORY = 250_000
LONGEST = 64
#: Characters of the texts that are taken together.
CHARACTERS = 1_000_000
#: Id pairs with more than this part of all links are broadcast: at most so many, of 20 bytes.
FREQUENT = 1 << 18
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_LOADED: dict[tuple[str, str], Any] = {}


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary.

    Printable bytes of Latin-1 stand for themselves, the others for the signs from U+0100 on in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers and the bytes of each of their tokens."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=pieces)
        signs = byte_signs()
        entries = self.a.get_vocab()
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.a_bytes[i] = bytes(signs[c] for c in entry) if all(c in signs for c in entry) else entry.encode()
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.blank = self.b.piece_to_id("▁")
        whole = [p.replace("▁", " ") for i, p in enumerate(names) if not self.b.is_byte(i)]
        before = json.loads(self.a.to_str()).get("pre_tokenizer") or {}
        splits = before.get("type") == "ByteLevel" and before.get("use_regex", True)
        self.cuts = bool(splits) and not any("\n" in p or re.search("[^ ] ", p) for p in whole)

    def parts(self, text: str) -> list[str]:
        """Parts of a blank and the text that are tokenised independently."""
        return _CUT.split(" " + text) if self.cuts else [" " + text]

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        # the second tokenizer puts a blank before a text; parts that start with another sign lose it again
        own = [p[0] == " " for p in parts]
        b = self.b.encode([p[1:] if o else p for p, o in zip(parts, own, strict=True)], num_threads=1)
        return a, [(ids or [self.blank]) if o else ids[1:] for ids, o in zip(b, own, strict=True)]


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The last token's number among the second kind for each token of the first kind and then of the second.

    Ends are byte offsets in ascending order, and the last ones are equal.
    """
    n = len(a_ends)
    over_a = np.searchsorted(b_ends, a_ends)
    over_b = np.searchsorted(a_ends, b_ends)
    at_b = np.arange(n, n + len(b_ends))
    to = np.concatenate([n + over_a, np.where(a_ends[np.minimum(over_b, max(0, n - 1))] > b_ends, over_b, at_b) if n else at_b])
    while True:
        further = to[to]
        if (further == to).all():
            return to - n
        to = further


class Aligner:
    """Groups of texts: (tokens of each kind, groups, linked ids as pairs of 32-bit numbers, groups as text)."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        key = byte_level, pieces
        if key not in _LOADED:
            _LOADED[key] = Vocabularies(*key)
        self.words = _LOADED[key]
        self.known = process_table(f"{byte_level}|{pieces}")
        self.missed = 0

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, np.ndarray, str] | None]:
        """None for texts without tokens."""
        split = [self.words.parts(t) if t else [] for t in texts]
        known = self.known
        new = list(set().union(*split).difference(known))
        full = len(known) + len(new) > MEMORY
        known.update(zip(new, self.align(new), strict=True))
        for parts in split:
            found = [known[p] for p in parts]
            if not found or None in found:
                yield None
                continue
            a, b, groups, links, shown = zip(*found, strict=True)
            yield sum(a), sum(b), sum(groups), np.frombuffer(b"".join(links), "<i4").reshape(-1, 2), ";".join(shown)
        if full:
            self.missed += len(new)
        if self.missed > 4 * MEMORY:
            self.missed = 0
            known.clear()
        for p in new:
            if full or len(p) > LONGEST:
                known.pop(p, None)

    def align(self, parts: list[str]) -> Iterator[tuple[int, int, int, bytes, str] | None]:
        """Each part's record, or None if the bytes of its tokens are not its own; all parts in one pass."""
        w = self.words
        a, b = w.encode(parts) if parts else ([], [])
        same = [
            b"".join(map(w.a_bytes.__getitem__, x)) == (own := p.encode()) == b"".join(map(w.b_bytes.__getitem__, y))
            for p, x, y in zip(parts, a, b, strict=True)
        ]
        a_ids = np.array([i for x, ok in zip(a, same, strict=True) if ok for i in x], np.int64)
        b_ids = np.array([i for y, ok in zip(b, same, strict=True) if ok for i in y], np.int64)
        a_ends, b_ends = np.cumsum(w.a_sizes[a_ids]), np.cumsum(w.b_sizes[b_ids])
        last = terminals(a_ends, b_ends)
        a_last, b_last = last[: len(a_ids)], last[len(a_ids) :]
        # links: the last tokens of both kinds in a group end together
        tail_a = np.flatnonzero(np.diff(a_last, append=-1))
        tail_b = a_last[tail_a]
        links = np.stack([a_ids[tail_a], b_ids[tail_b]], axis=1).astype("<i4")
        # tokens of group g: those behind the tail of the group before it
        a_cut, b_cut = [0, *(tail_a + 1).tolist()], [0, *(tail_b + 1).tolist()]
        a_text, b_text = list(map(str, a_ids.tolist())), list(map(str, b_ids.tolist()))
        group = np.searchsorted(tail_b, b_last)
        stops = np.cumsum([len(y) if ok else 0 for y, ok in zip(b, same, strict=True)])
        g = 0
        for x, y, ok, stop in zip(a, b, same, stops.tolist(), strict=True):
            if not ok:
                yield None
                continue
            until = int(group[stop - 1]) + 1
            shown = ";".join(f"{','.join(a_text[a_cut[k] : a_cut[k + 1]])}|{','.join(b_text[b_cut[k] : b_cut[k + 1]])}" for k in range(g, until))
            yield len(x), len(y), until - g, links[g:until].tobytes(), shown
            g = until


def aligned(
    docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text", keep_groups: bool = False
) -> DataFrame:
    """row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links (and groups as text) of each document.

    links holds the distinct linked id pairs and how often each occurs. Texts that are null, empty, or whose
    tokens' bytes are not a blank and the text have no tokens: zeros, '' and no links. Repeated rows and rows
    without an id are documents of their own, told apart by row. An empty table gives none; other columns don't matter.
    """
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, row = Aligner(byte_level, pieces), TaskContext.get().partitionId() << 33
        for batch in batches:
            sizes, hashes, texts, counts, pairs, times = [], [], [], [0], [], []
            for found in _by_size(align, (value.as_py() for value in batch.column("text"))):
                a, b, groups, links, shown = found or (0, 0, 0, np.empty((0, 2), "<i4"), "")
                pair, n = np.unique(links[:, 0].astype(np.int64) << 32 | links[:, 1], return_counts=True)
                sizes.append((a, b, groups, len(links)))
                hashes.append(hashlib.sha256(shown.encode()).hexdigest() if found else "")
                texts.append(shown if keep_groups else None)
                counts.append(counts[-1] + len(pair))
                pairs.append(pair)
                times.append(n)
            pair, n = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (pairs, times))
            held = pa.StructArray.from_arrays([pa.array((pair >> 32).astype("i4")), pa.array(pair.astype("i4")), pa.array(n.astype("i4"))], names=["a", "b", "n"])
            columns = [pa.array(np.arange(row, row + len(sizes))), batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in zip(*sizes, strict=True)]]
            columns += [pa.array(hashes, pa.string()), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), held), pa.array(texts, pa.string())]
            row += len(sizes)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = "n_a long, n_b long, n_groups long, n_links long"
    out = rows.mapInArrow(run, f"row long, doc_id {kind}, {counts}, groups_sha256 string, links array<struct<a: int, b: int, n: int>>, groups string")
    return out if keep_groups else out.drop("groups")


def _by_size(align: Aligner, texts: Iterable[str | None]) -> Iterator[tuple | None]:
    """Short texts are aligned together."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size > CHARACTERS:
            yield from align(part)
            part, size = [], 0
    yield from align(part)


def pair_counts(rows: DataFrame) -> DataFrame:
    """a, b, count, best of each linked id pair of ``aligned`` rows: its links, and if no pair of b has more."""
    counts = written(rows.select(F.inline("links")).groupBy("a", "b").agg(F.sum("n").alias("count")))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    out = written(counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best")))
    remove(counts)
    return out


def link_sums(rows: DataFrame, pairs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """row, n_best, count_sum of each row with links."""
    total = pairs.agg(F.sum("count")).first()[0] or 0
    often = F.col("count") * frequent > total
    # fewer than ``frequent`` pairs can hold that part of all links each
    known = rows.select("row", F.inline("links")).join(F.broadcast(pairs.filter(often)), ["a", "b"], "left")
    rest = known.filter("count IS NULL").select("row", "a", "b", "n").join(pairs.filter(~often), ["a", "b"])
    sums = [F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")]
    parts = [p.groupBy("row").agg(*sums) for p in (known.filter("count IS NOT NULL"), rest.select("row", "n", "count", "best"))]
    return parts[0].unionByName(parts[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row per document, see ``aligned``."""
    rows = written(aligned(docs, byte_level, pieces, doc_id, text))
    pairs = pair_counts(rows)
    digest = rows.drop("links").join(link_sums(rows, pairs), "row", "left").fillna(0, ["n_best", "count_sum"])
    out = written(digest.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
    remove(rows, pairs)
    return out
