"""Best-fit packing of tokenised documents into sequences of fixed capacity, in bulk-synchronous rounds.

Pieces of equal length are interchangeable, and so are sequences with equal gaps; both are kept as runs
(a length or gap, a first number and a count). There are at most as many lengths as the capacity, so
the tables of a round don't grow with the corpus. A round splits runs of pieces and gaps into ranges of size; each
range is sorted and swept downwards on its own: a piece takes the smallest gap that holds it (its successor), the
pieces of a length share the gaps by their rank, and what is left of a gap goes back into the sweep or, if
it is too small for the range, into the next round. Rounds repeat with half as many ranges. The last
has one and opens new sequences for what fits nowhere. Documents are only touched twice: to count
lengths, and to look up the place of each rank.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardlens.llm.common import process_table, written

#: Ranges of the rounds.
ROUNDS = (8, 4, 2, 1)
#: Parts that a process remembers (about 200 bytes each) and their longest length.
MEMORY = 600_000
LONGEST = 64
#: Words encoded as one text, and characters of the texts that are taken together.
TOGETHER = 2000
CHARACTERS = 1_000_000
_RUNS = "kind string, size int, first long, n long, bins long, bin long, offset int"
_LOADED: dict[str, Any] = {}


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    The tokenizer lower-cases and then splits at white space and between letters or digits and signs, and
    no rule looks across. So the ids of a text are those of its blank-separated parts in a row, and a stop
    or comma between a word and a blank is a part of its own. Parts are encoded once and remembered for
    all tasks of a process, up to a number; when many are missed the table starts anew. Added tokens are
    found in the raw text before it is split, as the tokenizer does: texts that hold one are encoded whole.
    """

    def __init__(self, file: str) -> None:
        if file not in _LOADED:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(file)
            vocabulary = tokenizer.get_vocab()
            last = np.zeros(max(vocabulary.values()) + 1, bool)
            last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
            added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
            _LOADED[file] = tokenizer, last, re.compile("|".join(map(re.escape, added)) or r"(?!)", re.IGNORECASE)
        self.tokenizer, self.last, self.added = _LOADED[file]
        self.known = process_table(file)
        self.missed = 0

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        whole = {i for i, t in enumerate(texts) if t and self.added.search(t)}
        split = [self.parts(t) if t and i not in whole else [] for i, t in enumerate(texts)]
        known = self.known
        new = set().union(*split).difference(known)
        full = len(known) + len(new) > MEMORY
        words = [p for p in new if p.isalpha()]
        for k in range(0, len(words), TOGETHER):
            known.update(self._words(words[k : k + TOGETHER]))
        known.update(self._each([p for p in new if not p.isalpha()]))
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for i, (_, ids) in zip(sorted(whole), self._each([texts[i] for i in sorted(whole)]), strict=True):
            out[i] = ids
        if full:
            self.missed += len(new)
        if self.missed > 4 * MEMORY:
            self.missed = 0
            known.clear()
        for p in new:
            if full or len(p) > LONGEST:
                known.pop(p, None)
        return out

    def _each(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return ((p, np.array(e.ids, "<u4").tobytes()) for p, e in zip(parts, found, strict=True))

    def _words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters in one text: each ends with the one token of it that is marked as last."""
        found = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(words):  # a letter that the tokenizer takes apart
            return self._each(words)
        data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return ((w, data[cuts[i] : cuts[i + 1]]) for i, w in enumerate(words))

    @staticmethod
    def parts(text: str) -> list[str]:
        text = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split(" ")
        # in Latin-1 a letter's lower case is one letter, whatever is next to it
        text = text.lower()
        only_words = text.replace(" ", "").replace(".", "").replace(",", "").isalnum()
        if only_words and not (".." in text or ",," in text or ".," in text or ",." in text):
            text = text.replace(". ", " . ").replace(", ", " , ")
        return text.split(" ")


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, doc_id: str, text: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, task, place (and ids): the pieces of each row.

    place counts the pieces of a length within a task, so that no sort is needed to number them.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = Encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            row, piece, start, length, crc, place, ids = [], [], [], [], [], [], []
            for i, data in enumerate(_encoded(encode, (value.as_py() for value in batch.column("text")))):
                data += end
                for k in range(0, len(data) // 4, capacity):
                    part = data[4 * k : 4 * (k + capacity)]
                    n = len(part) // 4
                    row.append(i)
                    piece.append(k // capacity)
                    start.append(k)
                    length.append(n)
                    crc.append(zlib.crc32(part))
                    place.append(seen[n])
                    ids.append(part if keep_ids else None)
                    seen[n] += 1
            columns = [
                batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()), pa.array(place, pa.int64()), pa.array(ids, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "task", "place", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, task int, place long, ids binary")
    return out if keep_ids else out.drop("ids")


def _encoded(encode: Encoder, texts: Iterable[str | None]) -> Iterator[bytes]:
    """Texts are encoded together as far as they are short, for fewer calls with fewer new parts each."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size > CHARACTERS:
            yield from encode(part)
            part, size = [], 0
    yield from encode(part)


class Sweep:
    """One range's sweep over runs of gaps, from the longest pieces down."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.sizes: list[int] = []  # gaps in order
        self.runs: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, sequences)
        self.placed: list[tuple] = []

    def add(self, gap: int, first: int, n: int) -> None:
        if gap <= 0 or n <= 0:
            return
        if gap not in self.runs:
            insort(self.sizes, gap)
            self.runs[gap] = []
        self.runs[gap].append((first, n))

    def fit(self, size: int, first: int, n: int) -> tuple[int, int]:
        """Places pieces ``first`` to ``first + n`` of a size as far as gaps hold them; returns the rest."""
        while n:
            at = bisect_left(self.sizes, size)
            if at == len(self.sizes):
                break
            gap = self.sizes[at]
            start, bins = self.runs[gap].pop()
            if not self.runs[gap]:
                del self.runs[gap], self.sizes[at]
            used = self.fill(size, first, n, gap, start, bins)
            first, n = first + used, n - used
        return first, n

    def fill(self, size: int, first: int, n: int, gap: int, start: int, bins: int) -> int:
        """Best fit puts as many of equal pieces into a gap as it holds before it takes the next gap."""
        each = gap // size
        full = min(bins, n // each)
        offset, used = self.capacity - gap, full * each
        if full:
            self.placed.append(("placed", size, first, used, full, start, offset))
            self.add(gap - each * size, start, full)
        if full < bins and n > used:
            rest = min(n - used, each)
            self.placed.append(("placed", size, first + used, rest, 1, start + full, offset))
            self.add(gap - rest * size, start + full, 1)
            full, used = full + 1, used + rest
        self.add(gap, start + full, bins - full)
        return used

    def left(self) -> list[tuple]:
        return [("gap", gap, first, n, None, None, None) for gap in self.sizes for first, n in self.runs[gap]]


def _round(runs: DataFrame, ranges: int, capacity: int, fresh: int | None) -> DataFrame:
    """One round over runs of kinds piece and gap; ``fresh``: the first new sequence, if new ones are opened."""

    def sweep(frame: pd.DataFrame) -> pd.DataFrame:
        s, todo, opened = Sweep(capacity), [], fresh
        for kind, size, first, n in zip(frame["kind"], frame["size"].tolist(), frame["first"].tolist(), frame["n"].tolist(), strict=True):
            if kind == "gap":
                s.add(size, first, n)
            else:
                todo.append((size, first, n))
        for size, first, n in sorted(todo, reverse=True):
            first, n = s.fit(size, first, n)
            if n and opened is not None:
                bins = -(-n // (capacity // size))
                s.fill(size, first, n, capacity, opened, bins)
                opened, n = opened + bins, 0
            if n:
                s.placed.append(("piece", size, first, n, None, None, None))
        out = pd.DataFrame(s.placed + s.left(), columns=["kind", "size", "first", "n", "bins", "bin", "offset"])
        return out.astype({"size": "int32", "first": "int64", "n": "int64", "bins": "Int64", "bin": "Int64", "offset": "Int32"})

    part = F.floor((F.col("size") - 1) * ranges / F.lit(capacity)).alias("range")
    return runs.select(part, "kind", "size", "first", "n").groupBy("range").applyInPandas(sweep, _RUNS)


def places(lengths: DataFrame, capacity: int) -> DataFrame:
    """lengths: length, n. Gives size, first, n, bins, bin, offset: where the pieces of each rank go.

    The piece of rank r in ``first`` to ``first + n`` goes into sequence bin + (r - first) % bins, at
    offset + (r - first) // bins * size.
    """
    size = F.col("length").cast("int").alias("size")
    large = lengths.filter(F.col("length") * 2 > capacity).select(size, "n")
    # pieces longer than half a sequence never share one: each opens its own, the longest first
    opened = large.select(
        "size", "n", (F.sum("n").over(Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("bin")
    )
    none = F.lit(None)
    start = opened.select(
        F.lit("placed").alias("kind"), "size", F.lit(0).cast("long").alias("first"), "n", F.col("n").alias("bins"), "bin", F.lit(0).alias("offset")
    )
    gaps = opened.filter(F.col("size") < capacity).select(
        F.lit("gap"), (F.lit(capacity) - F.col("size")).cast("int"), "bin", "n", none.cast("long"), none.cast("long"), none.cast("int")
    )
    small = lengths.filter(F.col("length") * 2 <= capacity).select(
        F.lit("piece"), size, F.lit(0).cast("long"), "n", none.cast("long"), none.cast("long"), none.cast("int")
    )
    runs = written(start.union(gaps).union(small))
    parts = [runs.filter("kind = 'placed'")]
    fresh = runs.filter("kind = 'placed'").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    for ranges in ROUNDS:
        runs = written(_round(runs.filter("kind <> 'placed'"), ranges, capacity, fresh if ranges == 1 else None))
        parts.append(runs.filter("kind = 'placed'"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    # every range starts from the same gaps wherever it runs, so a repeated task gives equal rows
    return out.drop("kind")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): one row per piece.

    A document is its tokens and ``end_id``; null and empty texts are ``end_id`` alone. Only documents longer
    than ``capacity`` are cut. Repeated rows and rows without an id are documents of their own. An empty
    table gives no rows; other columns don't matter. Offsets of a sequence follow each other without gaps.
    """
    rows = written(pieces(docs, tokenizer, capacity, end_id, doc_id, text, keep_ids))
    counts = rows.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, 0))
    ranks = counts.select("length", "task", (before - F.col("n")).alias("before"))
    where = places(counts.groupBy("length").agg(F.sum("n").alias("n")), capacity)
    ranked = rows.join(ranks, ["length", "task"]).withColumn("rank", F.col("before") + F.col("place"))
    # at most a few runs per length up to the capacity, however many documents there are
    where = F.broadcast(where.withColumnsRenamed({"n": "count", "offset": "at"}))
    turn = F.col("rank") - F.col("first")
    found = ranked.join(where, (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("first")) & (turn < F.col("count")))
    return found.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("bin") + turn % F.col("bins")).alias("sequence_id"),
        (F.col("at") + F.floor(turn / F.col("bins")) * F.col("size")).cast("long").alias("offset"),
        *(["ids"] if keep_ids else []),
    )
