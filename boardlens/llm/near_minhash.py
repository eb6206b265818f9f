"""Near-duplicate texts by a multi-index Hamming join of MinHash signatures.

A signature holds 64 MinHash values cut to 16 bits; two texts of similarity J differ in a value with
probability 1 - J. The 64 values are split into 16 chunks of 4. When two signatures differ in at most
31 values, the pigeonhole principle leaves a chunk with at most one difference, so the two agree on
at least one of the chunk's four choices of three values. Indexing every signature by its 64 such
choices therefore finds *every* pair within distance 31; at J = 0.75 a pair lies beyond that
distance with probability 1e-5, and less above. Pairs found are confirmed on full shingle sets.

Work is bounded without losing links: texts with equal sets are one class from the start, each
class is first compared with its nearest bucket leader, and only classes that are then still in
different components are compared within their buckets, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import map_rows, remove, sized, written
from boardlens.llm.components import components
from boardlens.llm.shingles import Shingler

VALUES = 64
CHUNK = 4
CHUNKS = VALUES // CHUNK
#: Pairs that differ in at most so many values are all found: one difference in each chunk, less one chunk.
DISTANCE = 2 * CHUNKS - 1
#: Rows of a bucket that one task compares with as many others.
BLOCK = 512
#: Pairs that are compared at once, and 64-bit words of their bitmaps.
PAIRS = 1 << 15
WORDS = 1 << 17
#: Rows that one task handles where the work on each is Python's: full sets, signatures, pairs of a bucket.
SETS, SIGNATURES, MEMBERS = 1_000, 20_000, 10_000
#: Rows of the index that one task handles.
KEYS = 100_000


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    flips = rng.integers(0, 2**32, VALUES, dtype=np.uint32)
    factors = rng.integers(0, 2**32, VALUES, dtype=np.uint32) | np.uint32(1)
    return flips, factors


def signature(shingles: np.ndarray) -> bytes:
    """64 MinHash values of 16 bits, little-endian, as bytes."""
    flips, factors = _constants_once()
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(high), 512):
        part = high[i : i + 512, None] ^ flips
        part *= factors
        np.minimum(least, part.min(axis=0), out=least)
    least *= np.uint32(0x85EBCA6B)
    return (least >> np.uint32(16)).astype("<u2").tobytes()


_KEPT: list = []


def _constants_once() -> tuple[np.ndarray, np.ndarray]:
    if not _KEPT:
        _KEPT.append(_constants())
    return _KEPT[0]


def scan(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """doc_id, n_shingles, set_a and set_b (128-bit hash of the set), signature; one row per row."""

    def start():
        shingle = Shingler(width)

        def make(columns):
            n, a, b, sig = [], [], [], []
            for t in columns["text"]:
                s = shingle(t)
                n.append(len(s))
                h = xxhash.xxh3_128_digest(s.tobytes())
                a.append(int.from_bytes(h[:8], "little", signed=True))
                b.append(int.from_bytes(h[8:], "little", signed=True))
                sig.append(signature(s) if len(s) else None)
            return pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sig, pa.binary())

        return make

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return map_rows(rows, "n_shingles long, set_a long, set_b long, signature binary", start, ["doc_id"])


def index(classes: DataFrame) -> DataFrame:
    """(key, id): the 64 keys of each signature, one for each chunk and each value left out of it."""

    def start():
        places = [[i for i in range(CHUNK) if i != out] for out in range(CHUNK)]

        def make(columns):
            ids = columns["id"].to_numpy(zero_copy_only=False)
            if not len(ids):
                return pa.array([], pa.int64()), pa.array([], pa.int64())
            sig = np.frombuffer(b"".join(columns["signature"]), "<u2").reshape(len(ids), CHUNKS, CHUNK).astype(np.int64)
            tag = np.arange(CHUNKS)[None, :] * CHUNK
            keys = np.stack(
                [((tag + out) << 48) | (sig[:, :, p[0]] << 32) | (sig[:, :, p[1]] << 16) | sig[:, :, p[2]] for out, p in enumerate(places)],
                axis=2,
            ).reshape(-1)
            return pa.array(keys, pa.int64()), pa.array(np.repeat(ids, VALUES), pa.int64())

        return make

    return map_rows(classes.select("id", "signature"), "key long, id long", start)


def hamming(pairs: DataFrame, signatures: DataFrame, rows: int) -> DataFrame:
    """``pairs`` (a, b) with the number of values that differ; only those within DISTANCE. No table has more than about ``rows`` rows."""
    both = pairs.join(signatures.select(F.col("id").alias("a"), F.col("signature").alias("sa")), "a").join(
        signatures.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b"
    )

    def start():
        def make(columns):
            sa, sb = (np.frombuffer(b"".join(columns[c]), "<u2").reshape(-1, VALUES) for c in ("sa", "sb"))
            return (pa.array((sa != sb).sum(axis=1), pa.int32()),)

        return make

    both = sized(both.select("a", "b", "sa", "sb"), rows, SIGNATURES)
    return map_rows(both, "distance int", start, ["a", "b"]).filter(F.col("distance") <= DISTANCE)


def bitmap(shingles: np.ndarray) -> bytes:
    """Which cells hold a shingle, of 2**k cells by the leading k bits; four to eight cells a shingle."""
    k = max(9, (4 * len(shingles) - 1).bit_length())
    held = np.zeros(1 << k, bool)
    held[(shingles >> np.uint64(64 - k)).astype(np.int64)] = True
    return np.packbits(held).tobytes()


def shingle_sets(docs: DataFrame, ids: DataFrame, doc_id: str, text: str, width: int, count: int) -> DataFrame:
    """(id, n, cells, shingles) of the named ones of ``count`` documents; shingles are sorted little-endian 64-bit numbers."""

    def start():
        shingle = Shingler(width)

        def make(columns):
            sets = [shingle(t) for t in columns["text"]]
            cells = pa.array([bitmap(s) for s in sets], pa.binary())
            return pa.array(map(len, sets), pa.int64()), cells, pa.array([s.tobytes() for s in sets], pa.binary())

        return make

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("binary").alias("text"))
    rows = sized(rows.join(ids, "id", "left_semi"), count, SETS)
    return map_rows(rows, "n long, cells binary, shingles binary", start, ["id"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int, rows: int) -> DataFrame:
    """Those of ``pairs`` whose sets hold 100 * intersection >= percent * union. No table has more than about ``rows`` rows."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b"
    )

    def start():
        def make(columns):
            ok = []
            for x, y in zip(columns["sa"], columns["sb"], strict=True):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                shared = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * shared >= percent * (len(x) + len(y) - shared) > 0)
            return (pa.array(ok, pa.bool_()),)

        return make

    both = sized(both.select("a", "b", "sa", "sb"), rows, SETS)
    return map_rows(both, "ok boolean", start, ["a", "b"]).filter("ok").select("a", "b")


def _folded(cells: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) with neighbouring cells merged down to ``size`` bytes."""
    bits = np.unpackbits(cells, axis=-1)
    bits = bits.reshape(*bits.shape[:-1], size * 8, -1).max(axis=-1)
    return np.packbits(bits, axis=-1)


def may_reach(n: np.ndarray, cells: pa.BinaryArray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of rows (a, b) may have a similarity of ``percent`` or more, by a bound on what two sets share.

    A cell that only one set fills holds at least one of its shingles that the other lacks, so the sets
    share at most n less such cells. Bitmaps of other sizes are folded to the smaller one first.
    """
    at = np.frombuffer(cells.buffers()[1], "<i4")[cells.offset : cells.offset + len(cells) + 1].astype(np.int64) // 8
    words = np.frombuffer(cells.buffers()[2], "<u8", at[-1])
    size = np.diff(at)
    ok = 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
    near = np.flatnonzero(ok)
    if not len(near):
        return ok
    sizes, kind = np.unique(np.stack([size[a[near]], size[b[near]]]), axis=1, return_inverse=True)
    for k, (sa, sb) in enumerate(sizes.T):
        mine = near[kind.ravel() == k]
        step = max(1, WORDS // int(max(sa, sb)))
        for some in (mine[i : i + step] for i in range(0, len(mine), step)):
            x, y = (words[at[r[some]][:, None] + np.arange(s)] for r, s in ((a, sa), (b, sb)))
            if sb < sa:
                x = _folded(x.view(np.uint8), int(sb) * 8).view(np.uint64)
            elif sa < sb:
                y = _folded(y.view(np.uint8), int(sa) * 8).view(np.uint64)
            na, nb = n[a[some]], n[b[some]]
            shared = np.minimum(
                na - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64),
                nb - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64),
            )
            ok[some] = 100 * shared >= percent * (na + nb - shared)
    return ok


def _pairs(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of the pairs to confirm within each (key, x, y), whose rows lie together."""
    key, x, y, ids, comp, block, n = (table[c].to_numpy() for c in ("key", "x", "y", "id", "component", "block", "n"))
    sig = np.frombuffer(b"".join(table["signature"].to_pylist()), "<u2").reshape(-1, VALUES)
    cells = table["cells"].combine_chunks()
    row = np.arange(len(key))
    end = np.append(_starts(key, x, y)[1:], len(key))
    others = end[np.searchsorted(end, row, "right")] - row - 1
    upto = np.append(0, others.cumsum())
    at = 0
    while at < len(key):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + PAIRS, "right")) - 1)
        a = np.repeat(row[at:to], others[at:to])
        b = a + 1 + np.arange(len(a)) - np.repeat(upto[at:to] - upto[at], others[at:to])
        at = to
        met = ((block[a] == x[a]) & (block[b] == y[a])) | ((block[a] == y[a]) & (block[b] == x[a]))
        met &= comp[a] != comp[b]
        a, b = a[met], b[met]
        same = sig[a] == sig[b]
        close = np.flatnonzero(same.sum(axis=1) >= VALUES - DISTANCE)
        close = close[_first_shared(same[close]) == key[a[close]] >> 48]
        a, b = a[close], b[close]
        kept = may_reach(n, cells, a, b, percent)
        a, b = ids[a[kept]], ids[b[kept]]
        yield np.minimum(a, b), np.maximum(a, b)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _first_shared(same: np.ndarray) -> np.ndarray:
    """Number (chunk * CHUNK + value left out) of the first key that two signatures share, from which of their values are the same."""
    same = same.reshape(len(same), CHUNKS, CHUNK)
    out = (same.sum(axis=2)[:, :, None] - same) == CHUNK - 1
    return out.reshape(len(same), VALUES).argmax(axis=1)


def open_pairs(buckets: DataFrame, labels: DataFrame, signatures: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) within DISTANCE that share a bucket but no component yet and may be similar enough.

    A bucket is cut into blocks, and each pair of blocks is one group, so a bucket of any size is
    spread over tasks. Groups lie one after another in a task, which compares those of a batch at once, so memory
    holds a batch and two blocks. Buckets inside one component are dropped first. A pair
    comes only from the first key that it shares, and only if the bound of its bitmaps allows a link.
    """
    member = buckets.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    entries = buckets.count()
    still = written(sized(
        member.groupBy("key")
        .agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
        .filter("lo < hi")
        .select("key", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")),
        entries,
    ))
    total = still.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    rows = member.join(still.drop("n"), "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.join(signatures.select("id", "signature"), "id").join(sets.select("id", "n", "cells"), "id")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("block", o).alias("x"), F.greatest("block", o).alias("y")),
    )
    rows = rows.select("key", "id", "component", "signature", "n", "cells", "block", F.explode(others).alias("pair"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if left is None else pa.concat_tables([left, rows]).combine_chunks()
            # the last group may go on in the next batch
            whole = int(_starts(*(rows[c].to_numpy() for c in ("key", "x", "y")))[-1]) if len(rows) else 0
            left = rows.slice(whole)
            yield from found(rows.slice(0, whole))
        if left is not None:
            yield from found(left)

    def found(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        for a, b in _pairs(rows, percent) if len(rows) else ():
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = rows.select("key", "pair.x", "pair.y", "id", "component", "block", "signature", "n", "cells")
    rows = sized(rows.repartition("key", "x", "y"), total, MEMBERS).sortWithinPartitions("key", "x", "y")
    pairs = written(sized(rows.mapInArrow(compare, "a long, b long").distinct(), total))
    remove(still)
    return pairs


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 75
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    component_id is the smallest id reachable over links, the row's own included; kept says that it
    is the row's own. Null, empty and blank texts have no shingles and no links. Rows that repeat
    an id are one document, linked where any of them is; rows without an id have no component and
    stay. Other columns of ``docs`` don't matter, whatever their names. An empty table gives none.
    """
    rows = written(scan(docs, doc_id, text, width))
    count = rows.count()
    usable = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["set_a", "set_b", "n_shingles"]
    classes = usable.groupBy(*same).agg(F.min("doc_id").alias("id"), F.min("signature").alias("signature"))
    classes = written(sized(classes, count))
    member = usable.join(classes.select(*same, "id"), same).select("doc_id", "id")
    leaders = classes.select("id", "signature")
    heads = leaders.count()
    keys = index(leaders)
    shared = keys.groupBy("key").agg(F.min("id").alias("lead"), F.max("id").alias("last")).filter("lead < last")
    buckets = written(sized(keys.join(shared.select("key", "lead"), "key"), VALUES * heads, KEYS))
    pairs = buckets.filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    stars = written(hamming(pairs, leaders, max(buckets.count(), heads)))
    nearest = stars.groupBy("b").agg(F.min(F.struct("distance", "a")).alias("best")).select("best.a", "b")
    sets = written(shingle_sets(docs, buckets.select("id").distinct(), doc_id, text, width, count))
    full = sets.count()
    links = written(confirm(nearest, sets, percent, full))
    labels = components(links)
    rest = open_pairs(buckets.select("key", "id"), labels, leaders, sets, percent)
    most = max(rest.count(), full)
    more = confirm(rest, sets, percent, most)
    # links found last tie components of the first together
    ends = [labels.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
    more = more.join(ends[0], "a", "left").join(ends[1], "b", "left")
    bridges = written(sized(more.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), most, SETS))
    wider = components(bridges).select(F.col("id").alias("first"), F.col("component").alias("wider"))
    # copies of a class follow its leader; ids that repeat with other texts tie classes together
    tied = (
        member.join(labels, "id", "left")
        .select("doc_id", F.coalesce("component", "id").alias("first"))
        .join(wider, "first", "left")
        .select("doc_id", F.coalesce("wider", "first").alias("component"))
        .distinct()
    )
    tied = written(sized(tied, count))
    own = tied.groupBy("doc_id").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    several = own.filter("lo < hi").select("doc_id", "lo").join(tied, "doc_id")
    repeated = written(sized(several.select(F.col("lo").alias("a"), F.col("component").alias("b")), count))
    final = components(repeated).select(F.col("id").alias("lo"), "component")
    own = own.select("doc_id", "lo").join(final, "lo", "left").select("doc_id", F.coalesce("component", "lo").alias("component"))
    out = sized(rows.select("doc_id", "n_shingles").join(own, "doc_id", "left"), count)
    remove(classes, buckets, stars, sets, links, rest, bridges, repeated)
    return out.select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
