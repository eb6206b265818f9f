"""Exact top-k inner products by MaxScore over shards.

Rows and queries are integer vectors; a dimension is a term, its non-zero values are its postings.
Within a shard the score of a row is bounded by the sum of the terms' bounds, a bound being the largest
product of the query's value with any value of the term. Terms whose bounds together stay below the
current k-th score are not essential: rows that only they could lift can't enter. The essential
postings are traversed, the others are probed, largest bound first, for rows that can still compete.
Signed values need no other rule: a bound may be negative, and rows without a posting count as zero.
Each pair of a shard and a block of queries is one task; their results are merged by rank.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boardlens.llm.common import remove, written

#: Rows of a shard and queries of a block: both fit a task, and few rows still make several tasks.
SHARD = (1024, 32768)
QUERIES = (256, 2048)
TASKS = 4
#: Terms probed between two checks of which rows still compete.
PROBE = 4


class Shard:
    """Rows by term: bounds and postings (as dense columns)."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.terms = np.ascontiguousarray(rows[order].T)
        self.high = self.terms.max(axis=1, initial=0)
        self.low = self.terms.min(axis=1, initial=0)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, larger scores and then smaller ids first."""
        bound = np.maximum(query * self.high, query * self.low)
        order = np.argsort(bound, kind="stable")
        seed = self._score(query, slice(0, 8 * k))
        seed = seed[self.ids[: 8 * k] != own]
        theta = np.partition(seed, len(seed) - k)[len(seed) - k] if len(seed) >= k else None
        below = np.cumsum(bound[order])
        # theta None: fewer than k rows so far, so every term is essential
        optional = 0 if theta is None else int(np.searchsorted(np.maximum.accumulate(below), theta))
        score = np.zeros(len(self.ids), self.terms.dtype)
        for t in order[optional:]:
            if query[t]:
                score += query[t] * self.terms[t]
        at = np.flatnonzero(self.ids != own)
        score = score[at]
        if optional and len(score) >= k:
            lead = np.argpartition(score, len(score) - k)[len(score) - k :]
            theta = max(theta, (query @ self.terms[:, at[lead]]).min())
        for end in range(optional, 0, -PROBE):
            probe = order[max(0, end - PROBE) : end]
            alive = score + below[end - 1] >= theta
            at, score = at[alive], score[alive]
            for t in probe:
                score = score + query[t] * self.terms[t][at]
        if len(score) > k:
            least = np.partition(score, len(score) - k)[len(score) - k]
            at, score = at[score >= least], score[score >= least]
        best = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[best]], score[best]

    def _score(self, query: np.ndarray, part: slice) -> np.ndarray:
        return query @ self.terms[:, part]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled up with zeros."""
    lists = column.combine_chunks()
    size = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(size), width), np.int64)
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _search(k: int):
    def search(group: pa.Table) -> pa.Table:
        width = int(np.max(np.asarray(pc.list_value_length(group["vector"]).to_numpy()), initial=0))
        ids, asks = group["id"].to_numpy(), group["asks"].to_numpy(zero_copy_only=False)
        numbers = _matrix(group["vector"], width)
        q, c = numbers[asks], numbers[~asks]
        most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(width, 1)
        if most >= 2.0**63:
            raise OverflowError("a score may not fit 64 bits")
        kind = np.float64 if most < 2.0**52 else np.int64  # floats hold such integers exactly
        shard = Shard(ids[~asks], c.astype(kind))
        out = [(own, *shard.search(query, own, k)) for own, query in zip(ids[asks], q.astype(kind), strict=True)] if len(c) else []
        take = lambda i: np.concatenate([np.asarray(x[i], np.int64) for x in out]) if out else np.empty(0, np.int64)
        owner = np.repeat([x[0] for x in out], [len(x[1]) for x in out]).astype(np.int64) if out else np.empty(0, np.int64)
        return pa.table({"query_id": owner, "vec_id": take(1), "score": take(2)})

    return search


def _block(count: int, limits: tuple[int, int]) -> int:
    size = min(max(math.ceil(count / TASKS), limits[0]), limits[1])
    return max(1, math.ceil(count / size))


def top_k(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each query but those with the query's own id.

    Both tables hold id long and vector array<long>, without nulls; missing dimensions count as zero.
    Ties go to the smaller id. Repeated rows compete one by one; of queries that share an id the smallest
    vector asks. Fewer rows than k: all of them. No rows or no queries: no result.
    """
    rows = written(rows.select("id", "vector"))
    asked = written(queries.groupBy("id").agg(F.min("vector").alias("vector")))
    shards, blocks = _block(rows.count(), SHARD), _block(asked.count(), QUERIES)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = rows.select("id", "vector", F.lit(False).alias("asks"), F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).cast("int").alias("shard"), every(blocks).alias("block")).union(
        asked.select("id", "vector", F.lit(True), every(shards), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        .toDF("id", "vector", "asks", "shard", "block")
    )
    found = written(dealt.groupBy("shard", "block").applyInArrow(_search(k), "query_id long, vec_id long, score long"))
    remove(rows, asked)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """(id, vector): floor(scale * x) of every component x; vectors and ids that can't take part go.

    Those are null ids and vectors that are null or hold null or non-finite components; an empty vector
    stays and scores zero.
    """
    numbers = F.col(vector).cast("array<double>")
    fit = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.filter(F.col(vec_id).isNotNull() & F.col(vector).isNotNull())
        .filter(F.coalesce(fit, F.lit(False)))
        .select(
            F.col(vec_id).cast("long").alias("id"),
            F.transform(numbers, lambda x: F.floor(x * scale).cast("long")).alias("vector"),
        )
    )
