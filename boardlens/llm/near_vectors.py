"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

A unit vector u is stored as s * q with q of int8 and error e = |u - s q|. For two of them

    u . v  <=  s_u s_v (q_u . q_v)  +  e_u  +  |s_u q_u| e_v

so a pair whose right side is below the threshold can't be linked; only the others are computed again
in double precision from the full vectors. Rows of a label are cut into tiles and each pair of tiles is
one group, so a label of any size is spread over tasks. A task returns one row per vector (its number
of links and one link towards its component), never the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import remove, written
from boardlens.llm.components import components

#: Numbers in a tile; rows of a tile are this by the length of a vector.
TILE_NUMBERS = 1 << 18
#: Rows multiplied at once and pairs computed again at once: bounds on a task's memory.
STRIP = 256
RECHECK = 1 << 15
#: More than the rounding of the float32 sums above; dot products of int8 are exact there.
SLACK = 1e-5


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(unit vectors, int8 vectors, scale, error norm, norm of the int8 vectors' values)."""
    # vectors of extreme size are scaled first, so that no square overflows or vanishes
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    scale = np.abs(unit).max(axis=1, keepdims=True) / 127
    small = np.rint(unit / scale)
    value = small * scale
    error = np.sqrt(((unit - value) ** 2).sum(axis=1))
    return unit, small.astype(np.int8), scale[:, 0], error, np.sqrt((value * value).sum(axis=1))


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of int8 rows: floats hold every such sum below 2**24 or 2**53."""
    kind = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return a.astype(kind) @ b.astype(kind).T


def links_in(x: np.ndarray, y: np.ndarray, threshold: float, same: bool):
    """Arrays (i, j) of linked rows of two tiles, strip by strip; with ``same`` only i < j."""
    ux, qx, sx, ex, _ = quantise(x)
    uy, qy, sy, ey, ny = quantise(y)
    for at in range(0, len(x), STRIP):
        part = slice(at, at + STRIP)
        # |u . v - (s q) . (t r)| = |e_u . v + (s q) . e_v|, taken with the side that has the norms at hand
        bound = _products(qx[part], qy) * sx[part, None] * sy + ex[part, None] * ny + ey + SLACK
        i, j = np.nonzero(bound >= threshold)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), RECHECK):
            a, b = i[k : k + RECHECK], j[k : k + RECHECK]
            ok = np.einsum("nd,nd->n", ux[a], uy[b]) >= threshold
            yield a[ok], b[ok]


class Forest:
    """Smallest member of each group of numbers 0..n-1."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            target = np.arange(len(self.root))
            np.minimum.at(target, np.maximum(ra, rb), np.minimum(ra, rb))
            while (target[target] != target).any():
                target = target[target]
            self.root = target[self.root]


def _compare(threshold: float):
    def compare(group: pa.Table) -> pa.Table:
        tile = group["tile"].to_numpy()
        order = np.argsort(tile, kind="stable")
        ids, n = group["id"].to_numpy()[order], group["n"].to_numpy()[order]
        dims = group["dims"][0].as_py()
        flat = group["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(-1, dims)[order]
        cut = int((tile == tile.min()).sum())
        # the rows of the second tile follow those of the first; a tile may meet itself
        first, second = (vectors[:cut], vectors[cut:]) if cut < len(ids) else (vectors, vectors)
        own = cut == len(ids)
        if own and group["x"][0].as_py() != group["y"][0].as_py():
            return _result(ids[:0], n[:0], ids[:0])
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        for i, j in links_in(first, second, threshold, own):
            j = j if own else j + cut
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            forest.join(i, j)
        hit = links > 0
        return _result(ids[hit], links[hit], ids[forest.root[hit]])

    return compare


def _result(ids, links, root) -> pa.Table:
    return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "root": pa.array(root, pa.int64())})


def near_vectors(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept.

    Vectors are linked when their labels are equal and not null, their lengths are equal and their
    cosine in double precision is at least ``threshold`` (above 0). Vectors that are null, empty, zero or
    hold null or non-finite components, and rows without an id, have no links. Equal vectors of a label
    are one class with a count; rows that repeat an id count as vectors of their own. The component is
    the smallest id reachable; rows without an id have none and are kept. An empty table gives none.
    """
    base = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).withColumn("usable", F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    key = [F.xxhash64("label", "vector").alias("h"), F.xxhash64("vector", F.lit(1)).alias("g")]
    classes = written(
        base.filter("usable")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("id"), F.count("*").alias("n"))
        .select("id", "n", "label", "vector", F.size("vector").alias("dims"), *key)
    )
    tiles = classes.groupBy("label", "dims").agg(
        F.ceil(F.count("*") * F.col("dims") / F.lit(TILE_NUMBERS)).cast("int").alias("tiles")
    )
    others = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda o: F.struct(F.least("tile", o).alias("x"), F.greatest("tile", o).alias("y")),
    )
    dealt = (
        classes.join(tiles, ["label", "dims"])
        .withColumn("tile", F.pmod("h", "tiles").cast("int"))
        .select("id", "n", "label", "dims", "vector", "tile", F.explode(others).alias("pair"))
        .select("id", "n", "label", "dims", "vector", "tile", "pair.x", "pair.y")
    )
    found = written(dealt.groupBy("label", "dims", "x", "y").applyInArrow(_compare(threshold), "id long, links long, root long"))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    each = written(
        classes.select("id", "n", "h", "g")
        .join(links, "id", "left")
        .join(joined, "id", "left")
        .select(
            "h",
            "g",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    remove(found)
    alone = F.coalesce("component_id", "vec_id")
    return (
        base.select("vec_id", *[F.when(F.col("usable"), k).alias(name) for k, name in zip(key, "hg", strict=True)])
        .join(each, ["h", "g"], "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            alone.alias("component_id"),
            F.coalesce(alone == F.col("vec_id"), F.lit(True)).alias("kept"),
        )
    )
