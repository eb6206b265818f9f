"""Exact duplicates by two passes over a Bloom filter, in DataFrame operations only.

The first pass counts the filter's cells over the hashes of all texts and keeps the cells that two rows or
more fell into. A text that occurs twice finds all its cells kept; of texts that occur once only a few do
by chance. The second pass looks every row up: rows without all cells kept are alone and pass straight through,
and only the others are grouped by the whole digest of their text, so the filter decides what is shuffled,
never what is equal.

The filter is a table of blocks of 4 KB, and all cells of a text lie in one block: a row is looked up by one
broadcast join. It has 16 bits a row up to ``MAX_BITS``, which bounds the broadcast at 32 MB whatever
the input. Beyond 16 million rows it fills up, and more and more rows are grouped although they
are alone; each then shuffles its digest and id (some 50 bytes), not its text. Results don't change.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import remove, written

#: Bits of a block, as many as a built-in bitmap has.
BLOCK = 1 << 15
MAX_BITS = 1 << 28
BITS_A_ROW = 16
#: Groups that hold more than this part of all rows, or more than HOT_ROWS, are looked up by broadcast.
HOT_PART = 65_536
HOT_ROWS = 64


def digest_of(text: Column) -> Column:
    """SHA-256 of the text in UTF-8; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


@dataclass
class RepeatFilter:
    """Which digests may occur more than once."""

    blocks: int
    bits: DataFrame

    def block(self, digest: Column) -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.blocks))

    @staticmethod
    def cells(digest: Column) -> list[Column]:
        """Places of a digest in its block, from 0."""
        return [F.pmod(F.xxhash64(digest, F.lit(k)), F.lit(BLOCK)) for k in (1, 2)]

    def mark(self, rows: DataFrame, digest: str) -> DataFrame:
        """The rows with a column __maybe: false if the digest occurs once for certain."""
        place = self.block(F.col(digest))

        def kept(cell: Column) -> Column:
            byte = F.conv(F.hex(F.substring("__bits", F.floor(cell / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            return byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (cell % 8).cast("int") + 1)) > 0

        both = kept(self.cells(F.col(digest))[0]) & kept(self.cells(F.col(digest))[1])
        # at most MAX_BITS / BLOCK rows of 4 KB
        found = rows.join(F.broadcast(self.bits), place == F.col("__block"), "left")
        return found.withColumn("__maybe", F.coalesce(both, F.lit(False))).drop("__block", "__bits")


def repeat_filter(rows: DataFrame, digest: str, max_bits: int = MAX_BITS) -> RepeatFilter:
    """The first pass over rows with a column of digests."""
    want, blocks = rows.count() * BITS_A_ROW, 1
    while blocks * BLOCK < min(want, max_bits):
        blocks *= 2
    found = RepeatFilter(blocks, rows)
    place, cells = found.block(F.col(digest)), found.cells(F.col(digest))
    # both cells of a text may coincide; each counts a row once
    taken = rows.select(F.explode(F.array_distinct(F.array(*[place * BLOCK + c for c in cells]))).alias("cell"))
    twice = taken.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    bits = twice.groupBy(F.floor(F.col("cell") / BLOCK).alias("__block")).agg(
        F.bitmap_construct_agg(F.col("cell") % BLOCK).alias("__bits")
    )
    found.bits = written(bits)
    return found


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest (binary) of each row, from its whole text.

    Rows are a group if their texts are identical; the largest id stays. Null texts count as empty. A null id
    is below all others: rows without an id keep null as keep_id where no row of the group has one, and are
    then all marked as kept, as are the rows of a repeated id. An empty table gives none; other columns don't matter.
    """
    keyed = written(docs.select(F.col(doc_id).alias("doc_id"), digest_of(F.col(text)).alias("digest")))
    seen = repeat_filter(keyed, "digest", max_bits)
    marked = written(seen.mark(keyed, "digest"))
    remove(keyed, seen.bits)
    alone = marked.filter("NOT __maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "digest")
    again = marked.filter("__maybe").select("doc_id", "digest")
    groups = written(again.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    limit = max(HOT_ROWS, -(-marked.count() // HOT_PART))
    # more than limit rows each, hence at most HOT_PART groups
    hot = groups.filter(F.col("group_size") > limit).withColumn("__hot", F.lit(True))
    first = again.join(F.broadcast(hot), "digest", "left")
    rest = first.filter("__hot IS NULL").select("doc_id", "digest").join(groups.filter(F.col("group_size") <= limit), "digest")
    out = alone
    for part in (first.filter("__hot"), rest):
        out = out.unionByName(part.select(*out.columns))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each text, with all columns: that of the largest id.

    Rows that the filter lets through are not shuffled. Of rows of one id and text one stays, whichever; null ids
    come last. Columns of any type and name may come along, but for those starting with ``__``.
    """
    keyed = docs.withColumn("__digest", digest_of(F.col(text)))
    hashes = written(keyed.select("__digest"))
    seen = repeat_filter(hashes, "__digest", max_bits)
    remove(hashes)
    marked = seen.mark(keyed, "__digest")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    one = marked.filter("__maybe").groupBy("__digest").agg(F.max_by(F.struct(*columns), F.struct(doc_id)).alias("__row"))
    return marked.filter("NOT __maybe").select(*columns).unionByName(one.select("__row.*"))
