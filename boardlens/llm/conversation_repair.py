"""Repair of the structure of conversations by cheapest edits, streamed in sorted order.

A conversation is well formed if the initials of its roles read ``(s?(ua)+)?``: at most one opening system
row, then users and assistants in turn. Rows may be kept, given the role that is due, deleted, or an
empty row inserted; blank rows and repetitions must go. The cheapest edits follow from a dynamic programme over
four states (what came last), and among equally cheap ones the string of their initials that is least.

Rows are dealt out by conversation and sorted by turn, without their texts. The first stream runs from the last
row to the first and carries the costs to the end from each of the four states across Arrow batches. Its
backpointers are one byte a row, the best edit from each state, and go to a written table as they come, so a
conversation of any length needs four numbers of memory. The second stream meets them sorted forwards beside the
texts, follows the one path that starts at the beginning, and writes the edits out. A lost executor repeats its tasks only.
A conversation is one sorted run, since its hash is over its repaired rows in a row; nothing of it is held but
the current batch and, where edits are summed up, its audit (a byte a row).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardlens.llm.common import written

#: The edits in the order of their initials, what they cost, and what a truncated row adds if it stays.
EDITS = "DIKR"
DELETE, INSERT, RELABEL, TRUNCATED = 2, 5, 1, 5
#: Blanks of a text, as ASCII has them.
BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, system, user and assistant came last. Complete are the first and the last.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_DUE = ("user", "user", "assistant", "user")
_AFTER = (_USER, _USER, _ASSISTANT, _USER)
_END = (0, 2 * INSERT, INSERT, 0)
_KEEP = {"s": (_SYSTEM, None, None, None), "u": (_USER, _USER, None, _USER), "a": (None, None, _ASSISTANT, None)}
_NOWHERE = (None,) * 4
_LEGAL = {"su", "ua", "au"}


def step(after: list[int], initial: str, fault: str | None) -> tuple[list[int], int]:
    """Costs to the end from each state before a row, given those behind it, and the best edits as two bits a state."""
    best = []
    extra = TRUNCATED if fault == "truncated" else 0
    stays = fault not in ("blank", "duplicate")
    kept = _KEEP.get(initial, _NOWHERE) if stays else _NOWHERE
    for state in range(4):
        found = (DELETE + after[state], 0)
        if kept[state] is not None:
            found = min(found, (after[kept[state]] + extra, 2))
        if stays:
            found = min(found, (RELABEL + after[_AFTER[state]] + extra, 3))
        best.append(found)
    for _ in range(3):  # rows inserted before this one
        best = [min(b, (INSERT + best[_AFTER[s]][0], 1)) for s, b in enumerate(best)]
    return [cost for cost, _ in best], sum(code << 2 * s for s, (_, code) in enumerate(best))


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a conversation from the last to the first; adds the byte of best edits."""
    conv, after, any_ = None, [], False
    for batch in batches:
        out = []
        for c, initial, fault in zip(*(batch.column(n).to_pylist() for n in ("conv", "initial", "fault")), strict=True):
            if not any_ or c != conv:
                conv, after, any_ = c, list(_END), True
            after, code = step(after, initial, fault)
            out.append(code)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int16())], names=[*batch.schema.names, "best"])


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits of each conversation from rows in order, each behind its byte of best edits."""
    conv, state, any_, best, fault = None, _START, False, 0, None
    names = ["conv", "edit", "turn", "was", "fault", "role", "text"]
    kinds = None

    def closing() -> Iterator[tuple]:
        at = state
        while any_ and at not in (_START, _ASSISTANT):
            yield conv, "I", None, None, None, _DUE[at], ""
            at = _AFTER[at]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        texts = batch.column("text")
        kinds = [batch.column("conv").type, pa.string(), batch.column("turn").type, *[pa.string()] * 3, texts.type]
        out = []
        for i, (c, turn, role, code, f) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("conv", "turn", "role", "best", "fault")), strict=True)):
            if not any_ or c != conv:
                out += closing()
                conv, state, any_ = c, _START, True
            if code is not None:
                best, fault = code, f
                continue
            while (edit := EDITS[best >> 2 * state & 3]) == "I":
                out.append((c, "I", None, None, None, _DUE[state], ""))
                state = _AFTER[state]
            if edit == "D":
                out.append((c, "D", turn, role, fault, None, None))
                continue
            out.append((c, edit, turn, role, fault, role if edit == "K" else _DUE[state], texts[i].as_py()))
            state = _KEEP[role[:1]][state] if edit == "K" else _AFTER[state]
        if out:
            yield packed(out)
    if any_ and (last := list(closing())):
        yield packed(last)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its edits in order."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    conv, any_, kind = None, False, None
    n, audit, digest, first, last, turns, before, rows = {}, bytearray(), None, None, None, 0, None, 0

    def row() -> pa.RecordBatch:
        n["gaps"] = last - first + 1 - turns if turns else 0
        values = [pa.array([conv], kind), *[pa.array([n[c]], pa.int64()) for c in counts], pa.array([audit.decode()]), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(values, names=["conv", *counts, "audit", "repaired_sha256"])

    for batch in batches:
        kind, texts, done = batch.column("conv").type, batch.column("text"), []
        for i, (c, edit, turn, was, fault, role) in enumerate(zip(*(batch.column(x).to_pylist() for x in ("conv", "edit", "turn", "was", "fault", "role")), strict=True)):
            if not any_ or c != conv:
                if any_:
                    done.append(row())
                conv, any_, n, audit, digest = c, True, dict.fromkeys(counts, 0), bytearray(), hashlib.sha256()
                first, last, turns, before, rows = None, None, 0, None, 0
            audit += edit.encode()
            n["cost"] += {"D": DELETE, "I": INSERT, "K": 0, "R": RELABEL}[edit]
            if edit != "I":
                if turn is not None and turn != last:
                    first, last, turns = (turn if first is None else first), turn, turns + 1
                if fault:
                    n[fault] += 1
                    n["cost"] += TRUNCATED if fault == "truncated" and edit != "D" else 0
                n["illegal"] += before is not None and before + was[:1] not in _LEGAL
                before = was[:1]
            if edit != "D":
                digest.update(b"\n" * (rows > 0) + role.encode() + b":" + texts[i].as_py().encode())
                rows += 1
        yield from done
    if any_:
        yield row()


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The cheapest edits, sorted within partitions that hold whole conversations.

    conv, edit (K, R, D or I), turn, was (the role before), fault (blank, duplicate, truncated or null), and the
    repaired role and text, null where a row is deleted. Rows K, R and I in order are the repaired conversation.
    Rows come by turn, null turns first, and rows of one turn by role and the MD5 of role and text, so results don't
    depend on files. Null roles and texts count as one blank; null ids are one conversation. Role initials other than
    s, u and a can't be kept. An empty table gives none; other columns don't matter.
    """
    known = rows.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"), F.coalesce(text, F.lit(" ")).alias("text")
    )
    known = known.withColumn("digest", _digest(F.col("role"), F.col("text")))
    known = written(known.withColumn("row", F.monotonically_increasing_id()))
    seen = Window.partitionBy("conv", "digest").orderBy(F.asc_nulls_first("turn"), "row")
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = known.select("conv", "turn", "role", "digest", "row", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"), F.right(end, F.lit(1)).alias("last"))
    fault = (
        F.when(F.col("blank"), "blank").when(F.row_number().over(seen) > 1, "duplicate").when(~F.col("last").isin(*".!?"), "truncated")
    )
    light = light.withColumn("fault", fault).select("conv", "turn", "role", "digest", "row", "initial", "fault")
    backwards = light.repartition("conv").sortWithinPartitions("conv", F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest"), F.desc("row"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in backwards.schema.fields)
    best = written(backwards.mapInArrow(_choices, f"{kinds}, best smallint"))
    both = best.select("conv", "turn", "role", "digest", "row", "best", "fault", F.lit(None).cast("string").alias("text")).union(
        known.select("conv", "turn", "role", "digest", "row", F.lit(None).cast("smallint"), F.lit(None).cast("string"), "text")
    )
    forwards = both.repartition("conv").sortWithinPartitions(
        "conv", F.asc_nulls_first("turn"), "role", "digest", "row", F.asc_nulls_last("best")
    )
    conv, place = (rows.schema[c].dataType.simpleString() for c in (conv_id, turn))
    return forwards.mapInArrow(_follow, f"conv {conv}, edit string, turn {place}, was string, fault string, role string, text string")


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s rows: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Reads the partitions as ``repair`` left them, without another shuffle.
    """
    kind = edits.schema["conv"].dataType.simpleString()
    counts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return edits.mapInArrow(_summed, f"conv {kind}, {counts}, audit string, repaired_sha256 string")


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text with known damage: a twentieth each dropped, emptied, cut, repeated and relabelled."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn, role, text)]
    kind = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    out = rows.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(shown[2]).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(shown[3], ".!?", "")).otherwise(shown[3]).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return out.filter("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "time")


def report(rows: DataFrame, summed: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``summaries`` with a row for every conversation of ``rows``, also where none of its rows is left."""
    ids = rows.select(F.col(conv_id).alias("conv_id")).distinct()
    full = ids.join(summed, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return full.fillna(zeros).fillna({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})
