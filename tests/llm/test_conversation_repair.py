from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

from boardlens.llm import conversation_repair as cr
from boardlens.llm.common import table
from boardlens.llm.queries import QUERIES

ROOT = "/root/testdata/sf0.01"
COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """(cost, audit, repaired) by trying edits in order of cost and audit; rows: (role, text, fault)."""
    heap, done = [(0, "", 0, "", [])], set()
    while heap:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        due = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
        heapq.heappush(heap, (cost + 5, audit + "I", i, due[0], [*out, f"{due}:"]))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, out))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] and role[:1] in NEXT[last]:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], [*out, f"{role}:{text}"]))
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, due[0], [*out, f"{due}:{text}"]))


def plain(rows, damage=True):
    """{conv_id: values of COLUMNS} from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
        text = "" if kind == 1 else text.translate({ord(x): None for x in ".!?"}) if kind == 2 else text
        convs[c] += [(t, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for c, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        seen, marked = set(), []
        for _, role, text in own:
            end = text.rstrip(cr.BLANKS)
            fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, repaired = cheapest(marked)
        faults = [sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")]
        out[c] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def as_dict(df):
    got = df.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got}
    assert len(out) == len(got)
    return out


def test_given_conversations(spark):
    rows = [tuple(r) for r in table(spark, ROOT, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = as_dict(QUERIES["op12_conversation_repair"](spark, ROOT))
    assert got == plain(rows) and len({r[6] for r in got.values()}) > 10


def test_random_conversations(spark):
    """Every kind of fault, null, tie and strange role against the plain search."""
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["One.", "two!", "Three? \n", "cut", "cut,", "", " \t", None, "é.", ":x."]
    rows = [
        (c if c else None, rng.choice([None, *range(6)]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{rng.random()}.", "z", c)
        for c in range(300)
        for _ in range(rng.randint(1, 9))
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, fault string, conv int")
    plain_rows = [r[:4] for r in rows]
    assert as_dict(cr.report(df, cr.summaries(cr.repair(df)))) == plain(plain_rows, damage=False)
    assert as_dict(cr.report(df, cr.summaries(cr.repair(cr.damaged(df))))) == plain(plain_rows)


def test_long_conversation_over_many_batches(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"row {t}." if t % 97 else "same.") for t in range(30_000)] + [(2, 0, "user", "x" * 200_000 + "!")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert as_dict(cr.report(df, cr.summaries(cr.repair(df)))) == plain(rows, damage=False)


def test_repaired_rows_are_well_formed(spark):
    import re

    edits = cr.repair(cr.damaged(table(spark, ROOT, "conversations"))).collect()
    roles = defaultdict(str)
    for r in edits:
        roles[r.conv] += r.role[:1] if r.edit != "D" else ""
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in roles.values())


def test_empty_table_and_dropped_conversation(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert cr.report(empty, cr.summaries(cr.repair(empty))).count() == 0
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    gone = spark.createDataFrame([(1, turn, "user", "x.")], schema)
    assert as_dict(cr.report(gone, cr.summaries(cr.repair(cr.damaged(gone))))) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
