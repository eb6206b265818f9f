"""Secret scan with corpus-wide ownership frequency.

Fixed patterns give the base spans. Long random-looking strings are candidates too. The hashes of all
candidates are counted by distinct owners and repositories. How often values recur by chance is read off
the corpus itself: a value held by more owners or repositories than that makes likely is a widely copied
example, any other one that looks random is taken for live. Copies of a whole text count once. Live candidates outside the base spans are added as spans of kind ``owned``.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import map_rows, written

KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
NAMES = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
#: Shortest string that any pattern without blanks takes.
SHORTEST = 20
#: Bits a character that a random-looking string has at least.
BITS = 3.5

_FOUND = pa.list_(
    pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("hash", pa.binary()), ("random", pa.bool_())])
)
_FOUND_SQL = "array<struct<start:int,kind:int,end:int,hash:binary,random:boolean>>"


def random_looking(value: str) -> bool:
    """Letters and digits mixed, and at least BITS of entropy a character."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= BITS


def candidates(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) by start and kind; code points, end exclusive.

    A base pattern's matches don't overlap each other; a too short assigned value is dropped after it
    was matched. ``owned`` candidates don't overlap any base span.
    """
    if not text:
        return []
    found = []
    low = text.lower()
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if max(map(len, text.split()), default=0) >= SHORTEST:
        if "AKIA" in text:
            found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
        found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
        found.sort()
        reach, base = 0, iter([*found, (len(text) + 1, 0, len(text) + 1, "")])
        ahead = next(base)
        more = []
        for m in RANDOM.finditer(text):
            while ahead[0] < m.end() and ahead[0] <= len(text):
                reach = max(reach, ahead[2])
                ahead = next(base)
            if reach <= m.start() and random_looking(m[0]):
                more.append((m.start(), 3, m.end(), m[0]))
        found += more
    return sorted(found)


def scan(docs: DataFrame, doc_id: str, text: str, repo: str, owner: str) -> DataFrame:
    """doc_id, text_key, repo, owner and the candidates of each row, their values as hashes."""

    def start():
        def make(columns):
            found = []
            for t in columns["text"]:
                found.append(
                    [
                        {"start": s, "kind": k, "end": e, "hash": xxhash.xxh3_128_digest(v), "random": k != 0 or random_looking(v)}
                        for s, k, e, v in candidates(t)
                    ]
                )
            return (pa.array(found, _FOUND),)

        return make

    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.col(text)).alias("text_key"),
        F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.col(text).alias("text"),
    )
    return map_rows(rows, f"found {_FOUND_SQL}", start, ["doc_id", "text_key", "repo", "owner"])


def most_by_chance(values: int, single: int, alpha: float) -> int:
    """Holders that a value has by chance: more of them have a probability below ``alpha``.

    Holders beyond the first are taken as Poisson distributed. Their mean follows from the share of
    values with a single holder, which no widely copied value can move by more than one value.
    """
    mean = -math.log((single + 0.5) / (values + 1))
    term = math.exp(-mean)
    beyond, more = 1 - term, 0
    while beyond >= alpha:
        more += 1
        term *= mean / more
        beyond -= term
    return 1 + more


def secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    repo: str = "doc_id",
    owner: str = "source",
    alpha: float = 0.01,
) -> DataFrame:
    """One row per row: doc_id, text_key, and ``found``: (start, kind, end, live, copied, owners, repos) by start.

    kind is a place in KINDS. copied says that more owners or more repositories hold the value than
    ``most_by_chance`` allows at ``alpha``, live that it isn't copied and looks random; base spans stay
    either way, ``owned`` ones only if live. Rows of one text count as the first owner and repository that have it, so
    copies of a document don't make its secrets copied ones. Null and empty texts have none;
    a missing owner or repository counts as one unnamed; repeated rows give equal results; an empty table
    gives none; other columns don't matter.
    """
    rows = written(scan(docs, doc_id, text, repo, owner))
    each = rows.select("doc_id", "text_key", "repo", "owner", F.explode("found").alias("f")).select(
        "doc_id", "text_key", "repo", "owner", "f.*"
    )
    once = each.groupBy("hash", "text_key").agg(F.min(F.struct("owner", "repo")).alias("first"))
    held = once.groupBy("hash", "first.owner", "first.repo").agg(F.lit(1).alias("one"))
    by_owner = held.groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    freq = written(by_owner.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos")))
    values, one_owner, one_repo = freq.agg(F.count("*"), F.count_if(F.col("owners") == 1), F.count_if(F.col("repos") == 1)).first()
    judged = (
        each.join(freq, "hash")
        .withColumn(
            "copied",
            (F.col("owners") > most_by_chance(values, one_owner, alpha)) | (F.col("repos") > most_by_chance(values, one_repo, alpha)),
        )
        .withColumn("live", F.col("random") & ~F.col("copied"))
        .filter(F.col("live") | (F.col("kind") < KINDS.index("owned")))
        .groupBy("doc_id", "text_key")
        .agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end", "live", "copied", "owners", "repos"))).alias("judged"))
    )
    return (
        rows.select("doc_id", "text_key")
        .join(judged.withColumnsRenamed({"doc_id": "d", "text_key": "k"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
        .select("doc_id", "text_key", F.coalesce("judged", F.array().cast("array<struct<start:int,kind:int,end:int,live:boolean,copied:boolean,owners:bigint,repos:bigint>>")).alias("found"))
    )


def digest(found: DataFrame) -> DataFrame:
    """doc_id, counts and digests of the spans of ``secrets``."""
    name = lambda f: F.element_at(F.array(*map(F.lit, KINDS)), f.kind + 1)
    joined = lambda c: F.array_join(F.transform(c, lambda f: F.concat_ws(":", name(f), f.start, f.end)), ",")
    count = lambda k: F.size(F.filter("found", lambda f: f.kind == k)).cast("long")
    base = F.filter("found", lambda f: f.kind < KINDS.index("owned"))
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda f: f.live)).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda f: f.copied)).cast("long").alias("n_copied"),
    )


def redact(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced, live ones by ``<secret>`` and copied ones by ``<example>``."""
    spans = found.filter(F.size("found") > 0).dropDuplicates(["doc_id", "text_key"]).select(
        F.col("doc_id").alias("__d"), F.col("text_key").alias("__k"), F.col("found").alias("__f")
    )
    both = docs.join(
        spans, F.col(doc_id).eqNullSafe(F.col("__d")) & (F.xxhash64(F.col(text)) == F.col("__k")), "left"
    )

    def start():
        def make(columns):
            out = []
            for t, spans in zip(columns["text"], columns["spans"].to_pylist(), strict=True):
                at, parts = 0, []
                for f in spans or ():
                    if f["end"] > at:
                        parts += [t[at : f["start"]], ("<secret>" if f["live"] else "<example>") if f["start"] >= at else ""]
                        at = f["end"]
                out.append(t if not parts else "".join([*parts, t[at:]]))
            return (pa.array(out, pa.string()),)

        return make

    keep = [c for c in docs.columns if c != text]
    rows = both.select(*[F.col(c) for c in keep], F.col(text).alias("text"), F.col("__f").alias("spans"))
    return map_rows(rows, f"`{text}` string", start, keep).select(*docs.columns)
