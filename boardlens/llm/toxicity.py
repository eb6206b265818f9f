"""Toxicity by a gap-weighted subsequence kernel, Nystroem landmarks and a support vector machine.

A span is a token of a sentence, its letters and digits alone where signs stand between them, the letters of a run
of short pieces whatever blanks or signs are between ("x  y -- z"), or a window of a long one. Two neighbouring pieces
are one span too ("xy zw") where the letters around the cut stand in a toxic landmark or witness. Marks
at a span's ends count as characters. The kernel of two spans sums decay**length over all triples of characters that occur in both in order within
SPAN places, so inserted or left-out characters lower it only a little. It is normalised by the triples of
letters and digits, hence signs put between letters hardly count. A sentence scores as its best span and a
text as its best sentence.

Training is by multiple instances: the sentences of a labelled text share its label, and of a toxic text
only the few sentences that score best are taken to be toxic, which are chosen anew in each round. Landmarks are
the strings most typical of toxic texts, on evidence that copies of one text don't add to, and the most frequent clean spans. The fitted function is a
sum over triples, so scoring needs one table of triples, not the landmarks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import held_out, map_rows, written
from boardlens.llm.fitting import labelled_sample, part_of, platt, sigmoid

SPAN = 7
DECAY = 0.6
WINDOW, STRIDE = 24, 12
#: Characters that landmarks may use; rarer ones count as gaps.
ALPHABET = 120
PIECE = re.compile(r"[^\W_]+")
#: A run of RUN pieces or more, each of at most SHORT characters, is one span.
SHORT, RUN = 2, 3
#: Characters around the cut of two neighbouring pieces that decide whether they are one span.
BRIDGE = 4
#: Spans scored at once, spans remembered by a task, and characters of the texts taken together.
BATCH = 10_000
#: Rows of the matrix over landmarks that the driver works on at once.
BLOCK = 1000
MEMORY = 200_000
CHARACTERS = 1_000_000
#: Toxic and clean landmarks; toxic ones have one of LENGTHS and a kernel below APART with each other.
LANDMARKS = (96, 32)
LENGTHS = (4, 5, 6)
APART = 0.7
#: What a string's log odds times the texts that hold it must come to: four toxic texts among a thousand and no clean one; where
#: there are fewer toxic texts than that, one for each of them.
EVIDENCE = 12.0
#: Toxic texts whose witness a span must be for its strings to join pieces.
LEAST = 3
#: Sentences of a toxic text that are taken to be toxic: the best ones.
WITNESSES = 3
#: Marks of a token's ends, which count as letters: short tokens differ from the strings inside long ones.
EDGES = "\x02\x03"
_GAPS = [(i, j) for i in range(1, SPAN - 1) for j in range(i + 1, SPAN)]


def spans(text: str | None, bridges: frozenset[str] = frozenset()) -> set[str]:
    """Distinct spans of all sentences of a text; ``bridges`` are the strings across cuts that join two pieces."""
    if not text:
        return set()
    low = text.lower()
    tokens = set(low.split())
    letters = ("".join(PIECE.findall(t)) for t in tokens if not t.isalnum())
    found = {t for t in letters if t}
    pieces = PIECE.findall(low)
    found.update(_runs(pieces))
    if bridges:
        found.update(a + b for a, b in zip(pieces, pieces[1:]) if _across(a, b) in bridges)
    out = set()
    for t in tokens | found:
        t = EDGES[0] + t + EDGES[1]
        if len(t) > WINDOW:
            out.update(t[i : i + WINDOW] for i in range(0, len(t) - WINDOW + STRIDE, STRIDE))
        else:
            out.add(t)
    return out


def _runs(pieces: list[str]) -> Iterator[str]:
    """The joined pieces of each run of short ones."""
    run: list[str] = []
    for p in pieces:
        if len(p) <= SHORT:
            run.append(p)
        elif run:
            if len(run) >= RUN:
                yield "".join(run)
            run = []
    if len(run) >= RUN:
        yield "".join(run)


def _across(a: str, b: str) -> str:
    """BRIDGE characters around the cut, as even on both sides as the pieces allow."""
    left = min(len(a), max(BRIDGE // 2, BRIDGE - len(b)))
    return a[-left:] + b[: BRIDGE - left]


def _letter(c: str) -> bool:
    return c.isalnum() or c in EDGES


def _triples(batch: list[str], letters: dict[str, int]):
    """Yields (span numbers, triple codes, weight); code 0 stands for any triple with another character.

    Also returns, last, the norm of each span.
    """
    lengths = np.fromiter(map(len, batch), np.int64, len(batch))
    points = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), "<u4")
    owner = np.repeat(np.arange(len(batch)), lengths)
    kinds, which = np.unique(points, return_inverse=True)
    chars = [chr(k) for k in kinds]
    code = np.array([letters.get(c, 0) for c in chars] or [0], np.int64)[which]
    word = np.array([_letter(c) for c in chars] or [False])[which]
    base, norm, parts = len(letters) + 1, np.zeros(len(batch)), []
    for i, j in _GAPS:
        n = len(points) - j
        if n <= 0:
            continue
        inside = (owner[:n] == owner[j:]) & word[:n] & word[i : i + n] & word[j:]
        at = np.flatnonzero(inside)
        norm += np.bincount(owner[at], minlength=len(batch)) * DECAY ** (2 * (j + 1))
        a, b, c = code[at], code[at + i], code[at + j]
        known = (a > 0) & (b > 0) & (c > 0)
        parts.append((owner[at[known]], (a[known] * base + b[known]) * base + c[known], DECAY ** (j + 1)))
    return parts, np.sqrt(norm)


def _alphabet(texts: list[str]) -> dict[str, int]:
    common = Counter(c for t in texts for c in t if _letter(c)).most_common(ALPHABET)
    return {c: i + 1 for i, (c, _) in enumerate(sorted(common))}


class Kernel:
    """Normalised kernel of spans with fixed landmarks."""

    def __init__(self, landmarks: list[str]) -> None:
        self.letters = _alphabet(landmarks)
        parts, norm = _triples(landmarks, self.letters)
        owner = np.concatenate([p[0] for p in parts] or [np.empty(0, np.int64)])
        code = np.concatenate([p[1] for p in parts] or [np.empty(0, np.int64)])
        value = np.concatenate([np.full(len(p[0]), p[2]) for p in parts] or [np.empty(0)])
        self.codes, at = np.unique(code, return_inverse=True)
        self.values = np.zeros((len(self.codes) + 1, len(landmarks)))
        np.add.at(self.values, (at, owner), value / np.where(norm[owner] > 0, norm[owner], 1))

    def __call__(self, batch: list[str]) -> np.ndarray:
        """(spans, landmarks)"""
        out = np.zeros((len(batch), self.values.shape[1]))
        parts, norm = _triples(batch, self.letters)
        for owner, code, decay in parts:
            at = np.searchsorted(self.codes, code)
            hit = (at < len(self.codes)) & (self.codes[np.minimum(at, len(self.codes) - 1)] == code) if len(self.codes) else np.zeros(len(at), bool)
            owner, at = owner[hit], at[hit]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            if len(first):
                out[owner[first]] += np.add.reduceat(self.values[at] * decay, first, axis=0)
        return out / np.where(norm > 0, norm, 1)[:, None]


@dataclass
class ToxicityModel:
    letters: dict[str, int]
    #: Weight of each triple of known letters, by code.
    triples: np.ndarray
    bias: float
    slope: float
    shift: float
    bridges: frozenset[str] = frozenset()

    def decide(self, batch: list[str]) -> np.ndarray:
        out = np.zeros(len(batch))
        if len(self.triples):
            parts, norm = _triples(batch, self.letters)
            for owner, code, decay in parts:
                out += np.bincount(owner, self.triples[code] * decay, len(batch))
            out /= np.where(norm > 0, norm, 1)
        return out + self.bias


def _strings(bag: list[str]) -> set[str]:
    """Distinct parts of a text's spans that may become landmarks."""
    return {t[i : i + n] for t in bag for n in LENGTHS for i in range(len(t) - n + 1) if t[i : i + n].strip(EDGES).isalnum()}


def copies(bags: list[list[str]]) -> np.ndarray:
    """How many texts of the sample are copies of each, itself included: half of all their spans are shared.

    Compared are texts that agree in two neighbouring ones of eight least hashes.
    """
    turns = np.random.default_rng(5).integers(1, 1 << 31, 8) * 2 + 1
    root = list(range(len(bags)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    seen: dict[tuple, int] = {}
    for i, bag in enumerate(bags):
        marks = np.fromiter((zlib.crc32(s.encode("utf-8", "surrogatepass")) for s in bag), np.int64, len(bag))
        least = ((marks[:, None] * turns) % (1 << 32)).min(axis=0).tolist() if len(bag) else [0] * 8
        own = set(bag)
        for k in range(0, 8, 2):
            j = seen.setdefault((k, *least[k : k + 2]), i)
            if find(i) != find(j) and 2 * len(own.intersection(bags[j])) >= len(own.union(bags[j])):
                root[find(i)] = find(j)
    group = np.array([find(i) for i in range(len(bags))], int)
    return np.bincount(group, minlength=len(bags))[group] if len(bags) else np.zeros(0)


def _typical(bags: list[list[str]], positive: np.ndarray) -> tuple[list[str], np.ndarray, list[str]]:
    """Toxic landmarks that differ from each other, how typical each is, and frequent clean spans.

    A text counts as one over its copies of equal label, so what a copied text alone has is no evidence.
    """
    share = np.ones(len(bags))
    for own in (np.flatnonzero(positive), np.flatnonzero(~positive)):
        share[own] = 1 / copies([bags[i] for i in own])
    pos, neg, words = defaultdict(float), defaultdict(float), Counter()
    for bag, p, w in zip(bags, positive, share, strict=True):
        if p:
            for s in _strings(bag):
                pos[s] += w
        else:
            words.update(s for s in bag if len(s) >= 5)
    for bag, p, w in zip(bags, positive, share, strict=True):
        if not p:
            for s in _strings(bag):
                if s in pos:
                    neg[s] += w
    n_pos, n_neg = share[positive].sum(), share[~positive].sum()

    def typical(s: str) -> float:
        return pos[s] * float(np.log((pos[s] + 0.5) / (n_pos + 1)) - np.log((neg.get(s, 0.0) + 0.5) / (n_neg + 1)))

    worth = {s: w for s in pos if (w := typical(s)) > min(EVIDENCE, n_pos)}
    ranked = sorted(worth, key=lambda s: (-worth[s], -len(s), s))[: 40 * LANDMARKS[0]]
    place, toxic_bags = {s: i for i, s in enumerate(ranked)}, [b for b, p in zip(bags, positive, strict=True) if p]
    holds = np.zeros((len(ranked), len(toxic_bags)), np.float32)
    for d, bag in enumerate(toxic_bags):
        holds[[place[s] for s in _strings(bag) if s in place], d] = 1
    # texts that chosen landmarks cover count less and less, so that rare kinds get theirs
    odds = np.array([worth[s] / pos[s] for s in ranked])
    chosen, near, left = [], np.zeros(len(ranked)), share[positive].astype(np.float32)
    while ranked and len(chosen) < LANDMARKS[0] and (near < APART).any():
        i = int(np.where(near < APART, (holds @ left) * odds, -1).argmax())
        chosen.append(ranked[i])
        left[holds[i] > 0] *= 0.7
        near = np.maximum(near, Kernel([ranked[i]])(ranked)[:, 0])
        near[i] = 1
    clean = sorted(words, key=lambda s: (-words[s], s))[: LANDMARKS[1]]
    return chosen, np.array([worth[s] / pos[s] for s in chosen]), clean


def _hinge(
    z: np.ndarray, at: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 25
) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss over the rows ``at`` of ``z``, by Newton steps on its active rows.

    Rows are summed up block by block, so that no second matrix of all rows is held.
    """
    w, keep = np.zeros(z.shape[1] + 1), np.full(z.shape[1] + 1, ridge)
    keep[-1] = 1e-9
    for _ in range(rounds):
        curve, pull = np.diag(keep), np.zeros(len(w))
        for k in range(0, len(at), BLOCK):
            x = np.column_stack([z[at[k : k + BLOCK]], np.ones(len(at[k : k + BLOCK]))])
            yk, wk = y[k : k + BLOCK], weight[k : k + BLOCK]
            active = yk * (x @ w) < 1
            xa, wa = x[active], wk[active]
            curve += (xa * wa[:, None]).T @ xa
            pull += xa.T @ (wa * yk[active])
        new = np.linalg.solve(curve, pull)
        if np.abs(new - w).max() < 1e-7:
            break
        w = new
    return w[:-1], float(w[-1])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    max_rows: int = 2000,
    max_characters: int = 4_000_000,
    rounds: int = 4,
) -> ToxicityModel:
    """``max_rows`` and ``max_characters`` bound the labelled texts that are learned from, and so what the driver holds.

    Half of the rows come from each class. If their texts are longer together than ``max_characters``, fewer rows are taken, by a
    hash of the id, and of those the ones that fit.

    Without labels of both classes the score is the same for all texts.
    """
    chosen = labelled_sample(labels, label, max_rows).filter("label IN ('0', '1')")

    def start():
        return lambda columns: (pa.array([sorted(spans(t)) for t in columns["text"]], pa.list_(pa.string())),)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = written(rows.select("doc_id", "label", "weight", "text"))
    size = F.coalesce(F.length("text"), F.lit(0))
    part = min(1.0, max_characters / (rows.agg(F.sum(size)).first()[0] or 1))
    if part < 1:
        luck = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(1 << 20))
        rows = rows.filter((luck < int(part * (1 << 20))) & (size <= max_characters // 20))
    sample = map_rows(rows.select("doc_id", "label", "weight", "text"), "spans array<string>", start, ["doc_id", "label", "weight"]).collect()
    sample.sort(key=lambda r: (r.doc_id, r.label, r.spans))
    positive = np.array([r.label == "1" for r in sample], bool)
    return fit_bags([r.spans for r in sample], positive, np.array([r.weight for r in sample], float), part_of([r.doc_id for r in sample]), rounds)


def fit_bags(bags: list[list[str]], positive: np.ndarray, weight: np.ndarray, part: np.ndarray, rounds: int = 4) -> ToxicityModel:
    """The model of labelled texts given as their spans; texts of part 0 set the probabilities."""
    if len(set(positive)) < 2:
        return ToxicityModel({}, np.empty(0), 0.0, *platt(np.zeros(len(bags)), positive, weight))
    fits = part != 0
    if len(set(positive[fits])) < 2 or len(set(positive[~fits])) < 2:
        fits = np.ones(len(bags), bool)
    train = [i for i in np.flatnonzero(fits) if bags[i]]
    toxic, worth, clean_marks = _typical([bags[i] for i in train], positive[train])
    if not toxic:
        return ToxicityModel({}, np.empty(0), 0.0, *platt(np.zeros(len(bags)), positive, weight))
    kernel = Kernel(toxic + clean_marks)
    values, vectors = np.linalg.eigh(kernel(toxic + clean_marks))
    good = values > 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    names = sorted({s for i in train for s in bags[i]})
    place = {s: k for k, s in enumerate(names)}
    # the first witnesses are the spans nearest to the most typical landmarks
    z, score = np.empty((len(names), root.shape[1]), np.float32), np.empty(len(names))
    for k in range(0, len(names), BLOCK):
        close = kernel(names[k : k + BLOCK])
        z[k : k + BLOCK], score[k : k + BLOCK] = close @ root, (close[:, : len(toxic)] * worth).max(axis=1)
    inside = [np.array([place[s] for s in bags[i]]) for i in train]
    toxic_rows = [b for b, i in zip(inside, train, strict=True) if positive[i]]
    clean_rows = [b for b, i in zip(inside, train, strict=True) if not positive[i]]
    held = np.bincount(np.concatenate(clean_rows or [np.empty(0, int)]), minlength=len(names)) / max(1, len(clean_rows))
    clean = np.flatnonzero(held)
    # what clean texts hold half as often as toxic ones, or more, is no witness
    common = held >= 0.5 * np.bincount(np.concatenate(toxic_rows), minlength=len(names)) / len(toxic_rows)
    w, bias = np.zeros(z.shape[1]), 0.0
    for _ in range(rounds):
        able = np.where(common, -np.inf, score)
        best = np.concatenate([b[np.argsort(-able[b], kind="stable")[:WITNESSES]] for b in toxic_rows])
        witness, times = np.unique(best[np.isfinite(able[best])], return_counts=True)
        # beyond the hardest clean spans every so many stands for as many
        hard = clean[np.argsort(-score[clean], kind="stable")]
        stride = 1 + len(hard) // BATCH
        heavy = np.concatenate([np.ones(min(BATCH, len(hard))), np.full(len(hard[BATCH::stride]), stride)])
        hard = np.concatenate([hard[:BATCH], hard[BATCH::stride]])
        at = np.concatenate([witness, hard])
        y = np.concatenate([np.ones(len(witness)), -np.ones(len(hard))])
        w, bias = _hinge(z, at, y, np.concatenate([times / len(toxic_rows), held[hard] * heavy]))
        for k in range(0, len(names), BLOCK):
            score[k : k + BLOCK] = z[k : k + BLOCK] @ w + bias
    # the kernel's landmarks and the triples' table give the same function
    letters, base = kernel.letters, len(kernel.letters) + 1
    table = np.zeros(base**3, np.float32)
    table[kernel.codes] = (kernel.values[:-1] @ (root @ w)).astype(np.float32)
    typical = [names[k] for k in witness[(score[witness] > 0) & (times >= LEAST)].tolist()]
    bridges = frozenset(t[i : i + BRIDGE] for t in (x.strip(EDGES) for x in toxic + typical) for i in range(len(t) - BRIDGE + 1))
    model = ToxicityModel(letters, table, bias, 1.0, 0.0, bridges)
    rest = np.flatnonzero(~fits) if (~fits).any() else np.arange(len(bags))
    best = np.array([model.decide(bags[i]).max() if bags[i] else bias for i in rest])
    model.slope, model.shift = platt(best, positive[rest], weight[rest])
    return model


def _scorer(model: ToxicityModel, column: str):
    """Starts a task's function from texts to scores; distinct spans are decided once, many at a time."""

    def start():
        known: dict[str, float] = {}

        def scores(texts: list[str | None]) -> list[float]:
            own = [spans(t, model.bridges) for t in texts]
            new = [s for s in set().union(*own) if s not in known]
            if len(known) + len(new) > MEMORY:
                known.clear()
                new = list(set().union(*own))
            for k in range(0, len(new), BATCH):
                known.update(zip(new[k : k + BATCH], model.decide(new[k : k + BATCH]).tolist(), strict=True))
            return [max(map(known.__getitem__, x), default=model.bias) for x in own]

        def make(columns):
            best, part, size = [], [], 0
            for t in columns[column]:
                part.append(t)
                size += len(t or "")
                if size > CHARACTERS:
                    best += scores(part)
                    part, size = [], 0
            best += scores(part)
            return (pa.array(sigmoid(model.slope * np.array(best, float) + model.shift), pa.float64()),)

        return make

    return start


def score_toxicity(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out and score for each row, from its whole text only.

    Null, empty and blank texts get the score of the bias. Repeated rows give equal scores; an empty table
    gives none; other columns don't matter.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    return map_rows(rows, "score double", _scorer(model, "text"), ["doc_id", "held_out"])


def without_toxic(docs: DataFrame, model: ToxicityModel, limit: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, with all their columns."""
    return map_rows(docs, "__toxicity double", _scorer(model, text), docs.columns).filter(F.col("__toxicity") < limit).drop("__toxicity")
