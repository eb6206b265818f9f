"""Mixing of documents to target weights of domains, with soft membership.

A classifier fitted on a table of labelled documents gives each document a probability for each domain. A
document of n tokens and probabilities p taken at rate r brings n * r * p[d] expected tokens of domain d.
The rates minimise the squared distance of these totals from the targets by projected gradient steps that
keep every rate at or above a floor. The classifier reads each text once; its probabilities are written and all
steps and rates use them. A step needs the totals only: one aggregate over all documents. As it
moves a document's rate by its probabilities times what the totals lack, a rate follows from the
probabilities and the short list of all steps so far; no rates are kept between steps, and a lost
executor costs one aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.llm import ftrl
from boardlens.llm.common import map_rows, written
from boardlens.llm.fitting import labelled_sample, part_of
from boardlens.llm.ngrams import Marker

ORDERS = range(1, 5)
BITS = 16
PATIENCE = 12


@dataclass
class DomainModel:
    domains: list[str]
    weights: np.ndarray
    divisor: float

    def posterior(self, at: np.ndarray) -> np.ndarray:
        x = 1 / np.sqrt(max(1, len(at)))
        return ftrl.softmax((x * self.weights[at].sum(axis=0) + self.weights[-1]) / self.divisor)


def fit_domains(
    docs: DataFrame, labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", domain: str = "domain", max_rows: int = 3000
) -> DomainModel:
    """labelled: doc_id, domain. ``max_rows`` bounds the rows that the classifier is fitted on."""
    chosen = labelled_sample(labelled, domain, max_rows).filter("label <> ''")

    def start():
        marker = Marker(ORDERS, BITS)
        return lambda columns: (pa.array([marker(t or "").astype("<i4").tobytes() for t in columns["text"]], pa.binary()),)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    sample = map_rows(rows.select("doc_id", "label", "weight", "text"), "at binary", start, ["doc_id", "label", "weight"]).collect()
    sample.sort(key=lambda r: (r.doc_id, r.label, r["at"]))
    domains = sorted({r.label for r in sample})
    if len(domains) < 2:
        return DomainModel(domains or ["all"], np.zeros(((1 << BITS) + 1, max(1, len(domains)))), 1.0)
    features = []
    for r in sample:
        at = np.frombuffer(r["at"], "<i4")
        features.append((at, np.full(len(at), 1 / np.sqrt(max(1, len(at))))))
    y = np.array([domains.index(r.label) for r in sample])
    natural = np.array([r.weight for r in sample])
    fits = part_of([r.doc_id for r in sample]) != 0
    fits = fits if fits.any() and (~fits).any() else np.ones(len(y), bool)
    train = [features[i] for i in np.flatnonzero(fits)]
    w = ftrl.fit(train, y[fits], np.ones(len(train)), 1 << BITS, len(domains))
    # classes were drawn evenly; their natural shares come back through the bias
    share = np.bincount(y, natural, len(domains)) / natural.sum()
    even = np.bincount(y, minlength=len(domains)) / len(y)
    w[-1] += np.log(share / even)
    rest = [features[i] for i in np.flatnonzero(~fits)]
    divisor = ftrl.temperature(ftrl.logits(rest, w), y[~fits], natural[~fits]) if rest else 1.0
    return DomainModel(domains, w.astype(np.float32), divisor)


def memberships(docs: DataFrame, model: DomainModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, __tokens (words) and __p: the domains' probabilities."""

    def start():
        marker = Marker(ORDERS, BITS)

        def make(columns):
            tokens, p = [], []
            for t in columns[text]:
                tokens.append(len(t.split()) if t else 0)
                p.append(model.posterior(marker(t or "")).astype(float))
            return pa.array(tokens, pa.int64()), pa.array(p, pa.list_(pa.float64()))

        return make

    rows = docs.select(*dict.fromkeys([*keep, text]))
    return map_rows(rows, "__tokens long, __p array<double>", start, keep)


def rate(p: Column, steps: list[list[float]], floor: float) -> Column:
    """The rate after all steps, each projected to the floor, from 1."""
    if not steps:
        return F.lit(max(1.0, floor))
    moves = F.array(*[F.array(*map(F.lit, s)) for s in steps])

    def move(r: Column, step: Column) -> Column:
        gain = F.aggregate(F.zip_with(p, step, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
        return F.greatest(F.lit(float(floor)), r + gain)

    return F.aggregate(moves, F.lit(max(1.0, float(floor))), move)


@dataclass
class Mixture:
    """Steps to the rates, the totals they reach, and whether the targets are met.

    ``gradient`` is the projected gradient's length at the end over its length without the floor: near zero
    where targets are not met because the floor, or a domain without documents, keeps the totals away.
    """

    domains: list[str]
    steps: list[list[float]]
    floor: float
    targets: list[float]
    totals: list[float]
    met: bool
    gradient: float

    def rate(self) -> Column:
        """Rate of a row of ``memberships``."""
        return rate(F.col("__p"), self.steps, self.floor)


def fit_rates(
    members: DataFrame, domains: list[str], targets: dict[str, float], floor: float = 0.0, tolerance: float = 1e-3, max_steps: int = 500
) -> Mixture:
    """members: tokens, p. targets: expected tokens of each domain; a domain left out aims at none.

    Ends when every total is within ``tolerance`` of all targets' sum, or when steps along the projected gradient bring
    the totals hardly closer (a hundredth in PATIENCE steps); the result tells which. A domain that no document belongs to can't be met; its total stays 0. Without
    tokens there are no steps. ``max_steps`` only guards against an endless loop.
    """
    size = len(domains)
    aim = np.array([float(targets.get(d, 0.0)) for d in domains])
    cells = members.filter("tokens > 0").select("tokens", "p")
    item = lambda i: F.element_at("p", i + 1)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    steps: list[list[float]] = []

    def state(every: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Expected totals, and the second moments of the documents above the floor, or of all."""
        r = cells.withColumn("r", rate(F.col("p"), steps, floor))
        free = F.when(F.lit(every) | (F.col("r") > floor), F.col("tokens")).otherwise(0)
        got = r.agg(
            *[F.sum(F.col("tokens") * F.col("r") * item(i)) for i in range(size)], *[F.sum(free * item(i) * item(j)) for i, j in pairs]
        ).first()
        moments = np.zeros((size, size))
        for k, (i, j) in enumerate(pairs):
            moments[i, j] = moments[j, i] = got[size + k] or 0.0
        return np.array([float(x or 0) for x in got[:size]]), moments

    def gradient(lack: np.ndarray) -> float:
        pull = sum(item(i) * float(x) for i, x in enumerate(lack))
        free = (F.col("r") > floor) | (F.col("pull") > 0)
        square = F.col("tokens") * F.col("pull") ** 2
        got = cells.withColumn("r", rate(F.col("p"), steps, floor)).withColumn("pull", pull).agg(F.sum(F.when(free, square)), F.sum(square)).first()
        return float(np.sqrt((got[0] or 0.0) / got[1])) if got[1] else 0.0

    (now, moments), scale, stuck = state(every=True), 1.0, 0
    # domains without documents get a small moment, so that the inverse exists
    total = moments + (1e-6 * np.trace(moments) + 1e-12) * np.eye(size)
    lack = [np.linalg.norm(now - aim)]
    while np.abs(now - aim).max() > tolerance * aim.sum() and now.any() and len(steps) < max_steps and stuck < 8:
        if len(lack) > PATIENCE and lack[-1] > 0.99 * lack[-1 - PATIENCE]:
            break
        # the gradient in the metric of the free documents: steps of like length for rare and common domains
        metric = np.linalg.inv(moments + 1e-3 * total)
        steps.append((scale * metric @ (aim - now)).tolist())
        after, free = state()
        if np.linalg.norm(after - aim) >= np.linalg.norm(now - aim) * (1 - 1e-6):
            steps.pop()
            scale, stuck = scale / 4, stuck + 1
            moments = (moments + total) / 2
        else:
            now, moments, scale, stuck = after, free, min(1.0, scale * 2), 0
            lack.append(np.linalg.norm(now - aim))
    met = bool(np.abs(now - aim).max() <= tolerance * aim.sum())
    return Mixture(domains, steps, floor, aim.tolist(), now.tolist(), met, 0.0 if met else gradient(aim - now))


def repeats(rate_: Column, key: Column) -> Column:
    """Whole copies of a rate: its integer part, and one more with the probability of the rest, by a hash of ``key``."""
    u = F.pmod(F.xxhash64(key, F.lit(5)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate_) + (u < rate_ - F.floor(rate_)).cast("long")).cast("int")


def fit_mixture(
    docs: DataFrame, model: DomainModel, shares: dict[str, float], floor: float = 0.0, total: float | None = None, text: str = "text"
) -> Mixture:
    """Rates at which the domains' expected tokens have the given shares.

    ``docs`` are documents, or written rows of ``memberships``, which are then not computed again.
    Shares are made to add up to one over the domains there are; a domain that they leave out keeps its
    part of the tokens. ``total``: expected tokens aimed at; without it all tokens there are or, with a
    floor, as many more as let every share be met without going below it.
    """
    rows = docs if "__p" in docs.columns else written(memberships(docs, model, text, ()))
    members = rows.select(F.col("__tokens").alias("tokens"), F.col("__p").alias("p"))
    sums = [F.sum(F.col("tokens") * F.element_at("p", i + 1)) for i in range(len(model.domains))]
    got = members.agg(F.sum("tokens"), *sums).first()
    there = {d: float(got[i + 1] or 0) for i, d in enumerate(model.domains)}
    known = {d: s for d, s in shares.items() if d in there and there[d] > 0}
    every = float(got[0] or 0)
    rest = sum(n for d, n in there.items() if d not in known)
    scale = sum(known.values()) or 1.0
    part = {d: (1 - rest / every) * known[d] / scale if d in known else n / every for d, n in there.items()} if every else {}
    size = total if total is not None else max([every, *(floor * there[d] / s for d, s in part.items() if s)])
    return fit_rates(members, model.domains, {d: size * s for d, s in part.items()}, floor)


def mixed(docs: DataFrame, model: DomainModel, mixture: Mixture, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every row as often as its rate says: whole copies, and one more by chance for the rest.

    ``docs`` may be written rows of ``memberships`` with all columns of documents, which are then not computed again.
    The chance is a hash of the id (of the text, where there is none), so it is the same in every run. Null
    and empty texts have no tokens and the rate of their probabilities. An empty table stays empty.
    """
    given = "__p" in docs.columns
    columns = [c for c in docs.columns if not given or c not in ("__tokens", "__p")]
    members = (docs if given else memberships(docs, model, text, tuple(columns))).withColumn("__rate", mixture.rate())
    key = F.coalesce(F.col(doc_id).cast("string"), F.col(text), F.lit(""))
    return (
        members.withColumn("__copies", repeats(F.col("__rate"), key))
        .filter(F.col("__copies") > 0)
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
        .select(*columns)
    )
