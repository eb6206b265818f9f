from __future__ import annotations

import numpy as np
import pytest

from boardlens.llm import fitting, ftrl, language_id, quality, toxicity
from boardlens.llm.common import held_out, table
from boardlens.llm.ngrams import Counter, Marker
from boardlens.llm.queries import QUERIES
from pyspark.sql import functions as F

ROOT = "/root/testdata/sf0.01"


def area(score, positive):
    order = np.asarray(score).argsort(kind="stable").argsort() + 1.0
    for v in np.unique(score):
        order[score == v] = order[score == v].mean()
    p = positive.sum()
    return (order[positive].sum() - p * (p + 1) / 2) / (p * (~positive).sum())


def scored(spark, name, label):
    rows = QUERIES[name](spark, ROOT)
    assert rows.count() == table(spark, ROOT, "documents").count()
    both = rows.join(table(spark, ROOT, "labels"), "doc_id").join(table(spark, ROOT, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert both["score"].between(0, 1).all()
    return both[both["held_out"]], both[both["held_out"]][label].to_numpy() == 1


def test_language_of_held_out_documents(spark):
    rows = QUERIES["op8_language_id"](spark, ROOT).join(table(spark, ROOT, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    out = rows[rows["held_out"]]
    assert (out["lang"] == out["lang_pred"]).mean() > 0.97 and out["score"].between(0, 1).all()


def test_letters_are_category_l():
    import unicodedata

    for c in map(chr, [*range(0x3000), *range(0x1D400, 0x1D800), 0xFF21, 0x20000]):
        assert language_id.has_letter(f"1 {c}!") == (unicodedata.category(c)[0] == "L")


def test_languages_against_a_plain_scorer(spark):
    """Every result equals one text's own score from the fitted weights."""
    docs = table(spark, ROOT, "documents").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(-1, "½²³Ⅷ", None), (-2, "a" * 70_000 + "b", None)], docs.schema)
    model = language_id.fit_languages(docs)
    texts = {r.doc_id: r.text for r in docs.union(extra).collect()}
    for r in language_id.identify(docs.union(extra), model).collect():
        low = (texts[r.doc_id] or "").lower()
        at, count = Counter(language_id.ORDERS, language_id.BITS)(low)
        x = (1 + np.log(count)) * model.idf[at]
        z = (x / np.linalg.norm(x)) @ model.weights[at] + model.weights[-1]
        p = np.exp((z - z.max()) / model.divisor) / np.exp((z - z.max()) / model.divisor).sum()
        want = (model.classes[p.argmax()], p.max()) if language_id.has_letter(low) else ("und", 0.0)
        assert r.lang_pred == want[0] and abs(r.score - want[1]) < 1e-5


def test_quality_of_held_out_documents(spark):
    out, good = scored(spark, "op9_quality_classifier", "quality")
    assert area(out["score"].to_numpy(), good) > 0.95
    assert ((out["score"] >= 0.7) == (out["predicted"] == 1)).all() and (out["predicted"] == good).mean() > 0.9


def test_toxicity_of_held_out_documents(spark):
    out, toxic = scored(spark, "op10_toxicity", "toxic")
    english = (out["lang"] == "en").to_numpy()  # the insults of this small table are English
    assert area(out["score"].to_numpy()[english], toxic[english]) > 0.9
    assert ((out["score"] >= 0.3) == (out["predicted"] == 1)).all()


def test_scores_against_a_plain_scorer(spark):
    """Every score equals that of one text alone, from its spans and a sum over all triples in plain Python."""
    docs = table(spark, ROOT, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, ROOT, "labels"))
    base = len(model.letters) + 1

    def value(s):
        out, norm = 0.0, 0.0
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    if all(toxicity._letter(c) for c in (s[i], s[j], s[k])):
                        weight = toxicity.DECAY ** (k - i + 1)
                        a, b, c = (model.letters.get(x, 0) for x in (s[i], s[j], s[k]))
                        out += weight * model.triples[(a * base + b) * base + c] if a and b and c else 0.0
                        norm += weight * weight
        return out / (norm**0.5 or 1.0) + model.bias

    rows = {r.doc_id: r.text for r in docs.filter("doc_id % 100 = 7 AND length(text) < 4000").collect()}
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert rows
    for i, t in rows.items():
        best = max(map(value, toxicity.spans(t, model.bridges)), default=model.bias)
        assert abs(got[i] - fitting.sigmoid(model.slope * best + model.shift)) < 1e-6


def test_disguised_insults_score_like_plain_ones(spark):
    """Signs and blanks between letters, cuts and inserted signs, on the table's own insults."""
    root = "/root/testdata/sf0.1"
    docs = table(spark, root, "documents").select("doc_id", "text")
    model = toxicity.fit_toxicity(docs, table(spark, root, "labels"))

    def score(t):
        return fitting.sigmoid(model.slope * model.decide(sorted(toxicity.spans(t, model.bridges))).max() + model.shift)

    for word in ("idiot", "trash", "pathetic", "disgusting"):
        half = len(word) // 2
        cut = word[:half], word[half:]
        for shown in (word, ".".join(word), "*".join(cut), " ".join(cut), " ".join(word), "  ".join(word), "\t".join(word), "---".join(word), word.upper()):
            assert score(f"The house and {shown} over there.") >= 0.3, shown
    assert score("The house and the hill over there.") < 0.3


def test_copies_of_a_text_are_no_evidence():
    toxic = [[f"w{i}", "idiot", f"x{i}", f"y{i}"] for i in range(12)]
    copied = [["same", "words", "strange", "thing", f"z{i % 2}"] for i in range(40)]
    clean = [[f"c{i}", f"d{i}", "plain"] for i in range(60)]
    bags = toxic + copied + clean
    assert toxicity.copies(copied).tolist() == [40] * 40 and toxicity.copies(clean).max() == 1
    marks, _, _ = toxicity._typical(bags, np.arange(len(bags)) < 52)
    assert marks[0] == "idiot"


def test_kernel_against_all_triples():
    """The kernel of two spans by enumerating their triples."""
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abc-"), rng.integers(1, 12))) for _ in range(40)]

    def features(s):
        out, norm = {}, 0.0
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + toxicity.SPAN)):
                    if all(c.isalnum() for c in (s[i], s[j], s[k])):
                        w = toxicity.DECAY ** (k - i + 1)
                        out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + w
                        norm += w * w
        return out, norm**0.5 or 1.0

    kernel = toxicity.Kernel(words[:10])(words)
    for a, s in enumerate(words):
        for b, t in enumerate(words[:10]):
            (x, m), (y, n) = features(s), features(t)
            assert np.isclose(kernel[a, b], sum(v * y.get(u, 0) for u, v in x.items()) / m / n)


def test_inserted_characters_are_tolerated():
    clean = ["the green house stands there", "morning light over water", "idle talk of old times"] * 8
    bad = [f"{c} you idiot" for c in clean]
    texts = clean + bad
    bags = [sorted(toxicity.spans(t)) for t in texts]
    model = toxicity.fit_bags(bags, np.arange(48) >= 24, np.ones(48), np.arange(48) % 5)

    def score(t):
        return fitting.sigmoid(model.slope * model.decide(sorted(toxicity.spans(t))).max() + model.shift)

    assert all(score(f"such an {x} here") > 0.5 for x in ("idiot", "IDIOT!", "i.d.i.o.t", "i d i o t", "id-iot", "idi*ot", "iidiot"))
    assert all(score(t) < 0.5 for t in ("the old house", "water over there"))


def test_table_of_triples_equals_landmarks():
    bags = [["\x02abcd\x03", "\x02xy\x03"], ["\x02abce\x03"], ["\x02zzzz\x03"], ["\x02yyyz\x03"]] * 5
    positive = np.array([True, True, False, False] * 5)
    model = toxicity.fit_bags(bags, positive, np.ones(20), np.zeros(20, int))
    assert model.decide(["\x02abcd\x03"])[0] > model.decide(["\x02zzzz\x03"])[0]


def test_dual_coordinate_descent_minimises_hinge_loss():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ [1, -2, 0, 0.5, 0] + rng.normal(size=60) > 0, 1.0, -1.0)
    rows = [(np.arange(5), v) for v in x]
    w = quality.dual_coordinate_descent(rows, y, np.full(60, 0.5), 5, epochs=2000, tolerance=1e-8)

    def loss(v):
        return v @ v / 2 + 0.5 * np.maximum(0, 1 - y * (x @ v[:-1] + v[-1])).sum()

    assert all(loss(w) <= loss(w + d) + 1e-6 for d in rng.normal(size=(500, 6)) * rng.choice([1e-3, 1e-1, 1], (500, 1)))


def test_ftrl_learns_and_l1_makes_zeros():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, 300)
    rows = [(np.array([c, 3 + rng.integers(0, 50)]), np.ones(2)) for c in labels]
    w = ftrl.fit(rows, labels, np.ones(300), 60, 3, l1=1.0)
    assert (ftrl.logits(rows, w).argmax(axis=1) == labels).mean() > 0.99 and (w == 0).mean() > 0.5


def test_temperature_and_platt_are_calibrated():
    rng = np.random.default_rng(3)
    logits = rng.normal(size=(4000, 3)) * 2
    labels = np.array([rng.choice(3, p=p) for p in ftrl.softmax(logits)])
    assert abs(ftrl.temperature(logits * 5, labels, np.ones(4000)) - 5) < 0.7
    score = rng.normal(size=8000)
    positive = rng.random(8000) < fitting.sigmoid(3 * score - 1)
    a, b = fitting.platt(score, positive, np.ones(8000))
    assert abs(a - 3) < 0.3 and abs(b + 1) < 0.2
    # only a tenth of the negatives drawn: weights bring the natural shares back
    drawn = positive | (rng.random(8000) < 0.1)
    a, b = fitting.platt(score[drawn], positive[drawn], np.where(positive, 1.0, 10.0)[drawn])
    assert abs(a - 3) < 0.5 and abs(b + 1) < 0.5


def test_ngrams_of_long_texts_come_in_pieces(monkeypatch):
    from boardlens.llm import ngrams

    text = "".join(chr(97 + i * i % 23) for i in range(5000)) + "é😀"
    want = Counter(range(1, 5), 12)(text), Marker(range(1, 5), 12)(text)
    monkeypatch.setattr(ngrams, "PIECE", 64)
    got = Counter(range(1, 5), 12)(text), Marker(range(1, 5), 12)(text)
    assert all((a == b).all() for a, b in zip(want[0], got[0])) and (want[1] == got[1]).all()
    assert want[0][1].sum() == sum(5002 - n + 1 for n in range(1, 5))


@pytest.mark.parametrize("labels", ["both", "one", "none"])
def test_edge_rows(spark, labels):
    rows = [(i, t, "en") for i, t in enumerate([None, "", " \n", "12 3!", "x", "x", "long text " * 40_000, "é\u0000😀"])] + [(None, "text", "de"), (4, "x", None)]
    docs = spark.createDataFrame([(*r, 0.5, True, "n") for r in rows], "doc_id long, text string, lang string, score double, held_out boolean, label string")
    known = {"both": [(i, i % 2, i % 2) for i in range(8)] + [(None, 1, 1), (3, None, None), (3, 1, 1)], "one": [(5, 1, 1)], "none": []}[labels]
    table_ = spark.createDataFrame([(*r, 7) for r in known], "doc_id long, quality int, toxic int, weight int")
    q = quality.score_quality(docs, quality.fit_quality(docs, table_))
    t = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table_))
    kept = toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, table_), 2.0)
    langs = docs if labels != "none" else docs.withColumn("lang", F.lit(None).cast("string"))
    i = language_id.identify(langs, language_id.fit_languages(langs))
    for out in (q, t, i):
        got = out.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert all(r.held_out == (r.doc_id in want) for r in got for want in [{x.doc_id for x in docs.filter(held_out(F.col("doc_id"))).collect()}])
    assert kept.columns == docs.columns and kept.count() == len(rows)
    by = {r.doc_id: r for r in i.collect()}
    assert all(by[k].lang_pred == "und" for k in (0, 1, 2, 3)) and (by[6].lang_pred == "und") == (labels == "none")
    empty = docs.limit(0)
    assert quality.score_quality(empty, quality.fit_quality(empty, table_.limit(0))).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.fit_toxicity(empty, table_)).count() == 0
    assert language_id.identify(empty, language_id.fit_languages(empty)).count() == 0
