"""Blocked best match against the full cross product."""

from __future__ import annotations

import random
import re

import pytest

from boardlens.operators import fuzzy
from boardlens.operators.fuzzy import best_match

NAMES = "name string"


def normal(s):
    return " ".join(sorted(re.sub(r"[^a-z0-9]+", " ", s.lower()).split()))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def brute(names, choices, cutoff):
    out = {}
    for name in set(names) - {None}:
        scored = []
        for choice in choices:
            a, b = normal(name), normal(choice)
            if a and b:
                longest = max(len(a), len(b))
                score = 100.0 * (longest - edits(a, b)) / longest
                if score >= cutoff:
                    scored.append((-score, choice))
        if scored:
            score, choice = min(scored)
            out[name] = (choice, -score)
    return out


def blocked(spark, names, choices, cutoff):
    left = spark.createDataFrame([(n,) for n in names], NAMES)
    right = spark.createDataFrame([(c,) for c in choices], "choice string")
    rows = best_match(left, "name", right, "choice", cutoff).collect()
    assert len({r["name"] for r in rows}) == len(rows)
    return {r["name"]: (r["match"], r["score"]) for r in rows}


def mutated(rng, word, alphabet, most):
    for _ in range(rng.randint(0, most)):
        at = rng.randint(0, len(word))
        kind = rng.choice("ids")
        new = rng.choice(alphabet)
        if kind == "i":
            word = word[:at] + new + word[at:]
        elif kind == "d":
            word = word[:at] + word[at + 1 :]
        else:
            word = word[:at] + new + word[at + 1 :]
    return word


@pytest.mark.parametrize("cutoff", [0, 1, 20, 30, 50, 51, 60, 80, 90, 100])
@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh "])
def test_equals_cross_product(spark, cutoff, alphabet):
    rng = random.Random(f"{cutoff}{alphabet}")
    choices = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 22))) for _ in range(60)]
    names = [mutated(rng, rng.choice(choices), alphabet, 7) for _ in range(200)]
    names += ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 22))) for _ in range(40)]
    names += [None, "", " - "]
    assert blocked(spark, names, choices, cutoff) == brute(names, choices, cutoff)


def test_hot_blocks_are_salted(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "HOT_BLOCK", 3)
    rng = random.Random(9)
    choices = [f"university of {''.join(rng.choice('abc') for _ in range(5))}" for _ in range(50)]
    names = [mutated(rng, rng.choice(choices), "abc ", 4) for _ in range(150)]
    assert blocked(spark, names, choices, 80) == brute(names, choices, 80)
    assert blocked(spark, names, choices, 10) == brute(names, choices, 10)


def test_names_like_no_choice(spark):
    names, choices = ["zzz", "ba", "q1", None, "--"], ["abc", "abd", "", None]
    wanted = {"zzz": ("abc", 0.0), "q1": ("abc", 0.0), "ba": ("abc", 100.0 / 3)}
    assert blocked(spark, names, choices, 0) == brute(names, ["abc", "abd"], 0) == wanted
    assert set(blocked(spark, names, choices, 1)) == {"ba"}
    assert blocked(spark, names, [""], 0) == {}


def test_cases(spark):
    choices = [
        "University of Oxford", "Harvard University", "Yale University", "Duke University",
        "Kale University",
    ]
    names = [
        "Harvard University", "Oxford, University of", "Harvrd University", "INSEAD", None,
        "Hale University",
    ]
    got = {n: m for n, (m, _) in blocked(spark, names, choices, 80).items()}
    assert got == {
        "Harvard University": "Harvard University",
        "Oxford, University of": "University of Oxford",
        "Harvrd University": "Harvard University",
        "Hale University": "Kale University",
    }


def test_carried_columns(spark):
    left = spark.createDataFrame([("Yale Univ",)], NAMES)
    right = spark.createDataFrame([("yale univ", 5.0), ("YALE UNIV", 7.0)], "u string, s double")
    row = best_match(left, "name", right, "u", carry=("s",)).first()
    assert (row["match"], row["score"], row["s"]) == ("YALE UNIV", 100.0, 7.0)


@pytest.mark.parametrize("cutoff", [-1, 101])
def test_cutoff_range(spark, cutoff):
    df = spark.createDataFrame([("a",)], NAMES)
    with pytest.raises(ValueError):
        best_match(df, "name", df, "name", cutoff)


def test_near_names_never_meet_short_segments(spark, monkeypatch):
    """Names one letter off are settled at a high cutoff; only names like no choice get to the lowest."""
    met, near = [], fuzzy._near

    def counted(names, name, offered, cutoff, score):
        met.append((cutoff, names.count()))
        return near(names, name, offered, cutoff, score)

    monkeypatch.setattr(fuzzy, "_near", counted)
    choices = [f"{i:04d}abcdefghijklmnop" for i in range(30)]
    names = [c + "x" for c in choices] + ["0000zzzzzzzzzzzz"]
    assert blocked(spark, names, choices, 60) == brute(names, choices, 60)
    assert met[0][1] == 31 and met[-1] == (60, 1)
