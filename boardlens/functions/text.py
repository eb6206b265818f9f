"""Text predicates and parsers, all as built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords that mark a qualification as one of four degree levels.
UNDERGRAD = [
    "BS", "BA", "BSc", "BCom", "BA (magna cum laude)", "BFA (Bachelors of Fine Arts Program)",
    "BSE (summa cum laude)", "BASc", "BTech", "AB", "BBA", "BCom", "BA (Hons)", "BSEE",
    "BA (summa cum laude)", "BBA (Hons)", "Bachelor's Degree (Hons)", "BComm", "BS (cum laude)",
    "BCom (Hons)", "BAppSc (Bachelor of Applied Science)", "BBA (summa cum laude)",
    "Bachelor's Degree", "BE", "BSBA", "BSc (Hons)", "BSE", "AA", "Graduated", "Attended",
    "Studied", "Completed", "Degree",
]
POSTGRADUATE = [
    "MA", "MSc", "MEng", "MSEE", "MPhil", "MPA", "MS", "MSME", "MSc (Hons)", "MS (Hons)",
    "Post Graduate Diploma", "Graduate Diploma", "Diploma", "Certificate", "Certified",
    "Qualified", "Chartered", "Licensed", "Registered", "Certification",
    "Advanced Management Program", "Management Development Program", "Executive Course",
    "Strategic Leadership Program", "Leadership and Management Program",
    "General Management Program", "Higher Diploma",
]
MBA = [
    "MBA", "Executive MBA", "MBA (Distinction)", "MBA (High Distinction)",
    "MBA (summa cum laude)",
]
PHD = [
    "PhD", "Doctorate", "ScD", "JD", "JD (magna Cum Laude)", "JD (Cum Laude)", "JD (Hons)",
    "LLM", "LLB", "Doctor of Veterinary Medicine (DVM)",
]
# Fixed value: committee names that count as a diversity board.
DIVERSITY_PATTERN = "divers|incl|sustai"
# Ranking rows and scores that carry no number.
RANK_SENTINEL = "Reporter"
SCORE_SENTINELS = ["—", "-"]


def contains_ci(c: Column, word: str, null_as: bool | None = None) -> Column:
    """Case-insensitive substring test; null stays null unless ``null_as`` is given."""
    hit = F.lower(c).contains(word.lower())
    return hit if null_as is None else F.coalesce(hit, F.lit(null_as))


def matches_ci(c: Column, pattern: str) -> Column:
    """Case-insensitive regular-expression search; null stays null."""
    return c.rlike(f"(?i){pattern}")


def differs(c: Column, value) -> Column:
    """``c != value`` that keeps nulls."""
    return ~c.eqNullSafe(F.lit(value))


def yes_no(c: Column) -> Column:
    """'Yes' for 'Yes', 'No' for anything else, null included."""
    return F.when(c.eqNullSafe("Yes"), "Yes").otherwise("No")


def as_text(c: Column) -> Column:
    """Lower-case text; null becomes the empty string."""
    return F.lower(F.coalesce(c.cast("string"), F.lit("")))


def any_keyword(c: Column, words: list[str]) -> Column:
    """True when any word is a case-insensitive substring; null gives false.

    A word that contains another word of the list can never decide the answer, so only the
    minimal words are tested.
    """
    low = sorted({w.lower() for w in words}, key=len)
    minimal = [w for i, w in enumerate(low) if not any(s in w for s in low[:i])]
    text = as_text(c)
    return reduce(lambda a, b: a | b, [text.contains(w) for w in minimal])


def degree_flags(
    c: Column,
    undergrad: list[str] = UNDERGRAD,
    postgraduate: list[str] = POSTGRADUATE,
    mba: list[str] = MBA,
    phd: list[str] = PHD,
) -> dict[str, Column]:
    """Degree-level flags of a qualification, for ``withColumns``.

    The tests are substring tests, so 'MBA' also sets ``bachelors``; a postgraduate keyword
    counts only where no undergraduate keyword does.
    """
    first = any_keyword(c, undergrad)
    return {
        "bachelors": first,
        "masters": any_keyword(c, postgraduate) & ~first,
        "mba": any_keyword(c, mba),
        "phd": any_keyword(c, phd),
    }


def score_midpoint(c: Column) -> Column:
    """Number, or the midpoint of a 'low-high' range with any of three dashes."""
    parts = F.split(F.regexp_replace(c, "[—–-]", "-"), "-")
    low = F.get(parts, F.lit(0)).try_cast("double")
    high = F.get(parts, F.lit(1)).try_cast("double")
    return F.when(F.size(parts) > 1, (low + high) / 2).otherwise(c.try_cast("double"))


def normal_name(c: Column) -> Column:
    """Lower-case words in sorted order, everything but letters and digits dropped."""
    words = F.split(F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " ")), " ")
    return F.array_join(F.array_sort(words), " ")
