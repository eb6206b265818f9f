"""Best fuzzy match of names against a list of choices.

Similarity is ``100 * (1 - edits / longer length)`` on normalised names. For a pair of lengths
the cutoff allows a fixed number ``t`` of edits; if a choice is cut into ``t + 1`` segments, one
of them must reappear unchanged in any name within ``t`` edits, close to its old place (the
segment scheme of Li, Deng, Wang and Feng, "Pass-Join", PVLDB 2011). An equi-join on
(length, t, segment number, segment text) therefore finds every match without a cross join;
the edit distance is computed on those candidates only.

At cutoffs of 50 and below ``t`` may reach the length of a choice and no segment need survive. What is
left is a count: a pair at the cutoff shares at least ``cutoff`` per cent of the longer name's letters.
With letters in one global order, rarest first, such a pair shares a letter among the first few of both
(prefix filter of Chaudhuri, Ganti and Kaushik, "A Primitive Operator for Similarity Joins", ICDE 2006).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.functions.text import normal_name
from boardlens.operators.windows import first_per_key
from boardlens.sources.tables import snapshot

BLOCK = ["_len", "_t", "_i", "_seg"]
# Choices in a block beyond which its names are spread over several tasks.
HOT_BLOCK = 256
# Names are settled from high cutoffs to low ones: long segments select best, and few names get to the short ones.
RUNGS = (92, 86, 80, 70, 60, 51, 35, 20)


def _segment(length: Column, t: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of segment ``i`` of ``t + 1`` nearly equal segments."""
    base = F.floor(length / (t + 1)).cast("int")
    longer = length % (t + 1)
    short = t + 1 - longer
    start = i * base + F.greatest(F.lit(0), i - short)
    return start, base + F.when(i >= short, 1).otherwise(0)


def _edits(cutoff: int, length: Column) -> Column:
    """Edits allowed at ``cutoff`` when the longer name has ``length`` characters."""
    return F.floor(length * (100 - cutoff) / 100).cast("int")


def _choice_blocks(choices: DataFrame, cutoff: int) -> DataFrame:
    length = F.length("_choice")
    longest = F.floor(length * 100 / cutoff)
    start, size = _segment(F.col("_len"), F.col("_t"), F.col("_i"))
    return (
        choices.withColumn("_len", length)
        .withColumn("_t", F.explode(F.sequence(_edits(cutoff, length), _edits(cutoff, longest))))
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_t"))))
        .withColumn("_seg", F.substr("_choice", start + 1, size))
    )


def _name_blocks(names: DataFrame, kinds: DataFrame, cutoff: int) -> DataFrame:
    m = F.length("_name")
    lengths = F.sequence(
        F.ceil(m * cutoff / 100).cast("int"), F.floor(m * 100 / cutoff).cast("int")
    )
    t, i = F.col("_t"), F.col("_i")
    start, size = _segment(F.col("_len"), t, i)
    shift = m - F.col("_len")
    low = F.greatest(F.lit(0), start - i, start + shift - (t - i))
    high = F.least(m - size, start + i, start + shift + (t - i))
    return (
        names.withColumn("_len", F.explode(lengths))
        .withColumn("_t", _edits(cutoff, F.greatest(m, F.col("_len"))))
        .join(kinds, ["_len", "_t"], "left_semi")
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_t"))))
        .withColumns({"_low": low, "_high": high, "_size": size})
        .where("_low <= _high")
        .withColumn("_at", F.explode(F.sequence("_low", "_high")))
        .withColumn("_seg", F.substr("_name", F.col("_at") + 1, F.col("_size")))
        .drop("_low", "_high", "_size", "_at")
    )


def _candidates(names: DataFrame, choices: DataFrame, cutoff: int) -> DataFrame:
    """Pairs that share a segment.

    Names are only cut into segments of lengths and numbers that occur among the choices.
    """
    right = _choice_blocks(choices, cutoff)
    kinds = right.select("_len", "_t").distinct()
    return _salted(_name_blocks(names, kinds, cutoff), right, BLOCK)


def _salted(left: DataFrame, right: DataFrame, block: list[str]) -> DataFrame:
    """Names (left) and choices (right) that share a block.

    Common words make some blocks large. The names of such a block are salted, and its choices
    repeated for each salt, so that a task meets about ``HOT_BLOCK`` choices per name.
    """
    sizes = right.groupBy(*block).agg(F.ceil(F.count("*") / HOT_BLOCK).alias("_salts"))
    hot = sizes.where("_salts > 1")
    salts = F.coalesce("_salts", F.lit(1))
    salt = F.pmod(F.xxhash64("_name"), salts)
    every = F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))
    left = left.join(hot, block, "left").withColumn("_salt", salt).drop("_salts")
    right = right.join(hot, block, "left").withColumn("_salt", every).drop("_salts")
    return left.join(right, [*block, "_salt"])


def _letters(text: Column) -> Column:
    """Each letter with its number among equal ones, so that a bag of letters becomes a set."""
    letters = F.array_sort(F.split(text, ""))
    return F.transform(letters, lambda c, i: F.concat(c, (i - F.array_position(letters, c) + 1).cast("string")))


def _shared(length: Column, cutoff: int) -> Column:
    """Letters that a pair above 0 and at ``cutoff`` shares at least, by the longer name's length."""
    return F.greatest(F.lit(1), F.ceil(length * cutoff / 100)).cast("int")


def _by_letters(names: DataFrame, choices: DataFrame, cutoff: int) -> DataFrame:
    """Pairs that share enough letters, each once: at the first letter that both prefixes hold."""
    offered = choices.withColumn("_set", _letters(F.col("_choice")))
    seen = offered.select(F.explode("_set").alias("_seg")).groupBy("_seg").agg(F.count("*").alias("_n"))

    def prefixes(df: DataFrame, text: str, side: str) -> DataFrame:
        ranked = (
            df.withColumn("_seg", F.explode(_letters(F.col(text))))
            .join(seen, "_seg", "left")
            .groupBy(*df.columns)
            .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_seg"))).alias("_rank"))
        )
        first = F.slice("_rank._seg", 1, F.length(text) - _shared(F.length(text), cutoff) + 1)
        return ranked.select(
            *df.columns, F.col("_rank._seg").alias(f"_set{side}"), first.alias(f"_first{side}"), F.explode(first).alias("_seg")
        )

    longest = F.greatest(F.length("_name"), F.length("_choice"))
    pairs = _salted(prefixes(names, "_name", "_l"), prefixes(choices, "_choice", "_r"), ["_seg"])
    return (
        pairs.where(F.least(F.length("_name"), F.length("_choice")) >= _shared(longest, cutoff))
        .where(F.get(F.array_intersect("_first_l", "_first_r"), F.lit(0)) == F.col("_seg"))
        .where(F.size(F.array_intersect("_set_l", "_set_r")) >= _shared(longest, cutoff))
        .withColumn("_t", F.least(_edits(cutoff, longest), longest - 1))
        .drop("_set_l", "_set_r", "_first_l", "_first_r")
    )


def _near(names: DataFrame, name: str, offered: DataFrame, cutoff: int, score: str) -> DataFrame:
    """(name, _match, score): the best choice at ``cutoff`` and above 0 of each name that has one."""
    longest = F.greatest(F.length("_name"), F.length("_choice"))
    near = (
        (_candidates if cutoff > 50 else _by_letters)(names, offered, cutoff)
        .withColumn("_edits", F.call_function("levenshtein", "_name", "_choice", "_t"))
        .where("_edits >= 0")
        .withColumn(score, F.lit(100.0) * (longest - F.col("_edits")) / longest)
    )
    return first_per_key(near, [name], [F.col(score).desc(), "_match"]).select(name, "_match", score)


def best_match(
    names: DataFrame,
    name: str,
    choices: DataFrame,
    choice: str,
    cutoff: int = 80,
    match: str = "match",
    score: str = "score",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(name, match, score, carried columns of the choice) for each distinct name with a match.

    A match needs a score of at least ``cutoff``; the best score wins, then the alphabetically
    first choice. Null and blank names match nothing. Names equal to a choice after normalising
    are settled by an equi-join, only the others are cut into segments. The cutoff is reached in steps,
    each for the names that found nothing before, as no choice below a step's cutoff beats one above it;
    at 0 a name like no choice takes the first of all choices.
    """
    if not 0 <= cutoff <= 100:
        raise ValueError("cutoff must lie between 0 and 100")
    wanted = (
        names.select(name)
        .distinct()
        .withColumn("_name", normal_name(F.col(name)))
        .where(F.length("_name") > 0)
    )
    offered = (
        choices.select(F.struct(choice, *carry).alias("_match"), choice)
        .withColumn("_choice", normal_name(F.col(choice)))
        .where(F.length("_choice") > 0)
        .groupBy("_choice")
        .agg(F.min("_match").alias("_match"))
    )
    offered = snapshot(offered)
    equal = snapshot(wanted.join(offered, F.col("_name") == F.col("_choice"), "left"))
    exact = equal.where(F.col("_choice").isNotNull())
    rest = equal.where(F.col("_choice").isNull()).select(name, "_name")
    found = exact.select(name, "_match", F.lit(100.0).alias(score))
    for rung in (r for r in RUNGS if r > cutoff):
        if rest.isEmpty():
            break
        near = snapshot(_near(rest, name, offered, rung, score))
        found, rest = found.unionByName(near), snapshot(rest.join(near, name, "left_anti"))
    near = _near(rest, name, offered, cutoff, score)
    if cutoff == 0:
        near = snapshot(near)
        least = offered.agg(F.min("_match").alias("_match")).where("_match IS NOT NULL")
        unlike = rest.join(near, name, "left_anti").select(name, F.lit(0.0).alias(score))
        found = found.unionByName(unlike.join(F.broadcast(least)))
    found = found.unionByName(near)
    return found.select(
        name,
        F.col(f"_match.{choice}").alias(match),
        score,
        *[F.col(f"_match.{c}").alias(c) for c in carry],
    )
