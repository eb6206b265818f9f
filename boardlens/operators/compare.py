"""Statistics over repeated accuracies: one-sample t, Welch, ANOVA and the verdict.

Runs are reduced to (n, mean, variance) per model first; everything after works on those rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardlens.functions.stats import f_upper, t_upper
from boardlens.sources.tables import snapshot

# Chance level of seven classes and the significance level.
CHANCE = 1.0 / 7.0
ALPHA = 0.10


def group_moments(runs: DataFrame, model: str = "model", value: str = "accuracy") -> DataFrame:
    """(model, n, mean, sd) with the sample deviation."""
    return runs.groupBy(F.col(model).alias("model")).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
    )


def against_baseline(moments: DataFrame, baseline: float = CHANCE) -> DataFrame:
    """Adds standard error, signed t and the upper tail of ``|t|``; no spread gives null."""
    se = F.col("sd") / F.sqrt("n")
    return (
        moments.withColumn("se", se)
        .withColumn("t", F.try_divide(F.col("mean") - F.lit(baseline), F.col("se")))
        .withColumn("p", t_upper(F.abs("t"), (F.col("n") - 1).cast("double")))
    )


def significant(tested: DataFrame, alpha: float = ALPHA) -> DataFrame:
    return tested.where(F.col("p") < alpha)


def welch_top2(moments: DataFrame) -> DataFrame:
    """One row: the two highest means, Welch's t, its degrees of freedom and one-sided p."""
    top = moments.select("model", "n", "mean", "sd").orderBy(F.col("mean").desc(), "model").limit(2)
    pair = top.agg(
        F.sort_array(
            F.collect_list(
                F.struct((-F.col("mean")).alias("rank"), "model", "n", "mean", "sd")
            )
        ).alias("_pair")
    )
    a, b = F.get("_pair", F.lit(0)), F.get("_pair", F.lit(1))
    va, vb = a.sd * a.sd / a.n, b.sd * b.sd / b.n
    df = F.try_divide((va + vb) ** 2, va * va / (a.n - 1) + vb * vb / (b.n - 1))
    t = F.try_divide(a.mean - b.mean, F.sqrt(va + vb))
    return (
        pair.where(F.size("_pair") == 2)
        .select(a.model.alias("best"), b.model.alias("second"), t.alias("t"), df.alias("df"))
        .withColumn("p", t_upper("t", "df"))
    )


def anova_f(moments: DataFrame) -> DataFrame:
    """One row: F, its degrees of freedom and p, from group counts, means and deviations."""
    n, mean = F.col("n"), F.col("mean")
    sums = moments.agg(
        (F.sum(n * mean * mean) - F.sum(n * mean) * F.sum(n * mean) / F.sum(n)).alias("between"),
        F.sum((n - 1) * F.col("sd") * F.col("sd")).alias("within"),
        (F.count("*") - 1).cast("double").alias("df_between"),
        (F.sum(n) - F.count("*")).cast("double").alias("df_within"),
    )
    f = F.try_divide(
        F.try_divide("between", "df_between"), F.try_divide("within", "df_within")
    )
    return (
        sums.select(f.alias("f"), "df_between", "df_within")
        .withColumn("p", f_upper("f", "df_between", "df_within"))
    )


def verdict(tested: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One row: the chosen model (or null) and the rule that chose it.

    A single significant model wins; of several, the best wins if Welch's test against the
    second or else the ANOVA over all of them is significant.
    """
    sig = significant(tested, alpha).select("model", "n", "mean", "sd")
    found = sig.agg(
        F.count("*").alias("significant"), F.max_by("model", "mean").alias("only")
    )
    tests = found.withColumn(
        "welch", welch_top2(sig).select(F.struct("best", "p")).scalar()
    ).withColumn("anova_p", anova_f(sig).select("p").scalar())
    rule = (
        F.when(F.col("significant") == 0, "none significant")
        .when(F.col("significant") == 1, "only significant model")
        .when(F.col("welch.p") < alpha, "welch")
        .when(F.col("anova_p") < alpha, "anova")
        .otherwise("no difference")
    )
    best = F.when(F.col("significant") == 1, F.col("only")).when(
        F.col("rule").isin("welch", "anova"), F.col("welch.best")
    )
    return tests.withColumn("rule", rule).select(
        "significant",
        "rule",
        best.alias("best"),
        F.col("welch.p").alias("welch_p"),
        "anova_p",
    )


def report(runs: DataFrame, baseline: float = CHANCE, alpha: float = ALPHA) -> DataFrame:
    """Per-model rows with mean, p, significance and whether the verdict picked the model.

    The moments, a row per model, are stored first, so the runs are read once for all tests.
    """
    tested = against_baseline(snapshot(group_moments(runs)), baseline)
    chosen = verdict(tested, alpha).select(F.struct("best", "rule"))
    return (
        tested.withColumn("_v", chosen.scalar())
        .select(
            "model",
            "n",
            F.col("mean").alias("mean_accuracy"),
            "sd",
            "t",
            F.col("p").alias("p_value"),
            F.coalesce(F.col("p") < alpha, F.lit(False)).alias("significant"),
            F.col("model").eqNullSafe(F.col("_v.best")).alias("chosen"),
            F.col("_v.rule").alias("rule"),
        )
    )
