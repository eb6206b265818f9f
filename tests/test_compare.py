"""Statistics of repeated runs against published tables and recorded summaries."""

from __future__ import annotations

import math
import subprocess
import sys

import pytest

from boardlens.functions.stats import beta_inc, f_tail, t_tail, t_upper
from boardlens.operators import compare

# Mean and sample deviation of 100 recorded accuracies per network.
RECORDED = {
    "cnn_model_1": (0.2517730, 0.0232888),
    "cnn_model_2": (0.2051064, 0.0188972),
    "cnn_model_3": (0.2496099, 0.0244432),
    "cnn_model_4": (0.2559929, 0.0217588),
    "cnn_model_5": (0.2317730, 0.0224078),
}


def runs(spark, groups, n=100):
    """``n`` values per group with exactly the given mean and sample deviation."""
    rows = []
    for name, (mean, sd) in groups.items():
        half = sd * math.sqrt((n - 1) / n)
        rows += [(name, i, mean + (half if i % 2 else -half)) for i in range(n)]
    return spark.createDataFrame(rows, "model string, run int, accuracy double")


def summarise(spark, groups):
    return compare.against_baseline(compare.group_moments(runs(spark, groups)))


@pytest.mark.parametrize(
    "t, df, p",
    [(0.0, 5, 0.5), (2.015, 5, 0.05), (2.764, 10, 0.01), (1.660, 100, 0.05), (1.0, 1, 0.25)],
)
def test_t_table(t, df, p):
    assert t_tail(t, df) == pytest.approx(p, abs=5e-5)
    assert t_tail(-t, df) == pytest.approx(1 - p, abs=5e-5)


@pytest.mark.parametrize(
    "f, d1, d2, p", [(4.965, 1, 10, 0.05), (3.326, 5, 10, 0.05), (4.431, 4, 20, 0.01)]
)
def test_f_table(f, d1, d2, p):
    assert f_tail(f, d1, d2) == pytest.approx(p, abs=5e-5)


def test_tail_identities():
    for t, df in ((0.3, 4), (2.5, 30), (6.0, 99)):
        assert f_tail(t * t, 1, df) == pytest.approx(2 * t_tail(t, df), rel=1e-10)
    assert beta_inc(2.5, 4.0, 0.3) == pytest.approx(1 - beta_inc(4.0, 2.5, 0.7), rel=1e-12)
    assert t_tail(1.96, 1e6) == pytest.approx(0.0249979, abs=1e-5)


def test_against_baseline(spark):
    rows = {r["model"]: r for r in summarise(spark, RECORDED).collect()}
    want = {"cnn_model_1": 46.767, "cnn_model_2": 32.941, "cnn_model_3": 43.674,
            "cnn_model_4": 51.995, "cnn_model_5": 39.681}
    for name, t in want.items():
        assert rows[name]["n"] == 100
        assert rows[name]["t"] == pytest.approx(t, abs=2e-3)
    assert rows["cnn_model_1"]["p"] == pytest.approx(1.3e-69, rel=0.05)
    assert rows["cnn_model_4"]["p"] == pytest.approx(5.5e-74, rel=0.05)


def test_welch_and_anova(spark):
    moments = compare.group_moments(runs(spark, RECORDED))
    welch = compare.welch_top2(moments).first()
    assert (welch["best"], welch["second"]) == ("cnn_model_4", "cnn_model_1")
    assert welch["t"] == pytest.approx(1.3240075, abs=1e-4)
    assert welch["df"] == pytest.approx(197.0927, abs=1e-3)
    assert welch["p"] == pytest.approx(0.0935170, abs=1e-5)
    anova = compare.anova_f(moments).first()
    assert anova["f"] == pytest.approx(89.25065, abs=1e-3)
    assert (anova["df_between"], anova["df_within"]) == (4.0, 495.0)
    assert anova["p"] < 1e-15


def decide(spark, groups):
    row = compare.verdict(summarise(spark, groups)).first()
    return row["significant"], row["rule"], row["best"]


def test_verdicts(spark):
    assert decide(spark, RECORDED) == (5, "welch", "cnn_model_4")
    assert decide(spark, {"a": (0.25, 0.02)}) == (1, "only significant model", "a")
    assert decide(spark, {"a": (1 / 7, 0.02), "b": (0.143, 0.3)}) == (0, "none significant", None)
    close = {"a": (0.250, 0.02), "b": (0.249, 0.02), "c": (0.20, 0.02)}
    assert decide(spark, close) == (3, "anova", "a")
    assert decide(spark, {"a": (0.250, 0.02), "b": (0.249, 0.02)}) == (2, "no difference", None)


def test_worse_than_chance_counts_with_negative_t(spark):
    row = summarise(spark, {"low": (0.05, 0.02)}).first()
    assert row["t"] < 0 and row["p"] < 0.01


def test_no_spread_gives_null(spark):
    row = summarise(spark, {"flat": (0.3, 0.0)}).first()
    assert row["t"] is None and row["p"] is None
    assert decide(spark, {"flat": (0.3, 0.0)}) == (0, "none significant", None)


def test_report(spark):
    rows = {r["model"]: r for r in compare.report(runs(spark, RECORDED)).collect()}
    assert [m for m, r in rows.items() if r["chosen"]] == ["cnn_model_4"]
    assert all(r["significant"] and r["rule"] == "welch" for r in rows.values())


def test_tails_travel_without_the_package(tmp_path):
    from pyspark import cloudpickle

    path = tmp_path / "f.pkl"
    path.write_bytes(cloudpickle.dumps(t_upper.func))
    code = (
        "import pandas as pd, pickle, pyspark\n"
        f"f = pickle.load(open({str(path)!r}, 'rb'))\n"
        "print(round(f(pd.Series([1.0]), pd.Series([1.0]))[0], 6))\n"
    )
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert out.stdout.strip().endswith("0.25")
