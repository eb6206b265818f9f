"""Small frames with the expected rows spelled out."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from boardlens.functions import text
from boardlens.functions.bins import CHANGE_LABELS, bin_number, label_bins
from boardlens.functions.dates import date_or, lenient_date, strict_date, tenure_years
from boardlens.operators import aggregates, features, joins, rows
from boardlens.plans import governance as gov


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["x"] for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_role_filter(spark):
    values = ["CEO", "Regional CEO", "Division CEO", "ceo/Founder", "Co-CEO", None]
    assert column(spark, values, gov.is_ceo) == [True, False, False, True, True, None]
    founder = column(spark, values, lambda c: text.contains_ci(c, "founder", null_as=False))
    assert founder == [False, False, False, True, False, False]


def test_ranking_cleanup(spark):
    table = [
        ("Reporter", "a", "50"), (None, "b", "71.3"), ("1", "c", "—"), ("2", "d", "-"),
        ("3", "e", "50—60"), ("4", "f", "50-60"), ("5", "g", "50–60"), ("6", "h", None),
    ]
    df = spark.createDataFrame(table, "rank string, name string, scores_overall string")
    assert as_set(gov.clean_scores(df), "name", "scores_overall") == {
        ("b", 71.3), ("e", 55.0), ("f", 55.0), ("g", 55.0), ("h", None),
    }
    means = as_set(gov.universities(df), "name", "uniscoreavg")
    assert ("h", None) in means and ("e", 55.0) in means


def test_degree_flags(spark):
    values = ["MBA", "BSc (Hons)", "MSc", "Diploma", "PhD", "Master's Degree", None]
    df = spark.createDataFrame([(v,) for v in values], "q string")
    flags = df.select(*[c.alias(n) for n, c in text.degree_flags(F.col("q")).items()])
    names = ["bachelors", "masters", "mba", "phd"]
    got = [{n for n in names if r[n]} for r in flags.collect()]
    assert got == [
        {"bachelors", "mba"}, {"bachelors"}, {"masters"}, {"masters"}, {"phd"}, {"bachelors"},
        set(),
    ]


def test_minimal_keywords_equal_all_keywords(spark):
    values = ["bfa", "BA (Hons)", "xbax", "Executive Course", "none", "Qualified", "", None]
    for words in (text.UNDERGRAD, text.POSTGRADUATE, text.MBA, text.PHD):
        got = column(spark, values, lambda c: text.any_keyword(c, words))
        assert got == [any(w.lower() in (v or "").lower() for w in words) for v in values]


def test_dates(spark):
    as_of = dt.date(2024, 5, 1)
    got = column(spark, ["2020-02-29", "N", None], lambda c: date_or(c, as_of))
    assert got == [dt.date(2020, 2, 29), as_of, as_of]
    assert column(spark, ["2020-02-29", "N", None], lenient_date)[1:] == [None, None]
    with pytest.raises(Exception):
        column(spark, ["N"], strict_date)
    years = column(spark, ["2019-12-31"], lambda c: tenure_years(c, F.lit("2020-01-01")))
    assert years == [1]


def test_yes_no_and_kept_nulls(spark):
    values = ["Yes", "No", "yes", None]
    assert column(spark, values, text.yes_no) == ["Yes", "No", "No", "No"]
    assert column(spark, values, lambda c: text.differs(c, "No")) == [True, False, True, True]


def test_right_closed_bins(spark):
    values = [-0.2, -0.10, -0.03, 0.0, 0.01, 0.02, 0.10, 0.2, None, float("nan")]
    want = [0, 0, 1, 2, 3, 4, 5, 6]
    got = column(spark, values, label_bins, "double")
    assert got == [CHANGE_LABELS[i] for i in want] + [None, None]
    order = column(spark, got[:8], lambda c: bin_number(c))
    assert order == want


def test_bins_cover_the_line(spark):
    values = [x / 1000.0 for x in range(-300, 301, 7)]
    got = column(spark, values, lambda c: bin_number(label_bins(c)), "double")
    assert None not in got and got == sorted(got) and set(got) == set(range(7))


def test_null_safe_left(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "k string, y int")
    out = joins.null_safe_left(left, right, ["k"])
    assert out.columns == ["k", "x", "y"]
    assert as_set(out, "k", "x", "y") == {("a", 1, 10), (None, 2, 20), ("b", 3, None)}


def test_suffixes(spark):
    left = spark.createDataFrame([("a", 1)], "k string, n int")
    right = spark.createDataFrame([("a", 2), ("b", 3)], "k string, n int")
    out = joins.inner_on(left, right, "k")
    assert out.columns == ["k", "n_x", "n_y"] and [tuple(r) for r in out.collect()] == [("a", 1, 2)]


def test_match_flag(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    out = joins.flag_matching(left, right, ["k"], "hit")
    assert as_set(out, "k", "hit") == {("a", True), ("b", False), (None, True)}


def test_earlier_role(spark):
    table = [
        ("before", "CEO", 2010), ("before", "CFO", 2005),
        ("same", "CEO", 2010), ("same", "CFO", 2010),
        ("after", "CEO", 2010), ("after", "CFO", 2015),
        ("only", "CEO", 2010), ("only", "Co-CEO", 2005),
        ("undated", "CEO", None), ("undated", "CFO", 2005),
        ("untitled", "CEO", 2010), ("untitled", None, 2005),
    ]
    df = spark.createDataFrame(table, "k string, role string, start int")
    out = joins.preceded_by_other(
        df, ["k"], "role", text.contains_ci(F.col("role"), "CEO"), F.col("start")
    )
    assert as_set(out, "k", "role") == {("before", "CEO"), ("same", "CEO")}


def test_overwrite_and_keyed_union(spark):
    df = spark.createDataFrame([(1, "a", True), (2, "b", False), (3, "c", None)],
                               "id long, s string, f boolean")
    out = rows.overwrite_where(df, F.col("f"), {"id": 12345, "s": "x"})
    assert as_set(out, "id", "s") == {(12345, "x"), (2, "b"), (3, "c")}
    assert dict(out.dtypes)["id"] == "bigint"
    a = spark.createDataFrame([("k", 1), ("l", 2)], "m string, v int")
    b = spark.createDataFrame([("k", 3)], "m string, v int")
    assert as_set(rows.union_later_wins([a, b], "m"), "m", "v") == {("k", 3), ("l", 2)}
    assert as_set(rows.union_later_wins([b, a], "m"), "m", "v") == {("k", 1), ("l", 2)}


def test_attendance(spark):
    day = dt.date(2023, 5, 1)
    table = [
        ("all", 2023.0, "No", day), ("all", 2023.0, "No", None),
        ("one", 2023.0, "Yes", day), ("one", 2023.0, "No", day),
        ("null", 2023.0, None, day), ("old", 2022.0, "No", day), (None, 2023.0, "No", day),
    ]
    df = spark.createDataFrame(
        table, "ticker string, year double, attend_less75_pct string, meetingdate date"
    )
    assert as_set(gov.attendance(df), "ticker", "over75_pct", "num_meetings") == {
        ("all", 1, 1), ("one", 0, 2), ("null", 1, 1), (None, 1, 1),
    }
    exact = {r["ticker"]: r["over75_pct"] for r in gov.attendance(df, exact=True).collect()}
    assert exact["one"] == 0.5


def test_flag_share(spark):
    table = [("a", "Yes"), ("a", None), ("b", "No"), (None, "Yes")]
    df = spark.createDataFrame(table, "k string, f string")
    flag = text.yes_no(F.col("f")) == "Yes"
    assert as_set(aggregates.flag_share(df, "k", flag, "p"), "k", "p") == {("a", 0.5)}
    kept = aggregates.flag_share(df, "k", flag, "p", keep_zero=True)
    assert as_set(kept, "k", "p") == {("a", 0.5), ("b", 0.0)}


def test_keyword_any(spark):
    table = [
        ("a", "Diversity"), ("b", "INCLUSION"), ("c", "Sustainability"), ("d", "Audit"),
        ("e", None), ("a", "Audit"), (None, "Diversity"),
    ]
    df = spark.createDataFrame(table, "k string, c string")
    hit = text.matches_ci(F.col("c"), text.DIVERSITY_PATTERN)
    assert as_set(aggregates.any_true(df, "k", hit, "x"), "k", "x") == {
        ("a", True), ("b", True), ("c", True), ("d", False), ("e", False),
    }


def test_shannon(spark):
    table = [("one", "x")] * 3 + [("two", "x"), ("two", "y"), ("part", "x"), ("part", None),
                                 ("none", None), (None, "x")]
    df = spark.createDataFrame(table, "k string, c string")
    got = {r["k"]: r["h"] for r in aggregates.shannon_index(df, "k", "c", "h").collect()}
    assert set(got) == {"one", "two", "part"}
    assert got["one"] == pytest.approx(0.0, abs=1e-12)
    assert got["two"] == pytest.approx(math.log(2))
    assert got["part"] == pytest.approx(0.5 * math.log(2))


def test_last_non_null_and_rollup(spark):
    table = [("a", 1, 5.0, True, 2), ("a", 2, None, False, 3), ("b", 1, None, False, 1)]
    df = spark.createDataFrame(table, "k string, o int, v double, f boolean, t int")
    nan = spark.createDataFrame([("a", 3, float("nan"), True, 1)], df.schema)
    last = aggregates.last_non_null(df.union(nan), "k", "v", ["o"], "last")
    assert as_set(last, "k", "last") == {("a", 5.0), ("b", None)}
    out = aggregates.firm_rollup(df, "k", ["o"], ["v"], any_of=["f"], total=["t"])
    assert as_set(out, "k", "v", "f", "t") == {("a", 5.0, True, 5), ("b", None, False, 1)}


def test_distinct_counts_keep_the_null_group(spark):
    table = [(None, "x", 1), (None, "x", 2), ("a", "y", 1)]
    df = spark.createDataFrame(table, "k string, c string, d int")
    out = aggregates.distinct_counts(df, ["k"], {"cs": "c", "ds": "d"})
    assert as_set(out, "k", "cs", "ds") == {(None, 1, 2), ("a", 1, 1)}
    rough = aggregates.distinct_counts(df, ["k"], {"cs": "c"}, approximate=True)
    assert as_set(rough, "k", "cs") == {(None, 1), ("a", 1)}


def test_population_scaling(spark):
    df = spark.createDataFrame([(1, 7.0), (2, 7.0), (3, 7.0)], "x int, c double")
    out = features.standardise(df, ["x", "c"]).collect()
    assert sorted(r["x"] for r in out) == pytest.approx([-1.224745, 0.0, 1.224745], abs=1e-6)
    assert [r["c"] for r in out] == [0.0, 0.0, 0.0]
    fitted = features.standardise(df, ["x"], fit_on=df.where("x < 3")).collect()
    assert sorted(r["x"] for r in fitted) == [-1.0, 1.0, 3.0]


def test_class_weights(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "label string")
    got = as_set(features.balanced_weights(df, "label"), "label", "weight")
    assert got == {("a", 4 / 6), ("b", 2.0)}
    listed = features.explicit_weights(df, "label", {"a": 2})
    assert as_set(listed, "label", "weight") == {("a", 2.0), ("b", 1.0)}


def test_labels_and_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "y string")
    model = features.fit_labels(df, "y", "i")
    indexed = model.transform(df)
    assert as_set(indexed, "y", "i") == {("a", 0.0), ("b", 1.0), ("c", 2.0)}
    back = features.labels_back(model, "i", "z").transform(indexed)
    assert all(r["y"] == r["z"] for r in back.collect())
    hot = {r["y"]: r["v"].toArray().tolist() for r in features.one_hot(df, "y", "v").collect()}
    assert hot == {"a": [1, 0, 0], "b": [0, 1, 0], "c": [0, 0, 1]}


def test_hash_split_is_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    train, test = features.hash_split(df, "k", seed=1)
    again = features.hash_split(df.repartition(13), "k", seed=1)[1]
    other = features.hash_split(df, "k", seed=2)[1]
    keys = as_set(test, "k")
    assert keys == as_set(again, "k") and keys != as_set(other, "k")
    assert train.count() + len(keys) == 2000 and 300 < len(keys) < 500
