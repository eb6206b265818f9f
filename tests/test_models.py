"""Model frame, registry, repeated runs and predictions."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from boardlens.operators.features import hash_split
from boardlens.operators.models import Model, Size, accuracy, registry, repeated_runs
from boardlens.plans.experiments import BINARY, NUMERIC, prepare_features, score_all



def small(name: str, classes: int = 3, features: int = 4):
    """A registered model with a shorter estimator, to keep the tests quick."""
    model = registry(Size(features, classes))[name]
    kind = name.split("_")[0]
    if kind in ("gbm", "xgb"):
        return replace(model, estimator=replace(model.estimator, rounds=3, depth=4))
    if kind == "svm":
        return model
    estimator = model.estimator.copy()
    if kind == "rf":
        estimator = estimator.setNumTrees(5).setMaxDepth(4)
    return replace(model, estimator=estimator)


@pytest.fixture(scope="module")
def separable(spark):
    """Three well separated clouds in four dimensions."""
    rng = random.Random(3)
    rows = [
        (i, [rng.gauss(6.0 if j == i % 3 else 0.0, 1.0) for j in range(4)], float(i % 3))
        for i in range(240)
    ]
    df = spark.createDataFrame(rows, "k long, x array<double>, label double")
    return df.select("k", array_to_vector("x").alias("features"), "label").cache()


def test_registry_names():
    names = registry(Size(4, 3))
    assert len(names) == 20
    assert {n.split("_")[0] for n in names} == {"rf", "gbm", "svm", "xgb", "logreg", "cnn"}


def test_full_size_settings(spark):
    models = registry(Size(17, 7))
    forest = models["rf_model_1"].estimator
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (200, 30)
    assert models["cnn_model_4"].estimator.getLayers() == [17, 256, 128, 64, 7]
    assert [models[f"svm_model_{i}"].estimator.inverse_penalty for i in (1, 2, 3)] == [1.0, 0.5, 1.0]
    assert models["cnn_model_1"].estimator.getSeed() != models["cnn_model_2"].estimator.getSeed()
    boosted = [models[f"{k}_model_{i}"].estimator for k in ("gbm", "xgb") for i in (1, 2, 3)]
    assert [(b.rounds, b.depth, b.rate, b.sample, b.min_child) for b in boosted] == [
        (200, 3, 0.05, 1.0, 1.0), (100, 3, 0.1, 0.8, 1.0), (100, 5, 0.1, 1.0, 1.0),
        (100, 8, 0.3, 1.0, 1.0), (100, 6, 0.05, 1.0, 1.0), (100, 6, 0.3, 1.0, 5.0),
    ]
    assert [b.second_order for b in boosted] == [False] * 3 + [True] * 3


@pytest.mark.parametrize(
    "name",
    ["rf_model_1", "gbm_model_2", "xgb_model_3", "svm_model_1", "svm_model_2", "logreg_model_1",
     "logreg_model_2", "logreg_model_3", "cnn_model_3"],
)
def test_learns(separable, name):
    model = small(name)
    train, test = hash_split(separable, "k")
    scored = model.predict(model.fit(train), test)
    assert scored.columns == ["k", "features", "label", "prediction"]
    assert scored.select("features").first()["features"].size == 4
    assert accuracy(scored).first()["accuracy"] > 0.8


def test_repeated_runs(separable):
    models = {"m": small("rf_model_2")}
    first = repeated_runs(separable, models, "k", runs=3).collect()
    again = repeated_runs(separable, models, "k", runs=[1]).collect()
    assert [(r["model"], r["run"]) for r in first] == [("m", 0), ("m", 1), ("m", 2)]
    assert all(r["n_train"] + r["n_test"] == 240 for r in first)
    assert again[0]["accuracy"] == first[1]["accuracy"]


def test_failures_surface(separable):
    broken = registry(Size(9, 3))["cnn_model_3"]
    with pytest.raises(Exception):
        repeated_runs(separable, {"m": broken}, "k", runs=1)


@pytest.fixture(scope="module")
def wide(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        up = i % 2
        numbers = [rng.gauss(5.0 * up, 1.0) for _ in NUMERIC]
        flags = [rng.random() < 0.5 for _ in BINARY]
        target = "Moderate Increase" if up else "Stable"
        rows.append((f"T{i}", *numbers, *flags, target if i else None))
    ddl = ["ticker string", *[f"{c} double" for c in NUMERIC], *[f"{c} boolean" for c in BINARY]]
    return spark.createDataFrame(rows, ", ".join([*ddl, "roachange string"])).cache()


@pytest.mark.parametrize("fit_on", ["all", "train"])
def test_prepare_features(wide, fit_on):
    prepared = prepare_features(wide, fit_on=fit_on)
    assert prepared.labels.labels == ["Moderate Increase", "Stable"]
    assert prepared.frame.count() == 119
    assert prepared.frame.first()["features"].size == 17
    raw = {r["ticker"]: r["tenure"] for r in wide.collect()}
    assert all(raw[r["ticker"]] == r["tenure"] for r in prepared.frame.collect())
    if fit_on == "all":
        x = [r["features"][1] for r in prepared.frame.collect()]
        assert sum(x) == pytest.approx(0.0, abs=1e-9)
        assert sum(v * v for v in x) / len(x) == pytest.approx(1.0)


def test_score_all(wide):
    model = registry(Size(17, 2))["cnn_model_3"]
    final, held_out = score_all(prepare_features(wide), model)
    assert final.columns == [c for c in wide.columns if c != "roachange"] + ["roapredicted"]
    rows = final.collect()
    assert len(rows) == 119
    truth = {r["ticker"]: r["roachange"] for r in wide.where(F.col("roachange").isNotNull()).collect()}
    hits = sum(truth[r["ticker"]] == r["roapredicted"] for r in rows)
    assert hits > 110
    assert held_out.first()["accuracy"] > 0.9


def test_penalty_follows_from_the_weights_that_are_fitted(separable):
    """Ridge strength 1 / (C * sum of weights): doubled rows and doubled C give equal coefficients."""
    model = registry(Size(4, 3))["logreg_model_3"]
    once = model.fit(separable)
    weights = {0.0: 1.0, 1.0: 2.0, 2.0: 3.0}
    total = sum(weights[r["label"]] for r in separable.collect())
    assert once.getRegParam() == pytest.approx(1 / total)
    twice = replace(model, inverse_penalty=0.5).fit(separable.union(separable))
    a, b = once.coefficientMatrix.toArray(), twice.coefficientMatrix.toArray()
    assert abs(a - b).max() < 1e-3 * abs(a).max()


def test_rows_without_a_key_train(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3), ("c", 4)], "k string, v int")
    train, test = hash_split(df, "k")
    assert train.count() + test.count() == 4 and train.where("k IS NULL").count() == 1


@pytest.mark.parametrize("classes", [2, 500])
def test_balanced_weights_keep_the_columns(spark, classes):
    from boardlens.operators.features import balanced_weights

    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % classes).alias("lab"))
    out = balanced_weights(df.union(spark.createDataFrame([(1000, None)], df.schema)), "lab")
    assert out.columns == ["k", "lab", "weight"] and out.count() == 1001
    rows = out.collect()
    assert all(r["weight"] == pytest.approx(1.0) for r in rows if r["lab"] is not None)
    assert [r["weight"] for r in rows if r["lab"] is None] == [None]


def test_slots_equal_the_encoders(spark):
    from boardlens.operators.features import fit_labels, indicator_slots

    df = spark.range(200).select(F.when(F.col("id") % 9 > 0, F.md5((F.col("id") % 37).cast("string"))).alias("v"))
    got = {(r["v"], r["s"]) for r in indicator_slots(df, "v", "s").collect()}
    full = df.dropna()
    want = {(r["v"], int(r["s"])) for r in fit_labels(full, "v", "s").transform(full).collect()}
    assert got == want | {(None, None)}


@pytest.mark.parametrize("parts", [1, 40])
def test_rows_are_spread_over_the_cores(spark, separable, parts):
    """One file or many: every core fits, and no more parts than that send sums to the driver."""
    seen = []

    class Estimator:
        def fit(self, rows):
            seen.append(rows.rdd.getNumPartitions())

    Model(Estimator()).fit(separable.coalesce(1).repartition(parts))
    assert seen == [spark.sparkContext.defaultParallelism]


def test_forests_keep_the_node_of_each_row():
    """Without it each pass sends whole trees to every task and walks all rows down them."""
    forests = [m.estimator for n, m in registry(Size(4, 3)).items() if n.startswith("rf")]
    assert all(f.getCacheNodeIds() and f.getMaxMemoryInMB() >= 1024 for f in forests)
