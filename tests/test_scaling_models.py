"""Scalers and models: properties, baselines, persistence."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from beatline.operators import models as M
from beatline.operators import scaling


def _numeric(spark):
    rows = [(float(i), float(i % 7), 3.0) for i in range(50)]
    return spark.createDataFrame(rows, "a double, b double, c double")


def test_population_scaler(spark):
    df = _numeric(spark)
    s = scaling.fit_scaler(df, ["a", "b", "c"], ddof=0)
    out = s.transform(df).toPandas()
    for c in ("a_z", "b_z"):
        assert abs(out[c].mean()) < 1e-12 and math.isclose(out[c].std(ddof=0), 1.0)
    assert (out["c_z"] == 0.0).all()  # zero deviation -> centred only
    # fitted on a subset, applied to the rest
    s2 = scaling.fit_scaler(df.filter("a < 25"), ["a"], ddof=0)
    a = np.arange(25.0)
    assert math.isclose(s2.means[0], a.mean()) and math.isclose(s2.devs[0], a.std())


def test_sample_scaler_pipeline(spark):
    df = _numeric(spark)
    model = scaling.fit_vector_scaler(df, ["a", "b", "c"])
    out = scaling.vector_columns(model.transform(df), "features", ["a_z", "b_z", "c_z"])
    pdf = out.toPandas()
    assert math.isclose(pdf["a_z"].std(ddof=1), 1.0) and abs(pdf["a_z"].mean()) < 1e-12
    assert (pdf["c_z"] == 0.0).all()  # constant column -> 0


def _signal_frame(spark, n=1200):
    rng = np.random.default_rng(0)
    x1 = rng.integers(0, 10, n)
    x2 = rng.integers(0, 24, n)
    noise = rng.random(n)
    label = np.where(x1 < 3, 0, np.where(x2 < 12, 1, 2))
    label = np.where(noise < 0.1, (label + 1) % 3, label)
    rows = [(f"k{i}", int(a), int(b), int(c)) for i, (a, b, c) in enumerate(zip(x1, x2, label))]
    return spark.createDataFrame(rows, "key string, x1 int, x2 int, label int")


def test_forest_beats_majority_and_round_trips(spark, tmp_dir):
    df = _signal_frame(spark)
    train, test = df.filter("key < 'k8'"), df.filter("key >= 'k8'")
    model = M.fit_forest_classifier(train, ["x1", "x2"], "label", num_trees=10, max_depth=4)
    pred = model.transform(M.assemble(test, ["x1", "x2"]))
    acc = pred.filter(F.col("label") == F.col("prediction")).count() / pred.count()
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert acc > majority + 0.2
    path = f"{tmp_dir}/rf"
    M.save_model(spark, model, path)
    again = M.load_model(spark, RandomForestClassificationModel, path)
    p2 = again.transform(M.assemble(test, ["x1", "x2"]))
    a = [r.prediction for r in pred.orderBy("key").collect()]
    b = [r.prediction for r in p2.orderBy("key").collect()]
    assert a == b
    imp = M.feature_importance(spark, model, ["x1", "x2"]).collect()
    assert math.isclose(sum(r.importance for r in imp), 1.0)


def test_best_round_patience():
    assert M.best_round([5, 4, 3, 3.5, 3.6, 3.7, 2.0], patience=3) == 3
    assert M.best_round([5, 4, 3, 3.5, 2.0], patience=3) == 5
    assert M.best_round([1.0], patience=1) == 1


@pytest.mark.slow
def test_one_vs_rest_boosted(spark, tmp_dir):
    df = _signal_frame(spark, 600)
    train, test = df.filter("key < 'k8'"), df.filter("key >= 'k8'")
    ovr = M.fit_one_vs_rest(train, test, ["x1", "x2"], 3, "label", max_iter=6,
                                   max_depth=3, patience=2, min_instances=5, first_rounds=4)
    assert all(1 <= r <= 6 for r in ovr.best_rounds)
    out = ovr.transform(test).toPandas()
    sums = out["probability"].apply(lambda p: sum(p))
    assert np.allclose(sums, 1.0)
    acc = (out["prediction"] == out["label"]).mean()
    assert acc > 0.6
    M.save_model(spark, ovr, f"{tmp_dir}/ovr")
    again = M.load_model(spark, M.OneVsRestBoosted, f"{tmp_dir}/ovr").transform(test).toPandas()
    assert again["prediction"].equals(out["prediction"])
    assert [m.getNumTrees for m in ovr.models] == ovr.best_rounds


@pytest.mark.slow
def test_early_stop_ends_fitting_and_cuts_the_same_trees(spark):
    """Labels are noise: the best round comes early, and few rounds are fitted.
    The first trees predict what a fit of that many rounds predicts."""
    from pyspark.ml.classification import GBTClassifier
    rng = np.random.default_rng(1)
    rows = [(f"k{i}", int(a), int(b), int(c)) for i, (a, b, c) in enumerate(zip(
        rng.integers(0, 9, 400), rng.integers(0, 9, 400), rng.integers(0, 2, 400)))]
    df = spark.createDataFrame(rows, "key string, x1 int, x2 int, label int")
    train, valid = df.filter("key < 'k5'"), df.filter("key >= 'k5'")
    stopped = M.fit_one_vs_rest(train, valid, ["x1", "x2"], 2, "label", step_size=0.3, max_depth=3,
                                       min_instances=5, max_iter=500, patience=3, first_rounds=4)
    for losses, best in zip(stopped.losses, stopped.best_rounds):
        assert len(losses) <= max(4, 2 * (best + 3))
    assert [m.getNumTrees for m in stopped.models] == stopped.best_rounds

    data = M.assemble(train, ["x1", "x2"]).withColumn("label", F.col("label").cast("double")).coalesce(1).cache()
    est = GBTClassifier(maxDepth=3, subsamplingRate=0.8, seed=7)
    cut = M.first_trees(spark, est.copy().setMaxIter(6).fit(data), 3)
    short = est.copy().setMaxIter(3).fit(data)
    of = lambda m: [r[0].toArray() for r in m.transform(data).select("probability").collect()]
    assert np.allclose(of(cut), of(short))


def test_regressors_fit(spark):
    rows = [(float(i), float(i % 5), float(3 * i + (i % 5))) for i in range(80)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    gbt = M.fit_boosted_regressor(df, ["a", "b"], "y", max_iter=60)
    hub = M.fit_huber_regressor(df, ["a", "b"], "y")
    for m, name in [(gbt, "gbt"), (hub, "huber")]:
        p = M.predictions_frame(m, df, ["a", "b"], ["a"], "y", name)
        from beatline.operators.evaluate import regression_metrics
        r = regression_metrics(p).first()
        assert r.r2 > 0.9, name
    curve = M.loss_curve(gbt, {"train": df}, "y").collect()
    losses = [r.loss for r in sorted(curve, key=lambda r: r.round)]
    assert len(losses) == 60 and losses[-1] < losses[0]
