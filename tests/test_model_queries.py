"""The registered model queries fit at the reference's settings."""

import inspect
from types import SimpleNamespace

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from beatline.plans import catalog

from conftest import SF_SMALL

WANT = {
    "fit_forest_classifier": {"num_trees": 50, "max_depth": 8},
    "fit_boosted_classifier": {"max_iter": 1500, "step_size": 0.05, "max_depth": 8, "max_leaves": 63, "patience": 50, "min_instances": 20,
                               "subsampling_rate": 0.8, "subsampling_rounds": 5, "feature_share": 0.8},
    "fit_boosted_regressor": {"max_iter": 500, "step_size": 0.05, "max_depth": 4},
}


class Fitted(Exception):
    pass


@pytest.mark.parametrize("key, fit", [
    ("fit_boosted_classifier", "fit_boosted_classifier"), ("boosted_classification_report", "fit_boosted_classifier"),
    ("boosted_importance", "fit_boosted_classifier"), ("boosted_loss_curve", "fit_boosted_classifier"),
    ("boosted_log_loss", "fit_boosted_classifier"), ("fit_boosted_regressor", "fit_boosted_regressor"),
    ("loss_curve", "fit_boosted_regressor"), ("fitted_model_comparison", "fit_boosted_regressor"),
    ("fit_forest_classifier", "fit_forest_classifier"), ("feature_importance", "fit_forest_classifier"),
    ("model_roundtrip", "fit_forest_classifier"), ("fitted_classification_report", "fit_forest_classifier")])
def test_model_query_is_uncut(monkeypatch, key, fit):
    signature, seen = inspect.signature(getattr(catalog.M, fit)), {}

    def record(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        seen.update(bound.arguments)
        raise Fitted

    monkeypatch.setattr(catalog.M, fit, record)
    monkeypatch.setattr(catalog, "_train_test", lambda *_: (SimpleNamespace(num_classes=10), None, None))
    monkeypatch.setattr(catalog, "_panel_split", lambda *_: (None, None))
    with pytest.raises(Fitted):
        catalog.QUERIES[key](None, "")
    assert {k: seen[k] for k in WANT[fit]} == WANT[fit]


@pytest.mark.parametrize("key", ["fit_boosted_regressor", "loss_curve", "fitted_model_comparison"])
def test_panel_is_built_once(spark, monkeypatch, key):
    """The fit and its evaluation share one pass over the incidents."""
    built, build = [], catalog.panel_from_incidents
    monkeypatch.setattr(catalog, "panel_from_incidents", lambda *a: built.append(1) or build(*a))
    monkeypatch.setattr(catalog, "BOOSTED_REGRESSOR", {**catalog.BOOSTED_REGRESSOR, "max_iter": 2})
    monkeypatch.setattr(catalog, "_SAVED", {})
    catalog.QUERIES[key](spark, SF_SMALL).collect()
    assert len(built) == 1


def test_forest_fit_keeps_its_rows_while_it_runs(spark, monkeypatch):
    """The passes of the fit read stored columns; the trees are those of a fit on the plan itself."""
    df = spark.range(0, 4000, 1, 5).select(
        (F.col("id") % 13).alias("a"), (F.col("id") * 7 % 31).alias("b"), F.lit("unused").alias("c"),
        (F.col("id") % 13 % 3).cast("int").alias("label"), (1 + F.col("id") % 2).cast("double").alias("w"))
    seen, assemble = [], catalog.M.assemble

    def record(rows, *args):
        seen.append((rows, rows.storageLevel))
        return assemble(rows, *args)

    monkeypatch.setattr(catalog.M, "assemble", record)
    model = catalog.M.fit_forest_classifier(df, ["a", "b"], "label", "w", num_trees=5, max_depth=4)
    (rows, level), = seen
    assert level.useDisk and not level.useMemory and rows.columns == ["a", "b", "label", "w"]
    assert not rows.storageLevel.useDisk
    plain = RandomForestClassifier(numTrees=5, maxDepth=4, seed=42, subsamplingRate=0.8, featureSubsetStrategy="0.8",
                                   minInstancesPerNode=20, maxBins=64, weightCol="w").fit(assemble(df, ["a", "b"]))
    trees = lambda m: m.toDebugString.split("\n", 1)[1]
    assert trees(model) == trees(plain)
    df.persist()
    try:
        catalog.M.fit_forest_classifier(df, ["a", "b"], "label", num_trees=2, max_depth=2)
        assert df.storageLevel.useMemory and not seen[1][1].useDisk
    finally:
        df.unpersist()
