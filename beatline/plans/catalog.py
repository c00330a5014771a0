"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query starts from the incident view over the driver's tables, so its
work grows with them. Computed columns carry the names used by the oracle
SQL in ``beatline.plans.oracle_queries``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.operators import encoders, evaluate, explore, filters, panel, scaling, sketches, split
from beatline.operators import models as M
from beatline.operators.boosting import gain_importance
from beatline.operators.ranking import global_row_number
from beatline.plans import classification as C
from beatline.plans import features as FT
from beatline.plans.classifier import classifier_data, surrogate_counts, surrogate_predictions, train_weights
from beatline.plans.feature_pipeline import fit_feature_pipeline
from beatline.plans.params import (
    BOOSTED_CLASSIFIER, BOOSTED_REGRESSOR, CUT_YEAR, FOREST, N_LOCATIONS, N_TYPES,
    PREVIEW_ROWS, SAMPLE_P, SEED, SHUFFLE_CAP, TEST_FRACTION, TOP_TYPES_REPORT, YEARS, CAP_ROWS, NULL_KEY_CAP,
)
from beatline.plans.regression import baseline_predictions, panel_from_incidents
from beatline.schema import (
    FEATURES_V1, FEATURES_V2, KEYS_V2, NULL_PROFILE_COLUMNS, PANEL_FEATURES,
)
from beatline.session import materialize, scratch_path
from beatline.sources.fixture import fixture_incidents
from beatline.sources.incidents import describe_columns, preview, read_csv, read_incidents, register_table, write_table

Query = Callable[[SparkSession, str], DataFrame]
KEY = "incident_key"


def _inc(spark, sf):
    return fixture_incidents(spark, sf)


def _d1(spark, sf):
    return FT.extract_incidents(_inc(spark, sf), YEARS)


def _d2(spark, sf, version=2):
    return FT.cleaned_features(_inc(spark, sf), version, YEARS)


def _cs(spark, sf):
    return C.build_v2(_inc(spark, sf), YEARS, N_TYPES, N_LOCATIONS)


def _panel(spark, sf):
    return panel_from_incidents(_inc(spark, sf), YEARS, N_TYPES, N_LOCATIONS)


def _r6(df: DataFrame, cols) -> DataFrame:
    """Round the given double columns to 6 decimals (oracle hygiene)."""
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# --- sources -----------------------------------------------------------------

def q_scan_incidents(spark, sf):
    return _inc(spark, sf)


def q_preview(spark, sf):
    return preview(_inc(spark, sf), PREVIEW_ROWS, order_by=[KEY])


def q_describe_columns(spark, sf):
    return describe_columns(_inc(spark, sf))


def q_read_incidents(spark, sf):
    """The stored table, read by the reader that users call."""
    path = scratch_path(spark, "incidents")
    _inc(spark, sf).write.parquet(path)
    return FT.extract_incidents(read_incidents(spark, path), YEARS)


def q_csv_roundtrip(spark, sf):
    text = F.col("description")
    day = F.col("day_of_week")
    awkward = (F.when(day == 1, "").when(day == 2, F.lit(None)).when(day == 3, F.concat(F.lit("  "), text, F.lit("  ")))
               .when(day == 4, F.concat(F.lit('say "'), text, F.lit('", ok')))
               .when(day == 5, F.concat(text, F.lit('\n"'))).when(day == 6, " ").otherwise(text))
    d1 = _d1(spark, sf).withColumn("description", awkward)
    path = scratch_path(spark, "extract-csv")
    write_table(d1, path, "csv")
    return read_csv(spark, path, schema=d1.schema)


def q_partitioned_sink(spark, sf):
    """The extract stored by year, one year overwritten by its arrests alone, and
    the late years read back."""
    path = scratch_path(spark, "extract-by-year")
    d1 = _d1(spark, sf)
    write_table(d1, path, "parquet", ["year"])
    stored = read_incidents(spark, path)
    revised = materialize(stored.filter((F.col("year") == CUT_YEAR) & F.col("arrest")), "revised-year")
    write_table(revised, path, "parquet", ["year"], only_present=True)
    return read_incidents(spark, path).filter(F.col("year") >= CUT_YEAR - 1)


def q_catalog_scan(spark, sf):
    """Incidents and their frequent types as catalog tables with statistics, joined."""
    d1, kinds = scratch_path(spark, "extract"), scratch_path(spark, "frequent-types")
    _d1(spark, sf).write.parquet(d1)
    encoders.top_n_keys(read_incidents(spark, d1), "primary_type", N_TYPES).write.parquet(kinds)
    tag = uuid.uuid4().hex
    register_table(spark, f"incidents_{tag}", d1, columns=["primary_type", "district", "year"])
    register_table(spark, f"types_{tag}", kinds)
    rows = read_incidents(spark, f"incidents_{tag}", "table")
    types = read_incidents(spark, f"types_{tag}", "table").select("primary_type", F.col("n").alias("of_type"))
    return (rows.filter(F.col("year") > CUT_YEAR).join(types, "primary_type")
            .groupBy("primary_type", "district", "of_type").agg(F.count("*").alias("n")))


# --- exploration -------------------------------------------------------------

def q_total_rows(spark, sf):
    return explore.total_rows(_inc(spark, sf))


def q_type_distribution(spark, sf):
    return explore.type_distribution(_inc(spark, sf), "primary_type", TOP_TYPES_REPORT)


def q_type_frequency(spark, sf):
    return explore.value_counts(_d1(spark, sf), "primary_type", 10)


def q_group_frequency(spark, sf):
    return explore.value_counts(_d2(spark, sf), "description_grouped")


def q_yearly_district_counts(spark, sf):
    return explore.yearly_district_counts(_inc(spark, sf))


def q_null_profile(spark, sf):
    return explore.null_profile(_inc(spark, sf), NULL_PROFILE_COLUMNS)


def q_stage_funnel(spark, sf):
    cs = _cs(spark, sf)
    d1 = _d1(spark, sf)
    top = cs.type_codes.select("primary_type", F.lit(True).alias("_top"))
    marked = d1.join(F.broadcast(top), "primary_type", "left")
    not_null = None
    for c in KEYS_V2:
        part = F.col(c).isNotNull()
        not_null = part if not_null is None else not_null & part
    return explore.stage_funnel(marked, [("loaded", None), ("not_null", not_null),
                                         ("top_types", F.col("_top").isNotNull())])


def q_class_list(spark, sf):
    return explore.class_list(_cs(spark, sf).rows, "primary_type", bound=N_TYPES)


def q_ranked_values(spark, sf):
    """Every incident key in order of its place, numbered by ranges."""
    return global_row_number(_d1(spark, sf).select(KEY, "location_description").distinct(),
                             [F.col("location_description").asc_nulls_first(), F.col(KEY)], "place", total="of")


def q_location_codes(spark, sf):
    """Codes of all places by frequency, their number not bounded in advance."""
    return encoders.frequency_code_table(
        encoders.counts_of(_d1(spark, sf), "location_description"), "location_description")


def q_distinct_sketches(spark, sf):
    """Distinct keys, wards and areas of a month, a year and the city: exact, and
    whether the sketches - those of years and city merged from the months' - are
    within the bound."""
    d1 = _d1(spark, sf)
    cols = ["incident_key", "ward", "community_area"]
    months = materialize(sketches.distinct_sketches(d1, ["year", "month"], cols), "sketches")
    levels = {"month": ["year", "month"], "year": ["year"], "city": []}
    approx = None
    for name, keys in levels.items():
        part = sketches.sketch_estimates(sketches.merge_sketches(months, keys, cols), cols)
        part = part.select(F.lit(name).alias("level"), *[
            F.col(k) if k in keys else F.lit(None).cast("int").alias(k) for k in ("year", "month")],
            *[f"approx_{c}" for c in cols])
        approx = part if approx is None else approx.unionByName(part)
    sets = [[F.col(k) for k in keys] for keys in levels.values()]
    exact = d1.groupingSets(sets, "year", "month").agg(
        F.grouping_id("year", "month").alias("g"), *[F.countDistinct(c).alias(c) for c in cols])
    exact = exact.withColumn("level", F.element_at(F.array(F.lit("month"), F.lit("year"), F.lit(None), F.lit("city")), F.col("g").cast("int") + 1))
    e, a = exact.alias("e"), approx.alias("a")
    same = [F.col(f"e.{k}").eqNullSafe(F.col(f"a.{k}")) for k in ("level", "year", "month")]
    near = [(F.abs(F.col(f"approx_{c}") - F.col(f"e.{c}")) <= sketches.relative_error() * F.col(f"e.{c}") + 0.5)
            for c in cols]
    return e.join(a, same[0] & same[1] & same[2], "left").select(
        "e.level", "e.year", "e.month", *[F.col(f"e.{c}").alias(f"n_{c}") for c in cols],
        *[F.coalesce(x, F.lit(False)).alias(f"{c}_within") for x, c in zip(near, cols)])


# --- extract, clean, row features -------------------------------------------

def q_extract_incidents(spark, sf):
    return _d1(spark, sf)


def q_clean_v1(spark, sf):
    return FT.clean(_d1(spark, sf), 1)


def q_clean_v2(spark, sf):
    return FT.clean(_d1(spark, sf), 2)


def q_calendar_parts(spark, sf):
    from beatline.functions.calendar import calendar_parts
    inc = _inc(spark, sf)
    return inc.filter(F.col("date").isNotNull()).select(KEY, *calendar_parts("date"))


def q_derive_time_features(spark, sf):
    return _d2(spark, sf).select(KEY, "arrest_int", "domestic_int", "is_rush_hour",
                                 "is_weekend", "season", "district_hour")


def q_group_descriptions(spark, sf):
    return _d2(spark, sf).select(KEY, "description", "description_grouped")


def q_sample_fraction(spark, sf):
    return filters.sample_fraction(_d1(spark, sf), SAMPLE_P, SEED, KEY)


def q_shuffled_cap(spark, sf):
    sample = filters.sample_fraction(_d1(spark, sf), SAMPLE_P, SEED, KEY)
    return filters.shuffled_cap(sample, SHUFFLE_CAP, SEED, KEY, order_seed=SEED + 1)


def q_capped_sample(spark, sf):
    sample = filters.sample_fraction(_d1(spark, sf), SAMPLE_P, SEED, KEY)
    return filters.shuffled_cap(sample, NULL_KEY_CAP, SEED, KEY, order_seed=SEED + 1)


def q_cap(spark, sf):
    return filters.cap(_d1(spark, sf), CAP_ROWS).agg(F.count("*").alias("n"))


def q_null_keys(spark, sf):
    """Rows kept where keys are null: the sample, a cap that binds, the split."""
    holes = _d1(spark, sf).withColumn(KEY, F.when(F.col("hour_of_day") != 3, F.col(KEY)))
    n = lambda what, df: df.agg(F.lit(what).alias("what"), F.count("*").alias("n"))
    return n("sampled", filters.sample_fraction(holes, SAMPLE_P, SEED, KEY)).unionByName(
        n("capped", filters.shuffled_cap(holes, NULL_KEY_CAP, SEED, KEY))).unionByName(
        n("split", split.stratified_split(holes, "month", KEY, TEST_FRACTION, SEED)))


# --- top lists and encoders --------------------------------------------------

def q_top_n_keys(spark, sf):
    return encoders.top_n_keys(_d2(spark, sf), "primary_type", N_TYPES)


def q_keep_top_types(spark, sf):
    return encoders.keep_top_n(_d2(spark, sf), "primary_type", N_TYPES).select(
        KEY, "primary_type")


def q_bucket_locations(spark, sf):
    return encoders.bucket_rare(_d2(spark, sf), "location_description", N_LOCATIONS).select(
        KEY, "location_description", "location_description_clean")


def _codes(spark, sf):
    return C.fit_codes(_d2(spark, sf), N_TYPES, N_LOCATIONS)


def q_encode_location(spark, sf):
    return _codes(spark, sf).locations


def q_encode_description(spark, sf):
    return _codes(spark, sf).descriptions


def q_encode_label_freq(spark, sf):
    return _codes(spark, sf).types


def q_encode_label_alpha(spark, sf):
    return C.alphabetical_labels(_cs(spark, sf).rows, "primary_type", "label")


def q_classification_features(spark, sf):
    return _cs(spark, sf).rows


def q_feature_pipeline(spark, sf):
    """The features by a pipeline that was fitted, saved and loaded again."""
    d2 = _d2(spark, sf)
    path = scratch_path(spark, "feature-pipeline")
    fit_feature_pipeline(d2, N_TYPES, N_LOCATIONS).write().overwrite().save(path)
    return PipelineModel.load(path).transform(d2.drop("description_grouped"))


def q_classification_features_v1(spark, sf):
    return C.build_v1(_inc(spark, sf), YEARS, N_TYPES).rows


# --- panel -------------------------------------------------------------------

def q_monthly_counts(spark, sf):
    return panel.monthly_counts(_d2(spark, sf))


def q_monthly_panel(spark, sf):
    return _panel(spark, sf)


def q_panel_summary(spark, sf):
    return _r6(panel.panel_summary(_panel(spark, sf)), ["mean_crime_count"])


def q_chronological_split(spark, sf):
    return filters.with_split_flag(_panel(spark, sf), "year", CUT_YEAR).select(
        "district", "year", "month", "crime_count", "split")


# --- scaling -----------------------------------------------------------------

def q_standardize_sample(spark, sf):
    rows = C.build_v1(_inc(spark, sf), YEARS, N_TYPES).rows
    model = scaling.fit_vector_scaler(rows, FEATURES_V1)
    scaled = model.transform(rows)
    names = [c + "_z" for c in FEATURES_V1]
    return _r6(scaling.vector_columns(scaled, "features", names, keep=[KEY]), names)


def q_standardize_population(spark, sf):
    p = filters.with_split_flag(_panel(spark, sf), "year", CUT_YEAR)
    scaler = scaling.fit_scaler(p.filter(F.col("split") == "train"), PANEL_FEATURES, ddof=0)
    out = scaler.transform(p, keep=["district", "year", "month", "split"])
    # district/year/month are also features: the scaled copies keep the _z suffix.
    return _r6(out, [c + "_z" for c in PANEL_FEATURES])


# --- splits, weights, evaluation on surrogate predictions -------------------

def _cd(spark, sf, features=()):
    return classifier_data(_inc(spark, sf), YEARS, N_TYPES, N_LOCATIONS, TEST_FRACTION, SEED, features=features)


def q_stratified_split(spark, sf):
    return _cd(spark, sf).rows.select(KEY, "label", "primary_type", "is_test")


def q_class_weights(spark, sf):
    return train_weights(_cd(spark, sf))


def q_argmax_class(spark, sf):
    pred = surrogate_predictions(_cd(spark, sf))
    return pred.select(KEY, "label", F.col("prediction").cast("int").alias("prediction"))


def q_multiclass_log_loss(spark, sf):
    pred = surrogate_predictions(_cd(spark, sf))
    return _r6(evaluate.multiclass_log_loss(pred, "prob_true"), ["log_loss"])


def q_classification_report(spark, sf):
    cd = _cd(spark, sf)
    rep = evaluate.classification_report(surrogate_counts(cd), names=cd.names, name_col="primary_type", weight="n")
    return _r6(rep, ["precision", "recall", "f1"])


def q_confusion_matrix(spark, sf):
    cd = _cd(spark, sf)
    return _r6(evaluate.confusion_matrix(surrogate_counts(cd), cd.num_classes, weight="n"), ["row_share"])


def _preds(spark, sf):
    return baseline_predictions(_panel(spark, sf), CUT_YEAR)


_METRICS = ["mae", "rmse", "r2", "mean_actual", "mae_pct"]


def q_regression_metrics(spark, sf):
    preds = _preds(spark, sf).filter(F.col("model") == "rolling_mean")
    return _r6(evaluate.regression_metrics(preds, by=["model"]), _METRICS)


def q_model_comparison(spark, sf):
    return _r6(evaluate.regression_metrics(_preds(spark, sf), by=["model"]), _METRICS)


def q_prediction_sample(spark, sf):
    preds = _preds(spark, sf).filter(F.col("model") == "rolling_mean")
    return evaluate.prediction_sample(preds, ["district", "year", "month"], 15)


# --- models (rows-only checks) -----------------------------------------------

def _train_test(spark, sf, features=FEATURES_V2):
    cd = _cd(spark, sf, features)
    w = train_weights(cd)
    rows = split.with_class_weights(cd.rows, w, bound=N_TYPES)
    return cd, rows.filter(~F.col("is_test")), rows.filter(F.col("is_test"))


def q_weighted_rows(spark, sf):
    _, train, _ = _train_test(spark, sf, ())
    return train.select(KEY, "label", "weight")


def q_model_roundtrip(spark, sf):
    """Test rows, and those whose prediction is the same after a save and a load."""
    _, train, test = _train_test(spark, sf)
    model = M.fit_forest_classifier(train, FEATURES_V2, "label", "weight", **FOREST, seed=SEED)
    path = scratch_path(spark, "model")
    M.save_model(spark, model, path)
    again = M.load_model(spark, type(model), path)
    rows = M.assemble(test, FEATURES_V2).select("features")
    a = model.transform(rows).select("features", F.col("prediction").alias("before"))
    both = again.transform(a)
    return both.agg(F.count("*").alias("rows"), F.count_if(F.col("before") == F.col("prediction")).alias("same"))


def q_fitted_model_comparison(spark, sf):
    """Three fitted regressors and the naive forecasts, by the same metrics."""
    train, test = _panel_split(spark, sf)
    keys = ["district", "year", "month"]
    trees = _regressor(spark, sf, train, test)
    robust = M.fit_robust_regressor(train, PANEL_FEATURES, "crime_count", **BOOSTED_REGRESSOR, seed=SEED)
    huber = M.fit_huber_regressor(train, PANEL_FEATURES, "crime_count")
    preds = baseline_predictions(train.unionByName(test), CUT_YEAR)
    for name, model in (("boosted_trees", trees), ("robust_trees", robust), ("huber_linear", huber)):
        preds = preds.unionByName(M.predictions_frame(model, test, PANEL_FEATURES, keys, "crime_count", name))
    return _r6(evaluate.regression_metrics(preds, by=["model"]), _METRICS)


def q_fitted_classification_report(spark, sf):
    cd, train, test = _train_test(spark, sf)
    model = M.fit_forest_classifier(train, FEATURES_V2, "label", "weight", **FOREST, seed=SEED)
    out = model.transform(M.assemble(test, FEATURES_V2)).select("label", F.col("prediction").cast("int").alias("prediction"))
    return _r6(evaluate.classification_report(out, names=cd.names, name_col="primary_type"), ["precision", "recall", "f1"])


def q_fit_forest_classifier(spark, sf):
    cd, train, test = _train_test(spark, sf)
    model = M.fit_forest_classifier(train, FEATURES_V2, "label", "weight",
                                    **FOREST, seed=SEED)
    out = model.transform(M.assemble(test, FEATURES_V2))
    return out.select(KEY, "label", F.col("prediction").cast("int").alias("prediction"))


#: Models fitted, by session, folder and kind: where they are saved. The queries
#: on one model share its fit and read it back from there.
_SAVED: dict[tuple, str] = {}


def _saved(spark, sf, kind, fit):
    at = spark, sf, kind
    if at not in _SAVED:
        model = fit()
        _SAVED[at] = scratch_path(spark, kind)
        M.save_model(spark, model, _SAVED[at])
    return M.load_model(spark, M.BoostedTrees, _SAVED[at])


def _classifier(spark, sf):
    """The boosted classifier, and its data with the test rows."""
    cd, train, test = _train_test(spark, sf)
    return _saved(spark, sf, "boosted-classifier", lambda: M.fit_boosted_classifier(
        train, test, FEATURES_V2, cd.num_classes, "label", "weight", **BOOSTED_CLASSIFIER, seed=SEED)), cd, test


def _regressor(spark, sf, train, test):
    def fit():
        return M.fit_boosted_regressor(train, PANEL_FEATURES, "crime_count", **BOOSTED_REGRESSOR, seed=SEED, valid=test)
    return _saved(spark, sf, "boosted-regressor", fit)


def q_fit_boosted_classifier(spark, sf):
    model, _, test = _classifier(spark, sf)
    return model.transform(test).select(KEY, "label", F.col("prediction").cast("int").alias("prediction"))


def q_boosted_classification_report(spark, sf):
    """The evaluation of the trained classifier (V1)."""
    model, cd, test = _classifier(spark, sf)
    rep = evaluate.classification_report(model.transform(test), names=cd.names, name_col="primary_type")
    return _r6(rep, ["precision", "recall", "f1"])


def q_boosted_log_loss(spark, sf):
    """The validation loss of the trained classifier (L7) beside the surrogate's."""
    model, cd, test = _classifier(spark, sf)
    mine = model.transform(test).withColumn("prob_true", F.get("probability", F.col("label")))
    one = lambda name, df: evaluate.multiclass_log_loss(df, "prob_true").select(F.lit(name).alias("model"), "log_loss", "rows")
    return _r6(one("boosted", mine).unionByName(one("group_frequency", surrogate_predictions(cd))), ["log_loss"])


def q_boosted_importance(spark, sf):
    """Raw gain and splits of each feature, from the saved model's node table (L4)."""
    model, _, _ = _classifier(spark, sf)
    return gain_importance(model.nodes(spark), FEATURES_V2)


def q_boosted_loss_curve(spark, sf):
    """Training and validation loss of the classifier by round."""
    model, _, _ = _classifier(spark, sf)
    return M.training_losses(spark, model)


def _panel_split(spark, sf):
    p = _panel(spark, sf)
    return p.filter(F.col("year") <= CUT_YEAR), p.filter(F.col("year") > CUT_YEAR)


def q_fit_boosted_regressor(spark, sf):
    train, test = _panel_split(spark, sf)
    model = _regressor(spark, sf, train, test)
    return M.predictions_frame(model, test, PANEL_FEATURES, ["district", "year", "month"],
                               "crime_count", "boosted_trees")


def q_fit_huber_regressor(spark, sf):
    train, test = _panel_split(spark, sf)
    model = M.fit_huber_regressor(train, PANEL_FEATURES, "crime_count")
    return M.predictions_frame(model, test, PANEL_FEATURES, ["district", "year", "month"],
                               "crime_count", "huber_linear")


def q_feature_importance(spark, sf):
    cd, train, test = _train_test(spark, sf)
    model = M.fit_forest_classifier(train, FEATURES_V2, "label", "weight",
                                    **FOREST, seed=SEED)
    return M.feature_importance(spark, model, FEATURES_V2)


def q_loss_curve(spark, sf):
    train, test = _panel_split(spark, sf)
    return M.loss_curve(_regressor(spark, sf, train, test), {"train": train, "test": test}, "crime_count")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
