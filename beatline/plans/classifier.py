"""Classifier data path: cleaned rows -> alphabetical label -> exact stratified
split -> class weights (P1-P4), and the surrogate predictions used to check the
evaluation operators.

The source is read once. One narrow staging (the key, the type, the description
group, and the model's features only where a model needs them) is written to the
shared folder; the code tables, the split's histogram and boundary, the weights
and the evaluation read that.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions.text import DESCRIPTION_RULES, group_names
from beatline.operators.encoders import map_lookup
from beatline.operators.split import cutoff_weights, split_cutoffs, with_test_flag
from beatline.plans.classification import encode_rows, fit_codes
from beatline.plans.features import cleaned_features
from beatline.plans.surrogate import fit_group_frequency, predict_group_frequency
from beatline.session import materialize


@dataclass
class ClassifierData:
    rows: DataFrame          # key, primary_type, label (alphabetical), codes, features, is_test
    names: DataFrame         # label, primary_type (alphabetical)
    num_classes: int
    cutoffs: DataFrame       # per class: rows, test rows, cutoff


def classifier_data(incidents: DataFrame, years: tuple[int, int] | None = None,
                    n_types: int = 10, n_locations: int = 50, test_fraction: float = 0.2,
                    seed: int = 42, key: str = "incident_key",
                    features: Sequence[str] = ()) -> ClassifierData:
    """The classification rows labelled alphabetically with an exact stratified
    test flag; with the columns ``features`` of the v2 set, if any are named.

    One pass over the incidents writes the staging; everything else, at any
    later use too, is a pass over (at most) its columns.
    """
    d2 = cleaned_features(incidents, 2, years)
    places = "location_encoded" in features
    own = [c for c in features if c not in ("location_encoded", "description_encoded")]
    extra = ["location_description"] if places else []
    staged = materialize(d2.select(key, "primary_type", "description_grouped", *extra, *own), "classifier-rows")
    codes = fit_codes(staged, n_types, n_locations, locations=places)
    rows = encode_rows(staged, codes, n_types, n_locations).drop("label", *extra)
    types = sorted(r.primary_type for r in codes.types.select("primary_type").collect())  # n_types
    label_of = {t: i for i, t in enumerate(types)}
    rows = rows.withColumn("label", map_lookup(label_of, "primary_type").cast("int"))
    cutoffs = split_cutoffs(rows.select(key, "label"), "label", key, test_fraction, seed)
    rows = with_test_flag(rows, cutoffs, "label", key, seed, class_bound=n_types)
    names = incidents.sparkSession.createDataFrame([(i, t) for t, i in label_of.items()], "label int, primary_type string")
    return ClassifierData(rows, names, len(types), cutoffs)


def train_weights(data: ClassifierData) -> DataFrame:
    """(label, primary_type, train_count, weight) with ``n / (k n_c)``."""
    weights = cutoff_weights(data.cutoffs, "label", data.num_classes)
    return weights.join(data.names, "label").select("label", "primary_type", "train_count", "weight")


def surrogate_predictions(data: ClassifierData, group: str = "description_encoded"
                          ) -> DataFrame:
    """Test rows with the group-frequency model's probabilities and
    prediction, the model counted on the train rows."""
    train = data.rows.filter(~F.col("is_test"))
    test = data.rows.filter(F.col("is_test"))
    model = fit_group_frequency(train, group, data.num_classes)
    return predict_group_frequency(test, model, group,
                                   group_bound=len(group_names(DESCRIPTION_RULES)))


def surrogate_counts(data: ClassifierData, group: str = "description_encoded") -> DataFrame:
    """(label, prediction, n) of the test rows under the group-frequency model.
    Rows of a group and a label are alike to it, so one aggregate by (group,
    label, part) gives the fit, the predictions and their counts."""
    counts = materialize(data.rows.groupBy(group, "label", "is_test").agg(F.count(F.lit(1)).alias("n")), "surrogate-counts")
    model = fit_group_frequency(counts.filter(~F.col("is_test")), group, data.num_classes, weight="n")
    return predict_group_frequency(counts.filter("is_test"), model, group,
                                   group_bound=len(group_names(DESCRIPTION_RULES))).select("label", "prediction", "prob_true", "n")
