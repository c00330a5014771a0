"""The classification features (D3) as one fitted, persistable pipeline (M8).

All encoders are fitted from the one profile of ``fit_codes`` - a pass over the
rows - and become stages of a ``PipelineModel``: keyword groups, rare places
bucketed, description and place codes, the top types' rows, the label. Saved and
loaded, it gives the same rows, and encodes rows it has not seen by the same tables.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions.text import keyword_group
from beatline.operators.encoders import collect_code_maps
from beatline.operators.transformers import ColumnKeeper, KeywordGrouper, RareBucketer, ValueFilter
from beatline.plans.classification import OTHER, fit_codes
from beatline.schema import FEATURES_V2


def _indexer(codes: dict[str, float], col: str, out: str, unseen: str) -> StringIndexerModel:
    labels = sorted(codes, key=codes.get)
    return StringIndexerModel.from_labels(labels, inputCol=col, outputCol=out, handleInvalid=unseen)


def fit_feature_pipeline(rows: DataFrame, n_types: int = 10, n_locations: int = 50, other: str = OTHER,
                         key: str | None = "incident_key", unseen: str = "error") -> PipelineModel:
    """Fit on cleaned rows with the row features (``cleaned_features``, version 2;
    the description group may be missing, the pipeline makes it).

    ``unseen``: what becomes of a row whose group or bucketed place the fit has not
    seen ("error", "skip": it goes, "keep": a code after the last). Fitting on no
    rows gives a pipeline that keeps none.
    """
    codes = fit_codes(rows.withColumn("description_grouped", keyword_group("description")),
                      n_types, n_locations, other)
    fitted = collect_code_maps({
        "type": (codes.types, "primary_type", "label"),
        "description": (codes.descriptions, "description_grouped", "description_encoded"),
        "top": (codes.location_top.withColumn("_none", F.lit(None)), "location_description", "_none"),
        "location": (codes.locations, "location_description_clean", "location_encoded")})
    keep = [key] if key else []
    return PipelineModel([
        KeywordGrouper(inputCol="description", outputCol="description_grouped"),
        RareBucketer(inputCol="location_description", outputCol="location_description_clean",
                     values=sorted(fitted["top"]), other=other),
        ValueFilter(inputCol="primary_type", values=sorted(fitted["type"])),
        _indexer(fitted["description"], "description_grouped", "description_encoded", unseen),
        _indexer(fitted["location"], "location_description_clean", "location_encoded", unseen),
        _indexer(fitted["type"], "primary_type", "label", unseen),
        ColumnKeeper(names=[*keep, *FEATURES_V2, "label", "primary_type"]),
    ])
