"""Classification sets D3 (v2, 15 features) and D3' (v1, 10 features).

Plan shape (v2), two passes over the cleaned rows whatever the data size:

1. one hash aggregate (partial + final) of the cleaned rows by
   (location_description, description_grouped, primary_type) -> ``profile``,
   a table bounded by the product of the three domains, checkpointed to the
   shared folder (computed once; its readers do not rescan the input);
2. every list and code table (top types + label, top locations, location
   codes, description codes) is derived from ``profile`` and is bounded by
   construction (N types, N locations + 1, rule groups + 1); they are
   fetched together in one small job, like the labels of a fitted
   ``StringIndexerModel``;
3. the cleaned rows are encoded by a projection: ``primary_type IN (top
   types)`` (the semi join J1, pushed towards the scan) and literal map
   lookups for the label (M3) and the location and description codes - no
   join, no broadcast stage, no shuffle of the big side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.functions.text import group_names
from beatline.operators.encoders import (
    apply_code_table, collect_code_maps, frequency_code_table, map_lookup, top_n_keys,
)
from beatline.plans.features import cleaned_features
from beatline.schema import FEATURES_V1, FEATURES_V2
from beatline.session import checkpoint_small

OTHER = "OTHER"


@dataclass
class ClassificationSet:
    rows: DataFrame                    # features + label + primary_type (+ key)
    type_codes: DataFrame              # primary_type, n, label (top N, freq order)
    location_top: DataFrame | None     # location_description, n (top N)
    location_codes: DataFrame | None   # location_description_clean, n, location_encoded
    description_codes: DataFrame | None  # description_grouped, n, description_encoded
    cleaned: DataFrame                 # D2 (all cleaned rows with row features)


def _type_codes(counts_source: DataFrame, n_types: int, weight: str | None) -> DataFrame:
    top = top_n_keys(counts_source, "primary_type", n_types, weight=weight)
    return frequency_code_table(top, "primary_type", code_name="label", bound=n_types)


@dataclass
class CodeTables:
    types: DataFrame         # primary_type, n, label (top N, freq order)
    location_top: DataFrame | None  # location_description, n (top N)
    locations: DataFrame | None     # location_description_clean, n, location_encoded
    descriptions: DataFrame  # description_grouped, n, description_encoded


def fit_codes(d2: DataFrame, n_types: int = 10, n_locations: int = 50,
              other: str = OTHER, locations: bool = True) -> CodeTables:
    """Every list and code table, read off the profile of the cleaned rows;
    without ``locations`` those of types and descriptions only."""
    place = ["location_description"] if locations else []
    profile = checkpoint_small(
        d2.groupBy(*place, "description_grouped", "primary_type").agg(F.count(F.lit(1)).alias("n")))
    types = _type_codes(profile, n_types, "n")
    desc_codes = frequency_code_table(
        profile.groupBy("description_grouped").agg(F.sum("n").alias("n")),
        "description_grouped", code_name="description_encoded", bound=len(group_names()))
    if not locations:
        return CodeTables(types, None, None, desc_codes)
    loc_top = top_n_keys(profile, "location_description", n_locations, weight="n")

    # Location counts after bucketing: each profile row takes its clean value
    # from the top list.
    top_keys = loc_top.select(F.col("location_description").alias("_top"))
    loc_clean = (profile.join(top_keys, profile["location_description"] == F.col("_top"), "left")
                 .select(F.when(F.col("_top").isNotNull(), F.col("location_description"))
                         .otherwise(F.lit(other)).alias("location_description_clean"),
                         "n"))
    loc_codes = frequency_code_table(
        loc_clean.groupBy("location_description_clean").agg(F.sum("n").alias("n")),
        "location_description_clean", code_name="location_encoded", bound=n_locations + 1)
    return CodeTables(types, loc_top, loc_codes, desc_codes)


def build_v2(incidents: DataFrame, years: tuple[int, int] | None = None,
             n_types: int = 10, n_locations: int = 50, other: str = OTHER,
             key: str | None = "incident_key") -> ClassificationSet:
    d2 = cleaned_features(incidents, 2, years)
    codes = fit_codes(d2, n_types, n_locations, other)
    rows = encode_rows(d2, codes, n_types, n_locations, other)
    keep = ([key] if key and key in d2.columns else [])
    rows = rows.select(*keep, *FEATURES_V2, "label", "primary_type")
    return ClassificationSet(rows, codes.types, codes.location_top, codes.locations, codes.descriptions, d2)


#: Up to so many values, known from the parameters, codes are literals.
MOST_LITERALS = 2_000


def encode_rows(d2: DataFrame, codes: CodeTables, n_types: int, n_locations: int, other: str = OTHER) -> DataFrame:
    """The rows of the top types with ``label``, ``description_encoded`` and, if
    fitted, ``location_encoded``: by literal lookups, or by joins with the code
    tables where the parameters allow more than ``MOST_LITERALS`` values."""
    places = codes.locations is not None
    if n_types + 2 * n_locations * places + 1 > MOST_LITERALS:
        rows = apply_code_table(d2, codes.types, "primary_type", "label", bound=n_types)
        rows = apply_code_table(rows, codes.descriptions, "description_grouped", "description_encoded", how="left")
        if not places:
            return rows
        top = codes.location_top.withColumn("_clean", F.col("location_description"))
        rows = apply_code_table(rows, top, "location_description", "_clean", bound=n_locations, how="left")
        rows = rows.withColumn("_clean", F.coalesce("_clean", F.lit(other)))
        table = codes.locations.withColumnRenamed("location_description_clean", "_clean")
        return apply_code_table(rows, table, "_clean", "location_encoded", bound=n_locations + 1, how="left").drop("_clean")
    tables = {"type": (codes.types, "primary_type", "label"),
              "description": (codes.descriptions, "description_grouped", "description_encoded")}
    if places:
        tables["top"] = (codes.location_top.withColumn("_none", F.lit(None)), "location_description", "_none")
        tables["location"] = (codes.locations, "location_description_clean", "location_encoded")
    fitted = collect_code_maps(tables)
    rows = (d2.filter(F.col("primary_type").isin(list(fitted["type"])))
            .withColumn("label", map_lookup(fitted["type"], "primary_type"))
            .withColumn("description_encoded", map_lookup(fitted["description"], "description_grouped")))
    if not places:
        return rows
    clean = F.when(F.col("location_description").isin(list(fitted["top"])), F.col("location_description")).otherwise(F.lit(other))
    return rows.withColumn("location_encoded", map_lookup(fitted["location"], clean))


def build_v1(incidents: DataFrame, years: tuple[int, int] | None = None,
             n_types: int = 10, key: str | None = "incident_key") -> ClassificationSet:
    """v1: 8 key columns, 10 features; the saved values are unscaled."""
    d2 = cleaned_features(incidents, 1, years)
    types = _type_codes(d2, n_types, None)
    # A broadcast join with the (<= n_types rows) code table: AQE runs the
    # top-type pass and the scan of the rows concurrently.
    rows = apply_code_table(d2, types, "primary_type", "label", bound=n_types)
    keep = ([key] if key and key in d2.columns else [])
    rows = rows.select(*keep, *FEATURES_V1, "label", "primary_type")
    return ClassificationSet(rows, types, None, None, None, d2)


def alphabetical_labels(rows: DataFrame, col: str = "primary_type",
                        out: str = "label") -> DataFrame:
    """(value, label) with labels 0..k-1 in alphabetical order (M4)."""
    counts = rows.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return (frequency_code_table(counts, col, code_name=out, order="alphabetAsc")
            .select(col, F.col(out).cast("int").alias(out), "n"))
