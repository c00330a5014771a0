"""Extract, clean and row features.

Everything here is a projection or a filter: no shuffle, one codegen stage
per scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from beatline.functions import calendar as cal
from beatline.functions.text import keyword_group
from beatline.operators.filters import drop_null_keys, require_not_null, year_between
from beatline.schema import COORD_COLUMNS, KEYS_V1, KEYS_V2, RAW_COLUMNS


def extract_incidents(incidents: DataFrame, years: tuple[int, int] | None = None,
                      ts: str = "date", carry: Sequence[str] = ("incident_key",)
                      ) -> DataFrame:
    """Rows with a timestamp, type and district, in the year range if one
    is given, the timestamp replaced by year, month, day_of_week, hour_of_day.

    ``carry`` columns (an identifier) are kept in front when present.
    """
    df = require_not_null(incidents, [ts, "primary_type", "district"])
    if years is not None:
        df = year_between(df, years[0], years[1], ts)
    keep = [c for c in carry if c in incidents.columns]
    return df.select(*keep, *RAW_COLUMNS, *cal.calendar_parts(ts), *COORD_COLUMNS)


def clean(extract: DataFrame, version: int = 2) -> DataFrame:
    """Drop rows with a null in any key column: 8 columns (v1) or 12 (v2)."""
    return drop_null_keys(extract, KEYS_V1 if version == 1 else KEYS_V2)


def add_row_features(df: DataFrame, version: int = 2) -> DataFrame:
    """Flags, season and (v2) the district-hour code and description group."""
    cols = [
        cal.as_flag("arrest").alias("arrest_int"),
        cal.as_flag("domestic").alias("domestic_int"),
        cal.is_rush_hour("hour_of_day").alias("is_rush_hour"),
        cal.is_weekend("day_of_week").alias("is_weekend"),
        cal.season("month").alias("season"),
    ]
    if version >= 2:
        cols += [
            cal.district_hour("district", "hour_of_day").alias("district_hour"),
            keyword_group("description").alias("description_grouped"),
        ]
    return df.select("*", *cols)


def cleaned_features(incidents: DataFrame, version: int = 2,
                     years: tuple[int, int] | None = None) -> DataFrame:
    """Extract -> clean -> row features."""
    return add_row_features(clean(extract_incidents(incidents, years), version), version)
