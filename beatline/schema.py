"""Column names and schemas of the incident data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw incident table: one row per incident.
INCIDENT_SCHEMA = T.StructType([
    T.StructField("primary_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("location_description", T.StringType()),
    T.StructField("arrest", T.BooleanType()),
    T.StructField("domestic", T.BooleanType()),
    T.StructField("district", T.IntegerType()),
    T.StructField("ward", T.IntegerType()),
    T.StructField("community_area", T.IntegerType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

RAW_COLUMNS = ["primary_type", "description", "location_description",
               "arrest", "domestic", "district", "ward", "community_area"]
CALENDAR_COLUMNS = ["year", "month", "day_of_week", "hour_of_day"]
COORD_COLUMNS = ["latitude", "longitude"]

# Extract (D1): raw columns with the timestamp broken into calendar parts.
EXTRACT_COLUMNS = RAW_COLUMNS + CALENDAR_COLUMNS + COORD_COLUMNS

EXTRACT_SCHEMA = T.StructType(
    [f for f in INCIDENT_SCHEMA.fields if f.name in RAW_COLUMNS]
    + [T.StructField(c, T.IntegerType()) for c in CALENDAR_COLUMNS]
    + [f for f in INCIDENT_SCHEMA.fields if f.name in COORD_COLUMNS]
)

# Columns that must be present for a row to be kept (F4),
# in the order the cleaning steps list them.
KEYS_V1 = ["primary_type", "district", "year", "month",
           "day_of_week", "hour_of_day", "arrest", "domestic"]
KEYS_V2 = ["primary_type", "district", "ward", "community_area",
           "year", "month", "day_of_week", "hour_of_day",
           "arrest", "domestic", "location_description", "description"]

# Model feature lists, in model input order.
FEATURES_V1 = ["year", "month", "day_of_week", "hour_of_day",
               "district", "arrest_int", "domestic_int",
               "is_rush_hour", "is_weekend", "season"]
FEATURES_V2 = ["year", "month", "day_of_week", "hour_of_day",
               "district", "ward", "community_area",
               "arrest_int", "domestic_int",
               "is_rush_hour", "is_weekend", "season",
               "location_encoded", "description_encoded", "district_hour"]
PANEL_FEATURES = ["district", "year", "month", "season",
                  "arrest_rate", "domestic_rate",
                  "avg_hour", "rush_hour_rate", "weekend_rate",
                  "unique_wards", "unique_communities", "top_location",
                  "crime_count_lag1", "crime_count_lag2", "crime_count_lag3",
                  "rolling_avg_3m", "crime_count_yoy"]

# Null profile columns.
NULL_PROFILE_COLUMNS = ["primary_type", "date", "district", "latitude", "arrest"]
