"""District-by-month panel.

Plan: the incident rows are reduced in every task by hash aggregates with
buffers of fixed size (grouping sets of the group with each code column), so a
district holding a third of all rows costs a few hundred rows a task; a second
aggregate of those small results gives the panel. The
windows then run on the aggregated panel (districts x months rows), not on
incidents: one exchange by district serves both the lag windows and the
(district, month) year-over-year window, because hash partitioning by
district already clusters every (district, month).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions.calendar import season
from beatline.operators.filters import drop_incomplete


def monthly_counts(df: DataFrame, keys: Sequence[str] = ("district", "year", "month", "season"),
                   count_name: str = "crime_count") -> DataFrame:
    """Rows per (district, year, month, season), ordered by year, month,
    district (A7)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy("year", "month", "district"))


#: A count and a code, each of up to 19 digits, packed into one decimal.
_CODES = "CAST('10000000000000000000' AS DECIMAL(20,0))"
_LARGEST_CODE = "CAST('9223372036854775807' AS DECIMAL(19,0))"
_SUMS = ("arrest_int", "domestic_int", "hour_of_day", "is_rush_hour", "is_weekend")


def panel_aggregate(df: DataFrame, district: str = "district") -> DataFrame:
    """Per (district, year, month): counts, rates, distinct counts and the
    most frequent location code (A8-A11), plus the season (E9).

    Null group keys are dropped first (pandas ``groupby`` skips them). Two
    levels of hash aggregates with buffers of fixed size: grouping sets of the
    group with the ward, with the community area and with the location count
    rows and add up the rates' columns (a group is at most as many rows as the
    three code domains have values); the second level counts the wards and
    areas that occur and takes the location of the greatest count, ties to the
    least code (any whole number of 64 bits; another one is an error).
    """
    keyed = df.filter(F.col(district).isNotNull() & F.col("year").isNotNull()
                      & F.col("month").isNotNull())
    keys = [F.col(district), F.col("year"), F.col("month")]
    part = [F.col(c) for c in ("ward", "community_area", "location_encoded")]
    level = keyed.groupingSets([[*keys, p] for p in part], *keys, *part).agg(
        F.grouping_id(*keys, *part).alias("_set"), F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_{c}") for c in _SUMS], *[F.count(c).alias(f"_n_{c}") for c in _SUMS])
    ward, area, place = (F.col("_set") == g for g in (0b011, 0b101, 0b110))
    # A decimal keeps the buffer of the maximum at a fixed size (a struct would be sorted).
    code = F.col("location_encoded").cast("bigint")
    whole = F.when(code == F.col("location_encoded"), code).otherwise(F.raise_error(F.lit("a location code is not a whole number")))
    packed = (F.col("_n").cast("decimal(18,0)") * F.expr(_CODES)).cast("decimal(38,0)") + (
        F.expr(_LARGEST_CODE) - whole.cast("decimal(19,0)"))
    mean = lambda c: F.sum(F.when(place, F.col(f"_{c}"))) / F.sum(F.when(place, F.col(f"_n_{c}")))
    agg = level.groupBy(district, "year", "month").agg(
        F.sum(F.when(place, F.col("_n"))).alias("crime_count"),
        mean("arrest_int").alias("arrest_rate"),
        mean("domestic_int").alias("domestic_rate"),
        mean("hour_of_day").alias("avg_hour"),
        mean("is_rush_hour").alias("rush_hour_rate"),
        mean("is_weekend").alias("weekend_rate"),
        F.count(F.when(ward, F.col("ward"))).alias("unique_wards"),
        F.count(F.when(area, F.col("community_area"))).alias("unique_communities"),
        F.max(F.when(place & F.col("location_encoded").isNotNull(), packed.cast("decimal(38,0)"))).alias("_top"),
    )
    top = F.expr(_LARGEST_CODE) - F.col("_top") % F.expr(_CODES)
    agg = agg.withColumn("top_location", top.cast("bigint").cast(df.schema["location_encoded"].dataType)).drop("_top")
    return agg.withColumn("season", season("month", strict=True))


def add_history(panel: DataFrame, value: str = "crime_count", district: str = "district",
                lags: Sequence[int] = (1, 2, 3), window: int = 3,
                calendar: bool = False) -> DataFrame:
    """History per district in (year, month) order.

    Positional (default):

    * ``{value}_lag{k}``: the value ``k`` rows earlier (a missing month is
      not filled, so the lag is positional, not calendar);
    * ``rolling_avg_{window}m``: mean of the previous ``window`` rows, null
      unless all of them exist;
    * ``{value}_yoy``: the previous row of the same (district, month) in
      year order (the previous *available* year).

    ``calendar=True``: the same columns by month arithmetic - the value
    exactly ``k`` months (12 for year over year) before, null when that
    month is missing; the rolling mean needs all ``window`` previous
    calendar months. Range frames over a month index, no self-join.
    """
    if calendar:
        idx = F.col("year") * 12 + F.col("month")
        by_index = Window.partitionBy(district).orderBy(idx)
        at = lambda k: by_index.rangeBetween(-k, -k)
        prev = by_index.rangeBetween(-window, -1)
        cols = [F.first(value).over(at(k)).alias(f"{value}_lag{k}") for k in lags]
        cols.append(F.when(F.count(value).over(prev) == window,
                           F.avg(value).over(prev)).alias(f"rolling_avg_{window}m"))
        cols.append(F.first(value).over(at(12)).alias(f"{value}_yoy"))
        return panel.select("*", *cols)
    by_time = Window.partitionBy(district).orderBy("year", "month")
    prev = by_time.rowsBetween(-window, -1)
    same_month = Window.partitionBy(district, "month").orderBy("year")
    cols = [F.lag(value, k).over(by_time).alias(f"{value}_lag{k}") for k in lags]
    cols.append(F.when(F.count(value).over(prev) == window,
                       F.avg(value).over(prev)).alias(f"rolling_avg_{window}m"))
    cols.append(F.lag(value, 1).over(same_month).alias(f"{value}_yoy"))
    return panel.select("*", *cols)


def monthly_panel(df: DataFrame, drop_incomplete_rows: bool = True,
                  calendar: bool = False) -> DataFrame:
    """Aggregate, season, lags, guarded rolling mean, year over year,
    then rows with any null dropped (F5) - which removes each
    (district, month)'s first year."""
    panel = add_history(panel_aggregate(df), calendar=calendar)
    panel = panel.select("district", "year", "month", "season", "crime_count",
                         "arrest_rate", "domestic_rate", "avg_hour", "rush_hour_rate",
                         "weekend_rate", "unique_wards", "unique_communities",
                         "top_location", "crime_count_lag1", "crime_count_lag2",
                         "crime_count_lag3", "rolling_avg_3m", "crime_count_yoy")
    return drop_incomplete(panel) if drop_incomplete_rows else panel


def panel_summary(panel: DataFrame, value: str = "crime_count") -> DataFrame:
    """One row: rows, min, max and mean of the count."""
    return panel.agg(F.count(F.lit(1)).alias("panel_rows"),
                     F.min(value).alias(f"min_{value}"),
                     F.max(value).alias(f"max_{value}"),
                     F.avg(value).alias(f"mean_{value}"))
