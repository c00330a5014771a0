"""Monthly panel: positional history, rolling guard, year over year, mode."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from beatline.operators import panel


def _gap_series():
    rows = []
    for d in (1, 2):
        for y in (2015, 2016, 2017):
            for m in range(1, 13):
                if (d, y, m) in {(1, 2015, 4), (1, 2016, 7), (2, 2016, 1), (2, 2017, 12)}:
                    continue  # missing months shift positional lags
                rows.append((d, y, m, int(10 * d + y % 10 + m * 3 + (m * y) % 5)))
    return rows


def test_history_is_positional(spark):
    """Worked by hand: one district with a gap (no March 2015), two Januaries."""
    rows = [(1, 2015, 1, 10), (1, 2015, 2, 20), (1, 2015, 4, 60), (1, 2015, 5, 40),
            (1, 2016, 1, 50), (1, 2016, 4, 70), (2, 2015, 1, 7)]
    # district, year, month: lag1, lag2, lag3, mean of three, same month before
    want = {
        (1, 2015, 1): (None, None, None, None, None),
        (1, 2015, 2): (10, None, None, None, None),
        (1, 2015, 4): (20, 10, None, None, None),
        (1, 2015, 5): (60, 20, 10, 30.0, None),
        (1, 2016, 1): (40, 60, 20, 40.0, 10),
        (1, 2016, 4): (50, 40, 60, 50.0, 60),
        (2, 2015, 1): (None, None, None, None, None),
    }
    sdf = spark.createDataFrame(rows, "district int, year int, month int, crime_count long")
    got = {(r.district, r.year, r.month): (r.crime_count_lag1, r.crime_count_lag2, r.crime_count_lag3,
                                           r.rolling_avg_3m, r.crime_count_yoy)
           for r in panel.add_history(sdf).collect()}
    assert got == want


def test_drop_incomplete_removes_first_year(spark):
    rows = [(1, y, m, 5 + m) for y in (2015, 2016) for m in range(1, 13)]
    sdf = spark.createDataFrame(rows, "district int, year int, month int, crime_count long")
    hist = panel.add_history(sdf)
    from beatline.operators.filters import drop_incomplete
    kept = drop_incomplete(hist)
    assert kept.filter("year = 2015").count() == 0
    assert kept.count() == 12


def test_panel_aggregate_mode_ties_smallest(spark):
    rows = [(3, 2016, 5, 1, 0, 10, 1, 0, 4, 7, 2.0),
            (3, 2016, 5, 0, 1, 11, 0, 1, 4, 8, 1.0),
            (3, 2016, 5, 1, 1, 12, 1, 1, 5, 8, 2.0),
            (3, 2016, 5, 0, 0, 13, 0, 0, 5, 9, 1.0)]
    sdf = spark.createDataFrame(rows, "district int, year int, month int, arrest_int int, "
                                      "domestic_int int, hour_of_day int, is_rush_hour int, "
                                      "is_weekend int, ward int, community_area int, "
                                      "location_encoded double")
    r = panel.panel_aggregate(sdf).first()
    assert r.crime_count == 4 and r.top_location == 1.0  # 1.0 and 2.0 tie -> smaller
    assert r.unique_wards == 2 and r.unique_communities == 3
    assert r.arrest_rate == 0.5 and r.avg_hour == 11.5 and r.season == 2


def test_null_district_not_grouped(spark):
    rows = [(None, 2016, 5, 1, 0, 10, 1, 0, 4, 7, 2.0), (1, 2016, 5, 1, 0, 10, 1, 0, 4, 7, 2.0)]
    sdf = spark.createDataFrame(rows, "district int, year int, month int, arrest_int int, "
                                      "domestic_int int, hour_of_day int, is_rush_hour int, "
                                      "is_weekend int, ward int, community_area int, "
                                      "location_encoded double")
    assert panel.panel_aggregate(sdf).count() == 1


def test_monthly_counts_ordering(spark):
    rows = [(d, y, m, 1) for d in (2, 1) for y in (2016, 2015) for m in (3, 1)]
    sdf = spark.createDataFrame(rows, "district int, year int, month int, season int")
    got = [(r.year, r.month, r.district) for r in panel.monthly_counts(sdf).collect()]
    assert got == sorted(got)
    assert panel.monthly_counts(sdf).agg(F.sum("crime_count")).first()[0] == 8


def test_calendar_history_fills_gaps_with_null(spark):
    rows = _gap_series()
    sdf = spark.createDataFrame(rows, "district int, year int, month int, crime_count long")
    got = panel.add_history(sdf, calendar=True).toPandas()
    df = pd.DataFrame(rows, columns=["district", "year", "month", "crime_count"])
    lookup = {(d, y * 12 + m): c for d, y, m, c in rows}
    for r in got.itertuples():
        i = r.year * 12 + r.month
        for k in (1, 2, 3):
            want = lookup.get((r.district, i - k))
            v = getattr(r, f"crime_count_lag{k}")
            assert (want is None and pd.isna(v)) or v == want
        prev = [lookup.get((r.district, i - k)) for k in (1, 2, 3)]
        if None in prev:
            assert pd.isna(r.rolling_avg_3m)
        else:
            assert np.isclose(r.rolling_avg_3m, sum(prev) / 3)
        want = lookup.get((r.district, i - 12))
        assert (want is None and pd.isna(r.crime_count_yoy)) or r.crime_count_yoy == want
    assert len(df) == len(got)


def test_mode_of_large_codes(spark):
    rows = [(1, 2016, 1, 0, 0, 5, 0, 0, 1, 1, c) for c in (1100000.0, 1100000.0, 3.0)] + [
        (2, 2016, 1, 0, 0, 5, 0, 0, 1, 1, c) for c in (2.0 ** 40, 7.0, 2.0 ** 40, 7.0, -5.0)]
    df = spark.createDataFrame(rows, "district int, year int, month int, arrest_int int, domestic_int int, hour_of_day int, "
                                     "is_rush_hour int, is_weekend int, ward int, community_area int, location_encoded double")
    assert {r.district: r.top_location for r in panel.panel_aggregate(df).collect()} == {1: 1100000.0, 2: 7.0}
