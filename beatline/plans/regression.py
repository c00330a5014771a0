"""Monthly panel and regression evaluation frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.operators.filters import with_split_flag
from beatline.operators.panel import monthly_panel
from beatline.plans.classification import build_v2
from beatline.session import checkpoint_small

# Naive forecasts read off the panel's own history columns.
BASELINES = [("rolling_mean", "rolling_avg_3m"),
             ("last_month", "crime_count_lag1"),
             ("last_year", "crime_count_yoy")]


def panel_from_incidents(incidents: DataFrame, years: tuple[int, int] | None = None,
                         n_types: int = 10, n_locations: int = 50) -> DataFrame:
    """D5 over the classification set (top types only, as the panel is
    built from the saved classification rows).

    The panel has one row per district and month, so it is small at any
    input size; it is checkpointed to the shared folder because its
    consumers (split, scaler fit and apply, metrics) would otherwise each
    replay the whole incident plan.
    """
    cs = build_v2(incidents, years, n_types, n_locations)
    return checkpoint_small(monthly_panel(cs.rows))


def baseline_predictions(panel: DataFrame, cut: int, target: str = "crime_count") -> DataFrame:
    """Long frame (model, district, year, month, actual, predicted) for the
    test years (``year > cut``), one row per panel row and baseline, built by
    one ``stack`` projection (a single pass over the panel)."""
    test = with_split_flag(panel, "year", cut).filter(F.col("split") == "test")
    arms = ", ".join(f"'{name}', CAST({col} AS DOUBLE)" for name, col in BASELINES)
    return test.selectExpr(
        "district", "year", "month", f"CAST({target} AS DOUBLE) AS actual",
        f"stack({len(BASELINES)}, {arms}) AS (model, predicted)",
    ).select("model", "district", "year", "month", "actual", "predicted")
