"""Plan-shape tests: the physical plans keep the properties the design relies
on (partial aggregation before shuffles, broadcast-only encoding joins,
filters in the scan, windows only on small inputs)."""

import re

from pyspark.sql import functions as F

from beatline.operators import panel
from beatline.operators.filters import drop_null_keys
from beatline.plans.classification import build_v2
from beatline.sources.fixture import fixture_incidents

from conftest import SF_SMALL


def _final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return plan


def _skewed_rows(spark, n=6000):
    # district 7 holds half of all rows
    rows = [(7 if i % 2 == 0 else i % 20, 2016, 1 + i % 12, i % 2, (i // 2) % 2, i % 24,
             int(i % 24 in (7, 8, 9)), int(i % 7 in (0, 6)), i % 50, i % 77, float(i % 5))
            for i in range(n)]
    return spark.createDataFrame(rows, "district int, year int, month int, arrest_int int, "
                                       "domestic_int int, hour_of_day int, is_rush_hour int, "
                                       "is_weekend int, ward int, community_area int, "
                                       "location_encoded double")


def test_panel_aggregates_partially_before_shuffle(spark):
    df = _skewed_rows(spark).repartition(8)
    agg = panel.panel_aggregate(df)
    plan = _final_plan(agg)
    assert "partial_count" in plan and "partial_sum" in plan
    # Buffers of fixed size only: no task sorts its rows for want of memory.
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    hot = agg.filter("district = 7").agg(F.sum("crime_count")).first()[0]
    assert hot == sum(1 for i in range(6000) if i % 2 == 0 or i % 20 == 7)


def test_panel_windows_share_one_exchange(spark):
    df = _skewed_rows(spark).repartition(8)
    plan = _final_plan(panel.add_history(panel.panel_aggregate(df)))
    # lag windows (district) and yoy window (district, month) need one exchange
    # by district after the aggregate, not two.
    assert len(re.findall(r"Exchange hashpartitioning\(district#\d+, \d+\)", plan)) == 1
    assert "hashpartitioning(district#" in plan and plan.count("Window [") == 2


def test_classification_rows_encode_without_joins(spark):
    rows = build_v2(fixture_incidents(spark, SF_SMALL), (1995, 2000)).rows
    plan = _final_plan(rows)
    assert "SortMergeJoin" not in plan
    # only the incident view's own two joins; the encoders are literals
    assert plan.count("BroadcastHashJoin") == 2
    assert re.search(r"PushedFilters: \[[^\]]*In\(p_brand", plan)  # top types reach the scan


def test_null_drop_reaches_scan(spark, tmp_dir):
    path = f"{tmp_dir}/n.parquet"
    spark.createDataFrame([(1, None), (None, 2), (3, 4)], "a int, b int").write.parquet(path)
    df = drop_null_keys(spark.read.parquet(path), ["a", "b"])
    plan = _final_plan(df)
    assert "PushedFilters: [IsNotNull(a), IsNotNull(b)]" in plan
    assert df.count() == 1
