"""Exploration aggregates.

Every aggregate here is a hash aggregate with a partial (map-side) step, so
a key holding a third of the rows is pre-reduced in each task before the
shuffle; only the small grouped result is sorted or windowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.functions.numeric import percent_of_count
from beatline.operators.encoders import BROADCAST_MAX_ROWS
from beatline.operators.ranking import global_row_number


def total_rows(df: DataFrame, name: str = "total_rows") -> DataFrame:
    """One row, one column: the row count (A1)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, col: str, n: int | None = None,
                 count_name: str = "count") -> DataFrame:
    """Frequency of each value, count descending, value ascending on ties
    (A3); with ``n`` only the first ``n`` rows (K5)."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    ordered = counts.orderBy(F.col(count_name).desc(), F.col(col).asc_nulls_last())
    return ordered.limit(n) if n is not None else ordered


def type_distribution(df: DataFrame, col: str = "primary_type", n: int = 20,
                      count_name: str = "count", pct_name: str = "pct") -> DataFrame:
    """Count and percent of all rows per value, top ``n``.

    The grand total is a scalar subquery over the same grouped counts, whose
    shuffle Spark reuses: a partial sum a task, no window over all values.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    total = counts.select(F.sum(count_name)).scalar()
    with_pct = counts.withColumn(pct_name, percent_of_count(count_name, total, 2))
    return (with_pct.orderBy(F.col(count_name).desc(), F.col(col).asc_nulls_last())
            .limit(n))


def yearly_district_counts(df: DataFrame, ts: str = "date", district: str = "district",
                           count_name: str = "crime_count") -> DataFrame:
    """Rows per (year, district), district not null, ordered (A5)."""
    return (df.filter(F.col(district).isNotNull())
            .groupBy(F.year(ts).alias("year"), F.col(district))
            .agg(F.count(F.lit(1)).alias(count_name))
            .orderBy("year", district))


def null_profile(df: DataFrame, cols: Sequence[str], prefix: str = "null_") -> DataFrame:
    """One row: number of nulls per column (A6), one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(prefix + c) for c in cols])


def stage_funnel(df: DataFrame, stages: Sequence[tuple[str, object]]) -> DataFrame:
    """Rows surviving each stage of a filter chain, in one pass (A2).

    ``stages`` is a list of (name, condition); a row reaches stage ``i`` when
    conditions ``0..i`` hold (a ``None`` condition keeps every row). Output:
    (step, stage, rows).
    """
    aggs = []
    acc = None
    for i, (name, cond) in enumerate(stages):
        if cond is not None:
            acc = cond if acc is None else (acc & cond)
        expr = F.count(F.lit(1)) if acc is None else F.count_if(acc)
        aggs.append(expr.alias(f"s{i}"))
    one_row = df.agg(*aggs)
    stack = ", ".join(f"{i}, '{name}', s{i}" for i, (name, _) in enumerate(stages))
    return one_row.selectExpr(
        f"stack({len(stages)}, {stack}) AS (step, stage, rows)"
    ).select(F.col("step").cast("int"), "stage", F.col("rows").cast("bigint"))


def class_list(df: DataFrame, col: str = "primary_type", bound: int | None = None) -> DataFrame:
    """Sorted distinct classes with their 0-based position and the class
    count (A12). Up to a proven ``bound`` of ``BROADCAST_MAX_ROWS`` classes they
    are numbered by one window, else by ranges."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    if bound is None or bound > BROADCAST_MAX_ROWS:
        ranked = global_row_number(distinct, [F.col(col)], "class_index", start=0, total="num_classes")
        return ranked.withColumn("class_index", F.col("class_index").cast("int"))
    w = Window.orderBy(col)
    return (distinct.withColumn("class_index", (F.row_number().over(w) - 1).cast("int"))
            .withColumn("num_classes", F.count(F.lit(1)).over(Window.partitionBy())))
