"""Mergeable distinct counts (A10, approximate option).

A HyperLogLog sketch a group and column is kept as a binary value of bounded size.
Sketches of fine groups (months) are merged into those of coarse ones (years, the
whole city) without another look at the rows; exact counts can't be added up so.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the sketch's buckets: 4,096 of them, some 2 KB a full sketch.
LG_BUCKETS = 12


def relative_error(lg_buckets: int = LG_BUCKETS, deviations: float = 5.0) -> float:
    """The bound on the relative error that ``deviations`` standard deviations give."""
    return deviations * 1.04 / sqrt(1 << lg_buckets)


def distinct_sketches(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                      lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """One row a group of ``keys``: ``keys`` and a sketch of each column's distinct
    values, in a column of its name.

    A null value counts for nothing; a group with nulls only has an empty sketch. A
    null key is a group. Values are hashed as text, so every type can be counted. The
    sketches are built in the tasks before the shuffle, so a hot group costs one
    sketch a task.
    """
    return df.groupBy(*keys).agg(*[
        F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_buckets)).alias(c) for c in cols])


def merge_sketches(sketches: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Sketches of the coarser groups ``keys`` (none: one row for all)."""
    return sketches.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in cols])


def sketch_estimates(sketches: DataFrame, cols: Sequence[str], prefix: str = "approx_") -> DataFrame:
    """The sketches' columns replaced by estimates (bigint) named ``prefix`` + column."""
    keys = [c for c in sketches.columns if c not in cols]
    return sketches.select(*keys, *[
        F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).cast("bigint").alias(prefix + c) for c in cols])
