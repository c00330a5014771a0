"""Row filters and samplers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hex digits of the md5 prefix used as a uniform number in [0, 1).
_HASH_DIGITS = 8


def require_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep rows where every column in ``cols`` is not null (F2)."""
    cond = None
    for c in cols:
        part = F.col(c).isNotNull()
        cond = part if cond is None else cond & part
    return df.filter(cond) if cond is not None else df


def year_between(df: DataFrame, lo: int, hi: int, ts: str = "date") -> DataFrame:
    """Rows whose timestamp falls in years ``lo..hi`` inclusive.

    Written as a range on the raw column, not ``year(ts) BETWEEN``, so the
    bounds reach the Parquet scan as pushed filters and row-group statistics
    skip data outside the range.
    """
    dtype = df.schema[ts].dataType
    start = F.lit(f"{lo:04d}-01-01 00:00:00").cast(dtype)
    stop = F.lit(f"{hi + 1:04d}-01-01 00:00:00").cast(dtype)
    return df.filter((F.col(ts) >= start) & (F.col(ts) < stop))


def _present(df: DataFrame, c: str) -> Column:
    """Not null, and not NaN for floating columns (``na.drop`` semantics)."""
    cond = F.col(c).isNotNull()
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        cond = cond & ~F.isnan(c)
    return cond


def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null (or NaN) in any of ``cols``.

    Same rows as ``df.na.drop(subset=cols)``, but written as a conjunction
    of per-column predicates: ``na.drop`` is one ``AtLeastNNonNulls``
    expression over all columns, which Catalyst cannot split, so it cannot
    push the parts to the scans (it ends up as a join condition evaluated
    after the join). Separate ``IS NOT NULL`` terms reach each side's scan.
    """
    cond = None
    for c in cols:
        part = _present(df, c)
        cond = part if cond is None else cond & part
    return df.filter(cond) if cond is not None else df


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return drop_null_keys(df, df.columns)


def row_identity(df: DataFrame, key: str) -> Column:
    """The key as text; for a row without one the texts of its other string,
    whole-number and boolean columns, so that such rows are told apart (rows equal
    in all of them are not)."""
    plain = (T.StringType, T.BooleanType, T.IntegralType)
    rest = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in df.schema.fields
            if f.name != key and isinstance(f.dataType, plain)]
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("|"), F.concat_ws("|", *rest)))


def row_hash(key, seed: int = 42) -> Column:
    """Hex md5 of ``seed|key``: a repeatable per-row random string.

    Identical in Spark and DuckDB, and stable under re-execution (a retried
    task draws the same rows, unlike ``rand()``). A null key hashes like an
    empty one, so no row is lost for it.
    """
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))


def hash_threshold(p: float) -> str:
    """Hex prefix ``t`` such that ``prefix < t`` holds for a fraction ``p``."""
    if p <= 0:
        return "0" * _HASH_DIGITS
    if p >= 1:
        return "g"  # above every hex digit
    return format(math.ceil(p * 16 ** _HASH_DIGITS), f"0{_HASH_DIGITS}x")


def hash_below(key, p: float, seed: int = 42) -> Column:
    """True for a repeatable Bernoulli(p) subset of rows."""
    return F.substring(row_hash(key, seed), 1, _HASH_DIGITS) < F.lit(hash_threshold(p))


def sample_fraction(df: DataFrame, p: float = 0.05, seed: int = 42,
                    key: str | None = "incident_key") -> DataFrame:
    """Bernoulli row sample.

    With a key the sample is a hash threshold: a per-row filter, no shuffle,
    the same rows on every run and in SQL; rows whose key is null are drawn by
    their other columns (``row_identity``). Without one, ``df.sample``.
    """
    if key is None:
        return df.sample(withReplacement=False, fraction=p, seed=seed)
    return df.filter(hash_below(row_identity(df, key), p, seed))


def shuffled_cap(df: DataFrame, n: int, seed: int = 42,
                 key: str = "incident_key", order_seed: int | None = None) -> DataFrame:
    """At most ``n`` rows in random order (F7): ``ORDER BY rand() LIMIT n``.

    The order is a per-row hash, so it is repeatable, and one plan at every
    size: each task keeps its own first ``n`` rows and only those are merged
    (TakeOrderedAndProject; a sort where ``n`` exceeds Spark's top-k limit).
    Rows with a null key take part like others, by their other columns.
    """
    order = row_hash(row_identity(df, key), seed if order_seed is None else order_seed)
    return df.orderBy(order, F.col(key)).limit(n)


def cap(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` rows, which ones unspecified (F8)."""
    return df.limit(n)


def chronological_split(df: DataFrame, col: str = "year", cut: int = 2021
                        ) -> tuple[DataFrame, DataFrame]:
    """(rows with ``col <= cut``, all others) (F10). A row without a year is
    in the second part, so the parts add up to the input."""
    early = F.coalesce(F.col(col) <= cut, F.lit(False))
    return df.filter(early), df.filter(~early)


def with_split_flag(df: DataFrame, col: str = "year", cut: int = 2021,
                    name: str = "split") -> DataFrame:
    """One frame with ``split`` = 'train' / 'test' by the year cut."""
    return df.withColumn(name, F.when(F.col(col) <= cut, "train").otherwise("test"))
