"""Top-N lists, rare-value buckets and frequency encoders.

Encoders are fitted as small *code tables* (value -> code) computed from a
grouped count, then applied with a join, or - for tables bounded by
construction - fetched once and applied as literals (``collect_code_maps``,
``map_lookup``). Every table that is broadcast is bounded by construction (a
top-N list, or a fixed rule list); a table with no static bound is joined
without a hint so AQE broadcasts it only when its measured size is small and
keeps the shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatline.operators.ranking import global_row_number

# Largest table that is hinted for broadcast when its row bound is known.
BROADCAST_MAX_ROWS = 100_000


def _maybe_broadcast(table: DataFrame, bound: int | None) -> DataFrame:
    if bound is not None and bound <= BROADCAST_MAX_ROWS:
        return F.broadcast(table)
    return table


def counts_of(df: DataFrame, col: str, count_name: str = "n",
              weight: str | None = None) -> DataFrame:
    """Rows (or summed ``weight``) per value of ``col``."""
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(col).agg(agg.cast("bigint").alias(count_name))


def top_n_keys(df: DataFrame, col: str, n: int, count_name: str = "n",
               weight: str | None = None, rank_name: str | None = None) -> DataFrame:
    """The ``n`` most frequent values, ties broken by value ascending (K2).

    ``orderBy.limit`` plans as TakeOrderedAndProject over the grouped rows,
    so no full sort. With ``weight``, counts are sums of that column (for
    pre-aggregated input). ``rank_name`` adds the 0-based rank.
    """
    top = (counts_of(df, col, count_name, weight).where(F.col(col).isNotNull())
           .orderBy(F.col(count_name).desc(), F.col(col).asc()).limit(n))
    if rank_name:
        by = [F.col(count_name).desc(), F.col(col).asc()]
        if n <= BROADCAST_MAX_ROWS:
            return top.withColumn(rank_name, (F.row_number().over(Window.orderBy(*by)) - 1).cast("int"))
        top = global_row_number(top, by, rank_name, start=0).withColumn(rank_name, F.col(rank_name).cast("int"))
    return top


def keep_top_n(df: DataFrame, col: str, n: int, counts_from: DataFrame | None = None,
               weight: str | None = None) -> DataFrame:
    """Rows whose ``col`` is among the ``n`` most frequent values.

    A left-semi join against the broadcast top list (at most ``n`` rows).
    ``counts_from`` ranks on another (e.g. pre-aggregated) frame.
    """
    top = top_n_keys(counts_from if counts_from is not None else df, col, n,
                     weight=weight).select(col)
    return df.join(_maybe_broadcast(top, n), on=col, how="left_semi")


def bucket_rare(df: DataFrame, col: str, n: int, out: str | None = None,
                other: str = "OTHER", counts_from: DataFrame | None = None,
                weight: str | None = None) -> DataFrame:
    """Keep the ``n`` most frequent values of ``col``; others become
    ``other`` (K3). A real value equal to ``other`` merges with the bucket.

    Broadcast left join on the top list, no driver collect.
    """
    out = out or f"{col}_clean"
    top = (top_n_keys(counts_from if counts_from is not None else df, col, n,
                      weight=weight)
           .select(F.col(col).alias("_top_value")))
    joined = df.join(_maybe_broadcast(top, n), df[col] == F.col("_top_value"), "left")
    return (joined.withColumn(out, F.when(F.col("_top_value").isNotNull(), F.col(col))
                              .otherwise(F.lit(other)))
            .drop("_top_value"))


def frequency_code_table(counts: DataFrame, col: str, count_name: str = "n",
                         code_name: str = "code", order: str = "frequencyDesc",
                         bound: int | None = None) -> DataFrame:
    """(value, count, code) from a grouped count (M1-M4).

    ``frequencyDesc``: most frequent value gets 0.0, ties alphabetical (as
    ``StringIndexer``). ``alphabetAsc``: codes by value. Codes are doubles,
    as ``StringIndexer`` emits. ``bound``: a proven upper bound on the distinct
    values; up to ``BROADCAST_MAX_ROWS`` of them are numbered by one window,
    else by ranges (``global_row_number``), so no task sees all values.
    """
    if order == "frequencyDesc":
        by = [F.col(count_name).desc(), F.col(col).asc()]
    elif order == "alphabetAsc":
        by = [F.col(col).asc()]
    else:
        raise ValueError(f"unsupported order {order!r}")
    present = counts.where(F.col(col).isNotNull())
    if bound is not None and bound <= BROADCAST_MAX_ROWS:
        return present.withColumn(code_name, (F.row_number().over(Window.orderBy(*by)) - 1).cast("double"))
    return global_row_number(present, by, code_name, start=0).withColumn(code_name, F.col(code_name).cast("double"))


def apply_code_table(df: DataFrame, table: DataFrame, col: str, code_name: str,
                     out: str | None = None, bound: int | None = None,
                     how: str = "inner") -> DataFrame:
    """Attach ``code_name`` from ``table`` to ``df`` by ``col``.

    ``bound`` is a proven upper bound on the table's rows; only then is the
    table hinted for broadcast. ``how="inner"`` drops values the encoder has
    not seen (``handleInvalid="skip"``); ``"left"`` keeps them with null.
    """
    small = table.select(F.col(col).alias("_code_key"),
                         F.col(code_name).alias(out or code_name))
    joined = df.join(_maybe_broadcast(small, bound), df[col] == F.col("_code_key"), how)
    return joined.drop("_code_key")


def fit_string_indexer(df: DataFrame, cols: list[str], outs: list[str],
                       order: str = "frequencyDesc") -> StringIndexerModel:
    """A Spark ML ``StringIndexer`` over several columns in one pass.

    For callers who want a saved ``Model`` inside an ML ``Pipeline``; it
    gathers each column's distinct values on the driver, so use it on
    columns already bounded (bucketed or grouped).
    """
    return StringIndexer(inputCols=cols, outputCols=outs,
                         stringOrderType=order, handleInvalid="error").fit(df)


def collect_code_maps(tables: dict[str, tuple[DataFrame, str, str]],
                      max_rows: int = BROADCAST_MAX_ROWS) -> dict[str, dict]:
    """Fetch several small code tables in one job: ``{name: {value: code}}``.

    The fitted encoder is then a set of literals, as a ``StringIndexerModel``
    keeps its labels on the driver: applying it is a projection (``isin``
    filters that reach the scan, map lookups inside codegen), with no join
    and no broadcast stage. Only for tables bounded by construction; a table
    over ``max_rows`` rows is refused.
    """
    parts = [t.select(F.lit(name).alias("_kind"), F.col(v).cast("string").alias("_value"),
                      F.col(c).cast("double").alias("_code"))
             for name, (t, v, c) in tables.items()]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    rows = union.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"code tables exceed {max_rows} rows; join them instead")
    out: dict[str, dict] = {name: {} for name in tables}
    for r in rows:
        out[r["_kind"]][r["_value"]] = r["_code"]
    return out


def map_lookup(codes: dict, col) -> Column:
    """Literal map lookup ``codes[col]``; a missing key gives null."""
    col = F.col(col) if isinstance(col, str) else col
    if not codes:
        return F.lit(None).cast("double")
    pairs = []
    for k, v in codes.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[col]
