"""Numbering all rows of a table in a global order, with no task that sees them all.

The rows are range-partitioned by the order, sorted inside the parts and written
with their place in the part; the parts' sizes (one number a part) give each part's
first place. A row's number is then a projection of what was written.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatline.session import materialize

#: ``monotonically_increasing_id`` keeps the row's place in its low bits.
_PLACE_BITS = 33


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number",
                      start: int = 1, total: str | None = None, parts: int | None = None) -> DataFrame:
    """``df`` with the bigint ``out``: the row's place in ``order``, from ``start``;
    with ``total`` also the number of all rows.

    ``parts`` ranges (default: the session's shuffle partitions) are cut by Spark's
    sampling. Rows equal in ``order`` fall into one range in any order, so give an
    order that tells rows apart. The ranges are written once to the shared folder: a
    task that runs again can't number rows otherwise. An empty table stays empty.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    written = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), "ranges")
    part = F.shiftright("_place", _PLACE_BITS)
    sizes = {r["part"]: r["n"] for r in written.groupBy(part.alias("part"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``n`` rows
    upto = list(accumulate((sizes.get(p, 0) for p in range(n)), initial=0))
    before = F.array(*[F.lit(x + start).cast("bigint") for x in upto[:-1]])
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    numbered = written.withColumn(out, F.get(before, part.cast("int")) + place)
    if total:
        numbered = numbered.withColumn(total, F.lit(upto[-1]).cast("bigint"))
    return numbered.drop("_place")
