"""Stratified split and class weights.

The exact split never ranks a whole class in one task. Each row gets a
repeatable hash; a histogram of (class, hash bucket) counts (at most
classes x 4,096 rows, computed with partial aggregation) locates, per class,
the bucket where the class's test quota is reached. Only the rows *in* that
bucket (about 1/4,096 of the class) are ranked, to find the class's cutoff:
the hash and key of its last test row. A row is then a test row if its (hash,
key) is at most its class's cutoff: one projection, in which nothing is ranked.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatline.operators.filters import hash_below, row_hash
from beatline.session import materialize

# Hash buckets for the exact split: first 3 hex digits of the row hash.
SPLIT_BUCKET_DIGITS = 3
# A table of one row per class is broadcast by hint up to this stated bound.
MOST_CLASSES = 10_000


def _hinted(table: DataFrame, bound: int | None) -> DataFrame:
    return F.broadcast(table) if bound is not None and bound <= MOST_CLASSES else table


def _quotas(class_counts: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """Per class test quota: ``ceil(f * n)`` test rows shared over classes
    by largest remainder, ties to the smaller class value (as a stratified
    shuffle split allocates). Runs on the class-count table only."""
    everything = Window.partitionBy()
    dec = "decimal(38,0)"
    c = (class_counts
         .withColumn("_n", F.sum("n_c").over(everything))
         .withColumn("_n_test", F.ceil(F.lit(float(test_fraction)) * F.col("_n"))
                     .cast("bigint")))
    prod = F.col("_n_test").cast(dec) * F.col("n_c").cast(dec)
    c = (c.withColumn("_rem", prod % F.col("_n").cast(dec))
         .withColumn("_base", ((prod - F.col("_rem")) / F.col("_n").cast(dec)).cast("bigint")))
    c = c.withColumn("_left", F.col("_n_test") - F.sum("_base").over(everything))
    by_rem = Window.orderBy(F.col("_rem").desc(), F.col(label).asc())
    c = c.withColumn("quota", F.col("_base")
                     + F.when(F.row_number().over(by_rem) <= F.col("_left"), 1).otherwise(0))
    return c.select(label, "n_c", F.col("quota").cast("bigint"))


def split_cutoffs(df: DataFrame, label: str = "label", key: str = "incident_key",
                  test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """One row per class: ``label``, ``n_c`` rows, ``n_test`` of them in the test
    part, and the cutoff (``cut_hash``, ``cut_key``) of its last test row.

    Two passes over (label, key): the histogram, and the rows of the boundary
    buckets. The table is written once. A null label is a class; a null key
    counts as an empty one. Rows that share a key fall in one part together,
    so a class whose keys repeat can exceed its quota by the repeats of its
    cutoff key; ``n_test`` counts what falls in the part.
    """
    x = df.select(F.col(label), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_k"),
                  row_hash(key, seed).alias("_h"))
    x = x.withColumn("_b", F.conv(F.substring("_h", 1, SPLIT_BUCKET_DIGITS), 16, 10).cast("int"))
    hist = x.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    quotas = _quotas(hist.groupBy(label).agg(F.sum("_nb").alias("n_c")), label, test_fraction)
    cum = F.sum("_nb").over(Window.partitionBy(label).orderBy("_b")
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    q = quotas.withColumnRenamed(label, "_l")
    h = hist.withColumn("_cum", cum)
    marked = materialize(
        q.join(h, h[label].eqNullSafe(q["_l"])
               & (h["_cum"] - h["_nb"] < q["quota"]) & (q["quota"] <= h["_cum"]), "left")
        .select("_l", "n_c", "quota", F.col("_b").alias("_bstar"),
                (F.col("_cum") - F.col("_nb")).alias("_below")), "split-quotas")
    m = marked.filter("quota > 0")
    rank = Window.partitionBy("_l").orderBy("_h", "_k")
    edge = x.join(m, x[label].eqNullSafe(m["_l"]) & (x["_b"] == m["_bstar"]))
    # The last of the first ``quota - below`` rows gives the cutoff; rows equal
    # to it count too.
    place = F.row_number().over(rank)
    cut = (edge.withColumn("_place", place).withColumn("_last", F.max("_place").over(
        Window.partitionBy("_l", "_h", "_k")))
        .filter(F.col("_place") == F.col("quota") - F.col("_below"))
        .select("_l", F.col("_h").alias("cut_hash"), F.col("_k").alias("cut_key"),
                (F.col("_below") + F.col("_last")).alias("n_test")).withColumnRenamed("_l", "_c"))
    out = marked.join(cut, marked["_l"].eqNullSafe(cut["_c"]), "left").select(
        F.col("_l").alias(label), "n_c", F.coalesce("n_test", F.lit(0)).cast("bigint").alias("n_test"),
        "cut_hash", "cut_key")
    return materialize(out, "split-cutoffs")


def with_test_flag(df: DataFrame, cutoffs: DataFrame, label: str = "label",
                   key: str = "incident_key", seed: int = 42, out: str = "is_test",
                   class_bound: int | None = None) -> DataFrame:
    """Add boolean ``out``: the row's (hash, key) is at most its class's cutoff."""
    c = _hinted(cutoffs.select(F.col(label).alias("_l"), "cut_hash", "cut_key"), class_bound)
    h, k = row_hash(key, seed), F.coalesce(F.col(key).cast("string"), F.lit(""))
    test = (h < F.col("cut_hash")) | ((h == F.col("cut_hash")) & (k <= F.col("cut_key")))
    return (df.join(c, df[label].eqNullSafe(c["_l"]), "left")
            .withColumn(out, F.coalesce(test, F.lit(False))).drop("_l", "cut_hash", "cut_key"))


def stratified_split(df: DataFrame, label: str = "label", key: str = "incident_key",
                     test_fraction: float = 0.2, seed: int = 42, method: str = "exact",
                     out: str = "is_test", class_bound: int | None = None) -> DataFrame:
    """Add boolean ``out``: the row is in the test part (P1, W5). Every input
    row is returned once.

    ``method="exact"``: every class contributes exactly its quota (largest
    remainder of ``ceil(f * n)``), rows chosen by smallest hash of ``key``.
    ``class_bound`` (a proven bound on the number of classes, e.g. N of a
    top-N filter) lets the per-class table be broadcast by hint if it is at most
    ``MOST_CLASSES``; without it AQE decides from the measured size.
    ``method="hash"``: each row independently by hash threshold; no shuffle,
    class shares are ``f`` in expectation.
    """
    if method == "hash":
        return df.withColumn(out, hash_below(key, test_fraction, seed))
    if method != "exact":
        raise ValueError(f"unknown method {method!r}")
    cutoffs = split_cutoffs(df, label, key, test_fraction, seed)
    return with_test_flag(df, cutoffs, label, key, seed, out, class_bound)


def class_weights(train: DataFrame, label: str = "label", num_classes: int | None = None,
                  name_col: str | None = None) -> DataFrame:
    """Balanced weight per class: ``n / (k * n_c)`` over the train rows (P2,
    P4). ``k`` defaults to the number of classes present."""
    keys = [label] + ([name_col] if name_col else [])
    counts = train.groupBy(*keys).agg(F.count(F.lit(1)).alias("train_count"))
    everything = Window.partitionBy()
    k = F.lit(num_classes) if num_classes else F.count(F.lit(1)).over(everything)
    n = F.sum("train_count").over(everything)
    return counts.withColumn("weight", n / (k * F.col("train_count")))


def cutoff_weights(cutoffs: DataFrame, label: str = "label",
                   num_classes: int | None = None) -> DataFrame:
    """The class weights of the train part, read off the cutoff table: no pass
    over the rows, as ``train_count = n_c - n_test``."""
    counts = cutoffs.select(label, (F.col("n_c") - F.col("n_test")).alias("train_count")) \
        .filter("train_count > 0")
    everything = Window.partitionBy()
    k = F.lit(num_classes) if num_classes else F.count(F.lit(1)).over(everything)
    n = F.sum("train_count").over(everything)
    return counts.withColumn("weight", n / (k * F.col("train_count")))


def with_class_weights(df: DataFrame, weights: DataFrame, label: str = "label",
                       out: str = "weight", bound: int | None = None) -> DataFrame:
    """Attach each row's class weight (J2, P3): a join on the label with the
    one-row-per-class weight table, broadcast when ``bound`` is given and at most
    ``MOST_CLASSES``. A row of a class without a weight keeps a null one."""
    w = weights.select(F.col(label).alias("_wl"), F.col("weight").alias(out))
    w = _hinted(w, bound)
    base = df.drop(out) if out in df.columns else df
    return base.join(w, base[label].eqNullSafe(w["_wl"]), "left").drop("_wl")
