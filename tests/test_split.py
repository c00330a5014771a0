"""Stratified split and class weights."""

import math

from pyspark.sql import functions as F

from beatline.operators import split
from beatline.operators.filters import row_hash


def _classes(spark, counts=(900, 90, 10)):
    rows = [(f"k{c}-{i}", c) for c, n in enumerate(counts) for i in range(n)]
    return spark.createDataFrame(rows, "key string, label int")


def _largest_remainder(counts, frac):
    n = sum(counts)
    n_test = math.ceil(frac * n)
    base = [n_test * c // n for c in counts]
    rem = [n_test * c % n for c in counts]
    left = n_test - sum(base)
    order = sorted(range(len(counts)), key=lambda i: (-rem[i], i))
    for i in order[:left]:
        base[i] += 1
    return base


def test_exact_split_quotas_and_partition(spark):
    counts = (900, 90, 10)
    df = _classes(spark, counts)
    out = split.stratified_split(df, "label", "key", 0.2, 42, class_bound=3)
    got = {r.label: r.t for r in out.groupBy("label").agg(
        F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert [got[i] for i in range(3)] == _largest_remainder(counts, 0.2)
    assert out.count() == df.count()
    assert out.select("key").distinct().count() == df.count()


def test_exact_split_picks_smallest_hashes(spark):
    df = _classes(spark, (57, 33, 11))
    out = split.stratified_split(df, "label", "key", 0.3, 7)
    quotas = _largest_remainder((57, 33, 11), 0.3)
    hashed = df.withColumn("h", row_hash("key", 7)).collect()
    for c in range(3):
        keys = sorted((r.h, r.key) for r in hashed if r.label == c)
        want = {k for _, k in keys[:quotas[c]]}
        got = {r.key for r in out.filter(f"label = {c} AND is_test").collect()}
        assert got == want


def test_hash_split_is_close(spark):
    df = _classes(spark, (5000, 5000))
    out = split.stratified_split(df, "label", "key", 0.2, 42, method="hash")
    frac = out.filter("is_test").count() / 10000
    assert abs(frac - 0.2) < 0.02


def test_class_weights_balance(spark):
    df = _classes(spark, (90, 9, 1))
    w = split.class_weights(df, "label", 3).collect()
    total = sum(r.weight * r.train_count for r in w)
    assert abs(total - 100) < 1e-9
    by = {r.label: r.weight for r in w}
    assert abs(by[2] - 100 / 3) < 1e-12 and abs(by[0] - 100 / 270) < 1e-12
    rows = split.with_class_weights(df, spark.createDataFrame(
        [(r.label, r.weight) for r in w], "label int, weight double"), bound=3)
    assert abs(rows.agg(F.sum("weight")).first()[0] - 100) < 1e-9


def test_no_row_is_lost_for_a_null_key_or_label(spark):
    rows = [(None if i % 10 == 0 else f"k{i}", None if i % 7 == 0 else i % 3) for i in range(1000)]
    df = spark.createDataFrame(rows, "key string, label int")
    for method in ("exact", "hash"):
        out = split.stratified_split(df, "label", "key", 0.2, 42, method=method)
        assert out.count() == 1000 and out.filter("is_test is null").count() == 0
        assert out.filter("key is null").count() == 100 and out.filter("label is null").count() == 143


def test_cutoffs_count_what_the_flag_marks(spark):
    df = _classes(spark, (57, 33, 11)).unionByName(_classes(spark, (20, 3, 1)))  # keys that repeat
    cut = split.split_cutoffs(df, "label", "key", 0.3, 7)
    out = split.with_test_flag(df, cut, "label", "key", 7)
    marked = {r.label: r.n for r in out.filter("is_test").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert {r.label: r.n_test for r in cut.collect() if r.n_test} == marked
    weights = {r.label: r.weight for r in split.cutoff_weights(cut, "label", 3).collect()}
    counted = {r.label: r.weight for r in split.class_weights(out.filter("not is_test"), "label", 3).collect()}
    assert weights == counted


def test_a_row_without_a_weight_is_kept(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (9, "c")], "label int, key string")
    w = spark.createDataFrame([(1, 0.5)], "label int, weight double")
    assert {r.key: r.weight for r in split.with_class_weights(df, w).collect()} == {"a": 0.5, "b": None, "c": None}
