"""Global numbering by ranges, mergeable distinct sketches."""

import math
import random

import pytest
from pyspark.sql import functions as F

from beatline.operators import encoders, explore, sketches
from beatline.operators.ranking import global_row_number


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_numbers_follow_the_order(spark, parts):
    rng = random.Random(parts)
    rows = [(rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    out = global_row_number(df, [F.col("a").desc(), F.col("b").asc()], "n", total="of", parts=parts)
    want = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [(r.a, r.b, r.n, r.of) for r in out.orderBy("n").collect()] == [
        (a, b, i + 1, 2000) for i, (a, b) in enumerate(want)]
    assert out.columns == ["a", "b", "n", "of"]


def test_numbers_of_ties_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None,), (None,), (2,), (2,), (1,)], "a int")
    out = global_row_number(df, [F.col("a").asc_nulls_last()], "n", start=0, parts=4).orderBy("n").collect()
    assert [(r.a, r.n) for r in out] == [(1, 0), (2, 1), (2, 2), (None, 3), (None, 4)]
    empty = global_row_number(df.filter("a > 9"), [F.col("a")], total="of")
    assert empty.count() == 0 and empty.columns == ["a", "row_number", "of"]


def test_general_encoders_have_no_window(spark):
    df = spark.createDataFrame([(f"v{i % 700}",) for i in range(3000)], "v string")
    counts = encoders.counts_of(df, "v")
    ranged = encoders.frequency_code_table(counts, "v")
    assert "Window" not in _plan(ranged)
    bounded = encoders.frequency_code_table(counts, "v", bound=700)
    assert sorted(map(tuple, ranged.collect())) == sorted(map(tuple, bounded.collect()))
    alpha = encoders.frequency_code_table(counts, "v", order="alphabetAsc")
    assert [r.v for r in alpha.orderBy("code").collect()] == sorted({f"v{i}" for i in range(700)})
    listed = explore.class_list(df, "v")
    assert "Window" not in _plan(listed)
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, explore.class_list(df, "v", bound=700).collect()))


def test_type_distribution_reuses_its_counts(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)], "primary_type string").repartition(3)
    out = explore.type_distribution(df, "primary_type", 2)
    assert [tuple(r) for r in out.collect()] == [("a", 3, 50.0), ("b", 2, 33.33)]
    assert "Window" not in _plan(out) and "ReusedExchange" in _plan(out)


def test_merged_sketches_equal_sketches_of_all_rows(spark):
    rows = [(i % 12, f"k{i * 7919 % 30011}", None if i % 3 else i % 5) for i in range(60000)]
    df = spark.createDataFrame(rows, "month int, key string, code int").repartition(6)
    months = sketches.distinct_sketches(df, ["month"], ["key", "code"])
    merged = sketches.sketch_estimates(sketches.merge_sketches(months, [], ["key", "code"]), ["key", "code"]).first()
    direct = sketches.sketch_estimates(sketches.distinct_sketches(df, [], ["key", "code"]), ["key", "code"]).first()
    exact = df.agg(F.countDistinct("key").alias("k"), F.countDistinct("code").alias("c")).first()
    assert merged.approx_code == exact.c == 5
    for got in (merged, direct):
        assert abs(got.approx_key - exact.k) <= sketches.relative_error() * exact.k
    sizes = months.select(F.max(F.octet_length("key")).alias("n")).first().n
    assert sizes < 1 << 13  # whatever the number of rows


def test_sketches_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (None, "x")], "g int, v string")
    got = sketches.sketch_estimates(sketches.distinct_sketches(df, ["g"], ["v"]), ["v"])
    assert {(r.g, r.approx_v) for r in got.collect()} == {(1, 0), (None, 1)}
    none = sketches.sketch_estimates(sketches.distinct_sketches(df.filter("g > 5"), [], ["v"]), ["v"])
    assert none.first().approx_v == 0
    assert math.isclose(sketches.relative_error(12, 1), 0.01625)
