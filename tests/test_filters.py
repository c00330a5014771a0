"""Filters and samplers."""

import math

from pyspark.sql import functions as F

from beatline.operators import filters


def _frame(spark):
    rows = [(f"k{i}", float(i) if i % 7 else float("nan"),
             None if i % 5 == 0 else i, f"2016-0{1 + i % 9}-01 0{i % 10}:00:00")
            for i in range(200)]
    return (spark.createDataFrame(rows, "key string, x double, y int, ts string")
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def test_drop_null_keys_matches_na_drop(spark):
    df = _frame(spark)
    a = sorted(filters.drop_null_keys(df, ["x", "y"]).select("key").collect())
    b = sorted(df.na.drop(subset=["x", "y"]).select("key").collect())
    assert a == b and len(a) < 200
    assert filters.drop_incomplete(df).count() == df.na.drop().count()


def test_year_between_pushed_to_scan(spark, tmp_dir):
    path = f"{tmp_dir}/t.parquet"
    _frame(spark).write.parquet(path)
    df = filters.year_between(spark.read.parquet(path), 2016, 2016, "ts")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan
    assert df.count() == 200


def test_sample_fraction_repeatable_and_close(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("key"))
    a = filters.sample_fraction(df, 0.05, 42, "key")
    b = filters.sample_fraction(df, 0.05, 42, "key")
    ka = {r.key for r in a.collect()}
    assert ka == {r.key for r in b.collect()}
    assert abs(len(ka) - 1000) < 4 * math.sqrt(20000 * 0.05 * 0.95)


def test_shuffled_cap_equals_full_sort(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    n = 137
    got = [r.key for r in filters.shuffled_cap(df, n, 42, "key").collect()]
    brute = [r.key for r in df.withColumn("h", filters.row_hash("key", 42))
             .orderBy("h", "key").limit(n).collect()]
    assert got == brute and len(got) == n
    # cap above the row count keeps every row
    assert filters.shuffled_cap(df, 10_000, 42, "key").count() == 5000


def test_cap_counts(spark):
    df = spark.range(100)
    assert filters.cap(df, 10).count() == 10
    assert filters.cap(df, 1000).count() == 100


def test_chronological_split_is_partition(spark):
    df = spark.range(40).select((F.lit(2015) + F.col("id") % 9).cast("int").alias("year"))
    train, test = filters.chronological_split(df, "year", 2021)
    assert train.count() + test.count() == 40
    assert train.filter("year > 2021").count() == 0 and test.filter("year <= 2021").count() == 0


def test_null_keys_are_kept(spark):
    rows = [(None if i % 10 == 0 else f"k{i}", i) for i in range(1000)]
    df = spark.createDataFrame(rows, "incident_key string, v int")
    assert filters.sample_fraction(df, 1.0).count() == 1000
    assert filters.shuffled_cap(df, 5000).count() == 1000
    whole = [r.v for r in filters.shuffled_cap(df, 5000).collect()]
    capped = [r.v for r in filters.shuffled_cap(df, 150).collect()]
    null = {i for i in range(0, 1000, 10)}
    assert [v for v in whole if v not in null][:len([v for v in capped if v not in null])] == [v for v in capped if v not in null]
    assert len(null & set(whole[:150])) == len(null & set(capped))


def test_chronological_split_keeps_rows_without_a_year(spark):
    df = spark.createDataFrame([(2020,), (2022,), (None,)], "year int")
    train, test = filters.chronological_split(df)
    assert train.count() == 1 and test.count() == 2


def test_default_window_keeps_every_year(spark):
    from beatline.plans.features import extract_incidents
    from beatline.schema import COORD_COLUMNS, RAW_COLUMNS
    df = spark.range(90).selectExpr("cast(id as string) incident_key", "timestamp_seconds(1420070400 + id * 3155760) date",
                                    *[f"cast('1' as string) {c}" for c in [*RAW_COLUMNS, *COORD_COLUMNS]])
    years = extract_incidents(df).groupBy("year").count().collect()
    assert sum(r["count"] for r in years) == 90 and {2015, 2023} <= {r.year for r in years}


def test_year_window_reaches_a_stored_tables_scan(spark, tmp_dir):
    df = spark.range(100).selectExpr("timestamp_seconds(1420070400 + id * 3155760) date", "id")
    df.write.parquet(f"{tmp_dir}/t")
    plan = filters.year_between(spark.read.parquet(f"{tmp_dir}/t"), 2016, 2017)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,2016-01-01" in plan and "LessThan(date,2018-01-01" in plan


def test_null_key_rows_are_sampled_one_by_one(spark):
    rows = [(None, i, f"t{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "incident_key string, v int, t string")
    kept = [filters.sample_fraction(df, 0.05, seed).count() for seed in (1, 2, 3, 46)]
    assert all(20 <= n <= 90 for n in kept)
