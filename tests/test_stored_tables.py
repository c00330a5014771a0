"""The partitioned sink, catalog tables with statistics, the stored feature pipeline."""

import os
import re
import uuid

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from beatline.operators.transformers import ColumnKeeper, KeywordGrouper, RareBucketer, ValueFilter
from beatline.plans import classification as C
from beatline.plans.feature_pipeline import fit_feature_pipeline
from beatline.plans.features import cleaned_features
from beatline.sources.fixture import fixture_incidents
from beatline.sources.incidents import read_incidents, register_table, write_table

from conftest import SF_SMALL


def _years(spark):
    return spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 2019).otherwise(F.col("id") % 3 + 2019).cast("int").alias("year"))


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_only_present_partitions_are_overwritten(spark, tmp_dir, format):
    path = f"{tmp_dir}/t"
    df = _years(spark)
    write_table(df, path, format, ["year"])
    write_table(df.filter("year = 2020 and id < 100"), path, format, ["year"], only_present=True)
    back = spark.read.options(header=True).schema("id bigint, year int").format(format).load(path)
    want = df.filter("year <> 2020 or id < 100")
    assert sorted(map(tuple, back.select("id", "year").collect())) == sorted(map(tuple, want.collect()))
    write_table(df.filter("id < 0"), path, format, ["year"], only_present=True)
    assert back.count() == want.count()
    with pytest.raises(ValueError):
        write_table(df, path, format, only_present=True)


def test_partition_filter_prunes_the_read(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    write_table(_years(spark), path, "parquet", ["year"])
    assert sorted(d for d in os.listdir(path) if d.startswith("year=")) == ["year=2019", "year=2020", "year=2021"]
    late = read_incidents(spark, path).filter("year >= 2021")
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ >= 2021", plan)
    assert len(late.inputFiles()) >= 1 and late.count() == 2000
    # Small parts are joined: one file a partition here.
    assert all(sum(f.endswith(".parquet") for f in os.listdir(f"{path}/year={y}")) == 1 for y in (2019, 2020, 2021))


def test_null_partition_value_survives(spark, tmp_dir):
    df = spark.createDataFrame([(1, None), (2, 2020)], "id int, year int")
    write_table(df, f"{tmp_dir}/n", "parquet", ["year"])
    assert {(r.id, r.year) for r in read_incidents(spark, f"{tmp_dir}/n").collect()} == {(1, None), (2, 2020)}


def test_statistics_choose_the_join(spark, tmp_dir):
    """A filter that leaves few rows of a large table makes it the broadcast side
    once the catalog knows the ranges of its values."""
    big = spark.range(40000).select("id", F.col("id").cast("int").alias("code"), F.repeat(F.lit("x"), 20).alias("v"))
    big.write.parquet(f"{tmp_dir}/big")
    register = f"big_{uuid.uuid4().hex}"
    names = {"spark.sql.cbo.enabled": "true", "spark.sql.autoBroadcastJoinThreshold": "4000",
             "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}

    def plan(left):
        right = spark.read.parquet(f"{tmp_dir}/big").select(F.col("id").alias("other"))
        return left.filter("code < 20").join(right, left["id"] == right["other"])._jdf.queryExecution().executedPlan().toString()

    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        table = register_table(spark, register, f"{tmp_dir}/big", columns=["id", "code"])
        assert "BroadcastHashJoin" in plan(read_incidents(spark, register, "table"))
        assert "SortMergeJoin" in plan(read_incidents(spark, f"{tmp_dir}/big"))
        stats = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED `{register}` code").collect()}
        assert stats["min"] == "0" and stats["max"] == "39999" and stats["num_nulls"] == "0"
        assert table.count() == 40000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sql(f"DROP TABLE IF EXISTS `{register}`")
    assert os.path.isdir(f"{tmp_dir}/big")  # an external table's files stay


@pytest.fixture(scope="module")
def cleaned(spark):
    return cleaned_features(fixture_incidents(spark, SF_SMALL), 2, (1995, 2000))


def test_reloaded_pipeline_gives_the_classification_set(spark, cleaned, tmp_dir):
    fitted = fit_feature_pipeline(cleaned, 10, 50)
    fitted.write().overwrite().save(f"{tmp_dir}/p")
    again = PipelineModel.load(f"{tmp_dir}/p")
    want = C.build_v2(fixture_incidents(spark, SF_SMALL), (1995, 2000)).rows
    got = again.transform(cleaned.drop("description_grouped"))
    assert got.columns == want.columns and dict(got.dtypes) == dict(want.dtypes)
    # No Python worker and no join of its own.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Join") == cleaned._jdf.queryExecution().executedPlan().toString().count("Join")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_pipeline_on_unseen_and_missing_values(spark, cleaned):
    row = cleaned.filter("description_grouped <> 'OTHER'").limit(1)
    kind = row.first().primary_type
    train = cleaned.filter((F.col("primary_type") == kind) & (F.col("description_grouped") == "SIMPLE"))
    model = fit_feature_pipeline(train, 1, 1, unseen="skip")
    other = train.limit(1).withColumn("description", F.lit("RETAIL"))
    assert model.transform(train).count() == train.count()
    assert model.transform(other).count() == 0  # a group the fit has not seen
    assert model.transform(train.limit(1).withColumn("primary_type", F.lit(None).cast("string"))).count() == 0
    assert fit_feature_pipeline(cleaned.filter("year < 0"), unseen="skip").transform(cleaned).count() == 0


def test_transformers(spark, tmp_dir):
    df = spark.createDataFrame([("a big one", "x"), ("ARMED", "y"), (None, None)], "t string, p string")
    steps = [KeywordGrouper(inputCol="t", outputCol="g", needles=["big"], groups=["BIG"], default="REST"),
             RareBucketer(inputCol="p", outputCol="b", values=["x"]), ValueFilter(inputCol="b", values=["x", "OTHER"]),
             ColumnKeeper(names=["g", "b"])]
    for i, step in enumerate(steps):
        step.save(f"{tmp_dir}/{i}")
    again = [type(s).load(f"{tmp_dir}/{i}") for i, s in enumerate(steps)]
    got = PipelineModel(again).transform(df)
    assert [tuple(r) for r in got.collect()] == [("BIG", "x"), ("REST", "OTHER"), ("REST", "OTHER")]
    assert KeywordGrouper(inputCol="t", outputCol="g").transform(df).select("g").collect()[1].g == "ARMED"
