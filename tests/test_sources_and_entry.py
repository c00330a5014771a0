"""Sources, the incident view, the driver contract and the DuckDB oracle."""

import os
import sys

import duckdb
import pytest

from beatline.schema import EXTRACT_SCHEMA
from beatline.sources.incidents import describe_columns, preview, read_csv, write_table

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_csv_inference_and_roundtrip(spark, tmp_dir):
    path = f"{tmp_dir}/in.csv"
    with open(path, "w") as f:
        f.write("primary_type,arrest,district,latitude\nTHEFT,True,3,41.8\nBATTERY,False,,\n")
    df = read_csv(spark, path)
    types = dict(df.dtypes)
    assert types["arrest"] == "boolean" and types["district"] == "int"
    rows = df.orderBy("primary_type").collect()
    assert rows[0].district is None and rows[0].latitude is None and rows[1].arrest is True
    out = f"{tmp_dir}/out"
    write_table(df, out, "csv")
    back = read_csv(spark, out, schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


AWKWARD = [("  lead", 1), ("tail  ", 2), ("", 3), (None, 4), ("two\nlines", 5), ('say "hi", ok', 6),
           ("\\", 7), ('"', 8), ("a,b\r\nc", 9), ("null", 10), ("  ", 11)]


def test_csv_keeps_awkward_text(spark, tmp_dir):
    df = spark.createDataFrame(AWKWARD, "v string, n int")
    write_table(df, f"{tmp_dir}/awkward", "csv")
    back = read_csv(spark, f"{tmp_dir}/awkward", schema=df.schema)
    assert {r.n: r.v for r in back.collect()} == {n: v for v, n in AWKWARD}


def test_csv_with_doubled_quotes(spark, tmp_dir):
    with open(f"{tmp_dir}/q.csv", "w", newline="") as f:
        f.write('v,n\n"say ""hi"", ok",1\n"two\nlines",2\n"",3\n,4\n')
    got = {r.n: r.v for r in read_csv(spark, f"{tmp_dir}/q.csv", schema="v string, n int").collect()}
    assert got == {1: 'say "hi", ok', 2: "two\nlines", 3: "", 4: None}


def test_describe_and_preview(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a"), (3, "c")], "id int, v string")
    d = [(r.column_name, r.data_type) for r in describe_columns(df).collect()]
    assert d == [("id", "int"), ("v", "string")]
    assert [r.id for r in preview(df, 2, ["id"]).collect()] == [1, 2]


def test_extract_schema_constant(spark):
    from beatline.plans.features import extract_incidents
    from beatline.sources.fixture import fixture_incidents
    d1 = extract_incidents(fixture_incidents(spark, SF_SMALL), carry=())
    assert [(f.name, f.dataType) for f in d1.schema.fields] == \
        [(f.name, f.dataType) for f in EXTRACT_SCHEMA.fields]


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert "crime_count_yoy" in df.columns


def test_every_query_has_oracle_or_is_a_model():
    import __spark_entry__ as entry
    q, o = entry.queries(), entry.oracle_sql()
    from beatline.plans.catalog import QUERIES
    assert {k for k in QUERIES if k not in o} == MODEL_KEYS and set(QUERIES) <= set(q)


MODEL_KEYS = {"boosted_classification_report", "boosted_importance", "boosted_log_loss", "boosted_loss_curve",
              "fit_forest_classifier", "fit_boosted_classifier", "fit_boosted_regressor",
              "fit_huber_regressor", "feature_importance", "loss_curve",
              "fitted_model_comparison", "fitted_classification_report"}


def _oracle_keys():
    import __spark_entry__ as entry
    from beatline.plans.catalog import QUERIES
    return sorted(k for k in entry.oracle_sql() if k in QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["lineitem", "part", "supplier"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", _oracle_keys())
def test_query_matches_oracle(spark, duck, key):
    import __spark_entry__ as entry
    from oracle_check import digest
    sdf = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    sh, sk, _ = digest(sdf.columns, srows)
    oh, ok, _ = digest(ocols, orows)
    assert sk == ok
    assert sh == oh


def test_partitioned_write_prunes(spark, tmp_dir):
    from pyspark.sql import functions as F
    df = spark.range(100).select((F.lit(2015) + F.col("id") % 4).cast("int").alias("year"),
                                 F.col("id"))
    path = f"{tmp_dir}/by_year"
    write_table(df, path, "parquet", partition_by=["year"])
    back = spark.read.parquet(path).filter("year = 2017")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and back.count() == 25


def test_read_incidents_formats(spark, tmp_dir):
    from beatline.sources.incidents import read_incidents
    df = spark.createDataFrame([("THEFT", 1)], "primary_type string, district int")
    df.write.parquet(f"{tmp_dir}/p")
    df.write.json(f"{tmp_dir}/j")
    assert read_incidents(spark, f"{tmp_dir}/p").count() == 1
    assert read_incidents(spark, f"{tmp_dir}/j", format="json", schema=df.schema).first() \
        == df.first()
    df.createOrReplaceTempView("incidents_tmp")
    assert read_incidents(spark, "incidents_tmp", format="table").count() == 1


def test_release_materialized(spark):
    import os
    from beatline.session import materialize, release_materialized, _WRITTEN
    release_materialized(spark)
    df = materialize(spark.range(10), "tmp-stage")
    assert df.count() == 10
    paths = list(_WRITTEN[spark.sparkContext.applicationId])
    assert release_materialized(spark) == 1
    assert not any(os.path.exists(p.replace("file:", "")) for p in paths)
