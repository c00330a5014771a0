"""Top-N lists, buckets and frequency codes."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from beatline.operators import encoders


def _ties(spark):
    vals = ["b"] * 3 + ["a"] * 3 + ["c"] * 3 + ["d"] * 1 + ["OTHER"] * 1 + ["e"] * 2
    return spark.createDataFrame([(v,) for v in vals], "v string")


def test_top_n_ties_by_value(spark):
    top = [r.v for r in encoders.top_n_keys(_ties(spark), "v", 2).collect()]
    assert top == ["a", "b"]


def test_keep_top_n_semi_join(spark):
    df = _ties(spark)
    kept = encoders.keep_top_n(df, "v", 3)
    assert sorted({r.v for r in kept.collect()}) == ["a", "b", "c"]
    assert kept.count() == 9
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan


def test_bucket_rare_other_collision(spark):
    df = _ties(spark)
    out = encoders.bucket_rare(df, "v", 3, out="clean")
    got = {r.v: r.clean for r in out.collect()}
    assert got["a"] == "a" and got["e"] == "OTHER" and got["d"] == "OTHER"
    assert got["OTHER"] == "OTHER"  # a real OTHER merges with the bucket


def test_code_table_matches_string_indexer(spark):
    df = _ties(spark)
    table = encoders.frequency_code_table(
        df.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v", code_name="code")
    ours = {r.v: r.code for r in table.collect()}
    model = encoders.fit_string_indexer(df, ["v"], ["code"])
    theirs = {v: float(i) for i, v in enumerate(model.labelsArray[0])}
    assert ours == theirs
    alpha = encoders.frequency_code_table(
        df.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v", code_name="code",
        order="alphabetAsc")
    assert [r.v for r in alpha.orderBy("code").collect()] == sorted(ours)


def test_apply_code_table_skips_unseen(spark):
    df = _ties(spark)
    table = spark.createDataFrame([("a", 0.0), ("b", 1.0)], "v string, code double")
    out = encoders.apply_code_table(df, table, "v", "code", bound=2)
    assert out.count() == 6
    left = encoders.apply_code_table(df, table, "v", "code", bound=2, how="left")
    assert left.count() == df.count() and left.filter("code IS NULL").count() == 7


def test_codes_by_joins_equal_codes_by_literals(spark, monkeypatch):
    from beatline.plans import classification as C
    from beatline.sources.fixture import fixture_incidents
    inc = fixture_incidents(spark, SF_SMALL)
    literal = C.build_v2(inc, (1995, 2000)).rows.orderBy("incident_key").collect()
    monkeypatch.setattr(C, "MOST_LITERALS", 0)
    assert C.build_v2(inc, (1995, 2000)).rows.orderBy("incident_key").collect() == literal
