"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from beatline.plans.oracle import with_ctes
from beatline.plans.params import (
    CUT_YEAR, N_TYPES, PREVIEW_ROWS, SAMPLE_P, SEED, SHUFFLE_CAP,
    TOP_TYPES_REPORT, CAP_ROWS, NULL_KEY_CAP,
)
from beatline.schema import FEATURES_V1, NULL_PROFILE_COLUMNS, PANEL_FEATURES
from beatline.sources.fixture import VIEW_COLUMNS

_EXTRACT_COLS = ("incident_key, primary_type, description, location_description, arrest, "
                 "domestic, district, ward, community_area, year, month, day_of_week, "
                 "hour_of_day, latitude, longitude")

# Descriptions with everything that CSV has to keep apart.
AWKWARD_SQL = """CASE day_of_week
  WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '  ' || description || '  '
  WHEN 4 THEN 'say "' || description || '", ok' WHEN 5 THEN description || chr(10) || '"'
  WHEN 6 THEN ' ' ELSE description END"""

# Spark SQL type names of the incident view, in column order.
_VIEW_TYPES = ["string", "string", "string", "string", "boolean", "boolean", "int", "int",
               "int", "timestamp_ntz", "double", "double"]


def _sample_pred(p: float, seed: int) -> str:
    """The first 32 bits of the hash, as a number, below the share ``p``."""
    return (f"CAST('0x' || substr(md5('{seed}|' || coalesce(incident_key, '')), 1, 8) AS UBIGINT) "
            f"< ceil({p} * 4294967296)")


def _r6(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


def _metrics_select() -> str:
    return ("SELECT model, count(*) AS rows, "
            + _r6("avg(abs(actual - predicted))", "mae") + ", "
            + _r6("sqrt(avg((actual - predicted) * (actual - predicted)))", "rmse") + ", "
            + _r6("CASE WHEN var_pop(actual) > 0 THEN 1 - sum((actual - predicted) * "
                  "(actual - predicted)) / (var_pop(actual) * count(*)) END", "r2") + ", "
            + _r6("avg(actual)", "mean_actual") + ", "
            + _r6("CASE WHEN avg(actual) <> 0 THEN avg(abs(actual - predicted)) / "
                  "avg(actual) * 100 END", "mae_pct")
            + " FROM preds")


_REPORT = f"""
WITH pc AS (SELECT label AS actual, prediction AS predicted, count(*) AS n
            FROM spred GROUP BY 1, 2),
sup AS (SELECT actual AS cls, sum(n) AS support FROM pc GROUP BY 1),
prd AS (SELECT predicted AS cls, sum(n) AS pred_n FROM pc GROUP BY 1),
tp AS (SELECT actual AS cls, n AS tp FROM pc WHERE actual = predicted),
per0 AS (SELECT coalesce(s.cls, p.cls) AS cls, coalesce(s.support, 0) AS support,
                coalesce(p.pred_n, 0) AS pred_n
         FROM sup s FULL JOIN prd p ON s.cls = p.cls),
per1 AS (SELECT per0.*, coalesce(tp.tp, 0) AS tp FROM per0 LEFT JOIN tp USING (cls)),
per2 AS (SELECT *, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE CAST(0 AS DOUBLE) END AS precision,
                   CASE WHEN support > 0 THEN tp / support ELSE CAST(0 AS DOUBLE) END AS recall
         FROM per1),
per AS (SELECT *, CASE WHEN precision + recall > 0
                       THEN 2 * precision * recall / (precision + recall)
                       ELSE CAST(0 AS DOUBLE) END AS f1 FROM per2)
SELECT CAST(cls AS INT) AS row_order, coalesce(lab.primary_type, CAST(cls AS VARCHAR)) AS class_name,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support
FROM per LEFT JOIN lab ON per.cls = lab.label
UNION ALL
SELECT CAST(max(cls) + 1 AS INT), 'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
       round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per
UNION ALL
SELECT CAST(max(cls) + 2 AS INT), 'macro avg', round(avg(precision), 6), round(avg(recall), 6),
       round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM per
UNION ALL
SELECT CAST(max(cls) + 3 AS INT), 'weighted avg',
       round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6),
       round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per"""


def _report_sql() -> str:
    # The report body has its own WITH; fold it into the chain.
    body = _REPORT.strip()
    assert body.startswith("WITH ")
    extra_and_select = body[len("WITH "):]
    head = with_ctes(["spred", "lab"], [], "")
    return head.rstrip() + ",\n" + extra_and_select


def _describe_sql() -> str:
    rows = ", ".join(f"('{name}', '{t}', {i + 1})"
                     for i, ((name, _), t) in enumerate(zip(VIEW_COLUMNS, _VIEW_TYPES)))
    return (f"SELECT * FROM (VALUES {rows}) "
            "AS t(column_name, data_type, ordinal_position)")


def _std_sample_sql() -> str:
    cols = []
    for c in FEATURES_V1:
        sd = f"stddev_samp({c}) OVER ()"
        cols.append(_r6(f"CASE WHEN {sd} = 0 THEN CAST(0 AS DOUBLE) "
                        f"ELSE ({c} - avg({c}) OVER ()) / {sd} END", f"{c}_z"))
    return with_ctes(["d3v1"], [], "SELECT incident_key, " + ", ".join(cols) + " FROM d3v1")


def _std_population_sql() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in PANEL_FEATURES)
    cols = ", ".join(
        _r6(f"(p.{c} - s.m_{c}) / CASE WHEN s.s_{c} = 0 OR s.s_{c} IS NULL "
            f"THEN CAST(1 AS DOUBLE) ELSE s.s_{c} END", f"{c}_z")
        for c in PANEL_FEATURES)
    return with_ctes(["panel"], [("st", f"SELECT {stats} FROM panel WHERE year <= {CUT_YEAR}")],
                     f"SELECT p.district, p.year, p.month, "
                     f"CASE WHEN p.year <= {CUT_YEAR} THEN 'train' ELSE 'test' END AS split, "
                     f"{cols} FROM panel p CROSS JOIN st s")


ORACLE: dict[str, str] = {
    "scan_incidents": with_ctes(["incidents"], [], "SELECT * FROM incidents"),
    "preview": with_ctes(["incidents"], [],
                         f"SELECT * FROM incidents ORDER BY incident_key LIMIT {PREVIEW_ROWS}"),
    "describe_columns": _describe_sql(),
    "csv_roundtrip": with_ctes(["extract"], [], f"""
SELECT * REPLACE ({AWKWARD_SQL} AS description) FROM extract"""),
    "partitioned_sink": with_ctes(["extract"], [], f"""
SELECT * FROM extract WHERE year >= {CUT_YEAR - 1} AND (year <> {CUT_YEAR} OR arrest)"""),
    "catalog_scan": with_ctes(["extract"], [("kinds", f"""
SELECT primary_type, count(*) AS of_type FROM extract GROUP BY 1
ORDER BY of_type DESC, primary_type LIMIT {N_TYPES}""")], f"""
SELECT primary_type, district, of_type, count(*) AS n FROM extract JOIN kinds USING (primary_type)
WHERE year > {CUT_YEAR} GROUP BY 1, 2, 3"""),
    "ranked_values": with_ctes(["extract"], [], """
SELECT incident_key, location_description,
       row_number() OVER (ORDER BY location_description NULLS FIRST, incident_key) AS place,
       count(*) OVER () AS of
FROM (SELECT DISTINCT incident_key, location_description FROM extract)"""),
    "location_codes": with_ctes(["extract"], [], """
SELECT location_description, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, location_description) - 1 AS DOUBLE) AS code
FROM extract WHERE location_description IS NOT NULL GROUP BY 1"""),
    "distinct_sketches": with_ctes(["extract"], [], """
SELECT CASE grouping(year, month) WHEN 0 THEN 'month' WHEN 1 THEN 'year' ELSE 'city' END AS level, year, month,
       count(DISTINCT incident_key) AS n_incident_key, count(DISTINCT ward) AS n_ward,
       count(DISTINCT community_area) AS n_community_area,
       true AS incident_key_within, true AS ward_within, true AS community_area_within
FROM extract GROUP BY GROUPING SETS ((year, month), (year), ())"""),
    "read_incidents": with_ctes(["extract"], [], "SELECT * FROM extract"),
    "cap": with_ctes(["extract"], [], f"SELECT least(count(*), {CAP_ROWS}) AS n FROM extract"),
    "null_keys": with_ctes(["extract"], [("holes", """
SELECT * REPLACE (CASE WHEN hour_of_day = 3 THEN NULL ELSE incident_key END AS incident_key)
FROM extract""")], f"""
SELECT 'sampled' AS what, count(*) AS n FROM
  (SELECT * REPLACE (coalesce(incident_key, '|' || concat_ws('|', coalesce(primary_type, ''), coalesce(description, ''),
     coalesce(location_description, ''), coalesce(CAST(arrest AS VARCHAR), ''), coalesce(CAST(domestic AS VARCHAR), ''),
     coalesce(CAST(district AS VARCHAR), ''), coalesce(CAST(ward AS VARCHAR), ''), coalesce(CAST(community_area AS VARCHAR), ''),
     coalesce(CAST(year AS VARCHAR), ''), coalesce(CAST(month AS VARCHAR), ''), coalesce(CAST(day_of_week AS VARCHAR), ''),
     coalesce(CAST(hour_of_day AS VARCHAR), ''))) AS incident_key) FROM holes)
  WHERE {_sample_pred(SAMPLE_P, SEED)}
UNION ALL SELECT 'capped', least(count(*), {NULL_KEY_CAP}) FROM holes
UNION ALL SELECT 'split', count(*) FROM holes"""),
    "capped_sample": with_ctes(["extract"], [], f"""
SELECT {_EXTRACT_COLS} FROM extract WHERE {_sample_pred(SAMPLE_P, SEED)}
ORDER BY md5('{SEED + 1}|' || incident_key), incident_key LIMIT {NULL_KEY_CAP}"""),
    "weighted_rows": with_ctes(["sp", "lab"], [], """
SELECT incident_key, label,
       sum(count(*)) OVER () / ((SELECT count(*) FROM lab) * sum(count(*)) OVER (PARTITION BY label))
         AS weight
FROM sp WHERE NOT is_test GROUP BY incident_key, label"""),
    "model_roundtrip": with_ctes(["sp"], [], """
SELECT count(*) AS rows, count(*) AS same FROM sp WHERE is_test"""),
    "total_rows": with_ctes(["incidents"], [], "SELECT count(*) AS total_rows FROM incidents"),
    "type_distribution": with_ctes(["incidents"], [], f"""
SELECT primary_type, count(*) AS count,
       CAST(round(CAST(count(*) * 100 AS DECIMAL(38, 6)) / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct
FROM incidents GROUP BY primary_type
ORDER BY count DESC, primary_type LIMIT {TOP_TYPES_REPORT}"""),
    "type_frequency": with_ctes(["extract"], [], """
SELECT primary_type, count(*) AS count FROM extract GROUP BY primary_type
ORDER BY count DESC, primary_type LIMIT 10"""),
    "group_frequency": with_ctes(["feat2"], [], """
SELECT description_grouped, count(*) AS count FROM feat2 GROUP BY description_grouped"""),
    "yearly_district_counts": with_ctes(["incidents"], [], """
SELECT CAST(extract(year FROM date) AS INT) AS year, district, count(*) AS crime_count
FROM incidents WHERE district IS NOT NULL GROUP BY 1, 2 ORDER BY 1, 2"""),
    "null_profile": with_ctes(["incidents"], [], "SELECT " + ", ".join(
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in NULL_PROFILE_COLUMNS)
        + " FROM incidents"),
    "stage_funnel": with_ctes(["d3"], [], """
SELECT 0 AS step, 'loaded' AS stage, (SELECT count(*) FROM extract) AS rows
UNION ALL SELECT 1, 'not_null', (SELECT count(*) FROM clean2)
UNION ALL SELECT 2, 'top_types', (SELECT count(*) FROM d3)"""),
    "class_list": with_ctes(["d3"], [], """
SELECT primary_type, CAST(row_number() OVER (ORDER BY primary_type) - 1 AS INT) AS class_index,
       count(*) OVER () AS num_classes
FROM (SELECT DISTINCT primary_type FROM d3)"""),
    "extract_incidents": with_ctes(["extract"], [], "SELECT * FROM extract"),
    "clean_v1": with_ctes(["clean1"], [], "SELECT * FROM clean1"),
    "clean_v2": with_ctes(["clean2"], [], "SELECT * FROM clean2"),
    "calendar_parts": with_ctes(["incidents"], [], """
SELECT incident_key, CAST(extract(year FROM date) AS INT) AS year,
       CAST(extract(month FROM date) AS INT) AS month,
       CAST(dayofweek(date) + 1 AS INT) AS day_of_week,
       CAST(extract(hour FROM date) AS INT) AS hour_of_day
FROM incidents WHERE date IS NOT NULL"""),
    "derive_time_features": with_ctes(["feat2"], [], """
SELECT incident_key, arrest_int, domestic_int, is_rush_hour, is_weekend, season, district_hour
FROM feat2"""),
    "group_descriptions": with_ctes(["feat2"], [],
                                    "SELECT incident_key, description, description_grouped FROM feat2"),
    "sample_fraction": with_ctes(["extract"], [],
                                 f"SELECT * FROM extract WHERE {_sample_pred(SAMPLE_P, SEED)}"),
    "shuffled_cap": with_ctes(["extract"], [], f"""
SELECT {_EXTRACT_COLS} FROM extract WHERE {_sample_pred(SAMPLE_P, SEED)}
ORDER BY md5('{SEED + 1}|' || incident_key), incident_key LIMIT {SHUFFLE_CAP}"""),
    "top_n_keys": with_ctes(["feat2"], [], f"""
SELECT primary_type, count(*) AS n FROM feat2 GROUP BY primary_type
ORDER BY n DESC, primary_type LIMIT {N_TYPES}"""),
    "keep_top_types": with_ctes(["types2"], [], """
SELECT incident_key, primary_type FROM feat2
WHERE primary_type IN (SELECT primary_type FROM types2)"""),
    "bucket_locations": with_ctes(["featc"], [], """
SELECT incident_key, location_description, location_description_clean FROM featc"""),
    "encode_location": with_ctes(["loccodes"], [], "SELECT * FROM loccodes"),
    "encode_description": with_ctes(["desccodes"], [], "SELECT * FROM desccodes"),
    "encode_label_freq": with_ctes(["types2"], [], "SELECT * FROM types2"),
    "encode_label_alpha": with_ctes(["lab"], [], "SELECT * FROM lab"),
    "classification_features": with_ctes(["d3"], [], "SELECT * FROM d3"),
    "feature_pipeline": with_ctes(["d3"], [], "SELECT * FROM d3"),
    "classification_features_v1": with_ctes(["d3v1"], [], "SELECT * FROM d3v1"),
    "monthly_counts": with_ctes(["feat2"], [], """
SELECT district, year, month, season, count(*) AS crime_count FROM feat2
GROUP BY district, year, month, season ORDER BY year, month, district"""),
    "monthly_panel": with_ctes(["panel"], [], "SELECT * FROM panel"),
    "panel_summary": with_ctes(["panel"], [], """
SELECT count(*) AS panel_rows, min(crime_count) AS min_crime_count,
       max(crime_count) AS max_crime_count, round(avg(crime_count), 6) AS mean_crime_count
FROM panel"""),
    "chronological_split": with_ctes(["panel"], [], f"""
SELECT district, year, month, crime_count,
       CASE WHEN year <= {CUT_YEAR} THEN 'train' ELSE 'test' END AS split FROM panel"""),
    "standardize_sample": _std_sample_sql(),
    "standardize_population": _std_population_sql(),
    "stratified_split": with_ctes(["sp"], [],
                                  "SELECT incident_key, label, primary_type, is_test FROM sp"),
    "class_weights": with_ctes(["sp", "lab"], [], """
SELECT label, primary_type, count(*) AS train_count,
       sum(count(*)) OVER () / ((SELECT count(*) FROM lab) * count(*)) AS weight
FROM sp WHERE NOT is_test GROUP BY label, primary_type"""),
    "argmax_class": with_ctes(["spred"], [],
                              "SELECT incident_key, label, prediction FROM spred"),
    "multiclass_log_loss": with_ctes(["spred"], [], """
SELECT round(avg(-ln(least(greatest(prob_true, 1e-15), 1 - 1e-15))), 6) AS log_loss,
       count(*) AS rows FROM spred"""),
    "classification_report": _report_sql(),
    "confusion_matrix": with_ctes(["spred", "lab"], [], f"""
SELECT g.actual, g.predicted, coalesce(c.n, 0) AS n,
       round(CASE WHEN sum(coalesce(c.n, 0)) OVER (PARTITION BY g.actual) > 0
             THEN coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (PARTITION BY g.actual)
             END, 6) AS row_share
FROM (SELECT CAST(a.label AS INT) AS actual, CAST(b.label AS INT) AS predicted
      FROM lab a CROSS JOIN lab b) g
LEFT JOIN (SELECT label AS actual, prediction AS predicted, count(*) AS n
           FROM spred GROUP BY 1, 2) c
  ON g.actual = c.actual AND g.predicted = c.predicted"""),
    "regression_metrics": with_ctes(["preds"], [],
                                    _metrics_select() + " WHERE model = 'rolling_mean' GROUP BY model"),
    "model_comparison": with_ctes(["preds"], [], _metrics_select() + " GROUP BY model"),
    "prediction_sample": with_ctes(["preds"], [], """
SELECT district, year, month, CAST(actual AS BIGINT) AS actual,
       CAST(round_even(predicted, 0) AS BIGINT) AS predicted
FROM preds WHERE model = 'rolling_mean' ORDER BY district, year, month LIMIT 15"""),
}

