"""DuckDB twins of the registered queries (the correctness oracle).

Each query is a chain of named CTEs over the driver's tables; the chain is
assembled from the fragments below so every query states its whole
derivation from ``lineitem``, ``part`` and ``supplier``.
"""

from __future__ import annotations

from beatline.plans.params import CUT_YEAR, N_LOCATIONS, N_TYPES, SEED, TEST_FRACTION, YEARS
from beatline.sources.fixture import incident_view_sql

LO, HI = YEARS

# Fixed values, written out here and not taken from the code under test, so
# that a wrong rule in either place turns a query red.
_SEASON = ("CASE WHEN {0} IN (12, 1, 2) THEN 1 WHEN {0} IN (3, 4, 5) THEN 2 "
           "WHEN {0} IN (6, 7, 8) THEN 3 ELSE 4 END")
_SEASON_STRICT = ("CASE WHEN month IN (12, 1, 2) THEN 1 WHEN month IN (3, 4, 5) THEN 2 "
                  "WHEN month IN (6, 7, 8) THEN 3 WHEN month IN (9, 10, 11) THEN 4 END")
_RUSH = "CASE WHEN {0} BETWEEN 7 AND 9 OR {0} BETWEEN 16 AND 19 THEN 1 ELSE 0 END"
_WEEKEND = "CASE WHEN {0} IN (1, 7) THEN 1 ELSE 0 END"
# The first keyword that a description holds names its group.
_GROUPS = """CASE
  WHEN {0} LIKE '%aggravated%' THEN 'AGGRAVATED'
  WHEN {0} LIKE '%armed%' THEN 'ARMED'
  WHEN {0} LIKE '%attempt%' THEN 'ATTEMPT'
  WHEN {0} LIKE '%simple%' THEN 'SIMPLE'
  WHEN {0} LIKE '%domestic%' THEN 'DOMESTIC'
  WHEN {0} LIKE '%retail%' THEN 'RETAIL'
  WHEN {0} LIKE '%financial%' THEN 'FINANCIAL'
  WHEN {0} LIKE '%poss%' THEN 'POSSESSION'
  WHEN {0} LIKE '%deliver%' THEN 'DELIVERY'
  WHEN {0} LIKE '%vehicle%' THEN 'VEHICLE'
  WHEN {0} LIKE '%damage%' THEN 'DAMAGE'
  WHEN {0} LIKE '%forcible%' THEN 'FORCIBLE'
  ELSE 'OTHER' END"""

# The key columns of the two cleaning steps.
KEYS_V1_SQL = ["primary_type", "district", "year", "month", "day_of_week",
               "hour_of_day", "arrest", "domestic"]
KEYS_V2_SQL = ["primary_type", "district", "ward", "community_area", "year", "month",
               "day_of_week", "hour_of_day", "arrest", "domestic",
               "location_description", "description"]
# The feature columns of the two classification sets, without
# the two encoded ones.
_FEATURES_V1 = ["year", "month", "day_of_week", "hour_of_day", "district", "arrest_int",
                "domestic_int", "is_rush_hour", "is_weekend", "season"]
_FEATURES_V2 = ["year", "month", "day_of_week", "hour_of_day", "district", "ward",
                "community_area", "arrest_int", "domestic_int", "is_rush_hour",
                "is_weekend", "season", "district_hour"]

CTE = {}
CTE["incidents"] = incident_view_sql()
CTE["extract"] = f"""
SELECT incident_key, primary_type, description, location_description, arrest, domestic,
       district, ward, community_area,
       CAST(extract(year FROM date) AS INT) AS year,
       CAST(extract(month FROM date) AS INT) AS month,
       CAST(dayofweek(date) + 1 AS INT) AS day_of_week,
       CAST(extract(hour FROM date) AS INT) AS hour_of_day,
       latitude, longitude
FROM incidents
WHERE date IS NOT NULL AND primary_type IS NOT NULL AND district IS NOT NULL
  AND extract(year FROM date) BETWEEN {LO} AND {HI}"""
CTE["clean1"] = ("SELECT * FROM extract WHERE "
                 + " AND ".join(f"{c} IS NOT NULL" for c in KEYS_V1_SQL))
CTE["clean2"] = ("SELECT * FROM extract WHERE "
                 + " AND ".join(f"{c} IS NOT NULL" for c in KEYS_V2_SQL))
_ROWF = f"""CAST(arrest AS INT) AS arrest_int, CAST(domestic AS INT) AS domestic_int,
       {_RUSH.format('hour_of_day')} AS is_rush_hour,
       {_WEEKEND.format('day_of_week')} AS is_weekend,
       {_SEASON.format('month')} AS season"""
CTE["feat1"] = f"SELECT *, {_ROWF} FROM clean1"
CTE["feat2"] = f"""SELECT *, {_ROWF},
       district * 100 + hour_of_day AS district_hour,
       {_GROUPS.format('lower(description)')} AS description_grouped
FROM clean2"""
CTE["types2"] = f"""
SELECT primary_type, n,
       CAST(row_number() OVER (ORDER BY n DESC, primary_type) - 1 AS DOUBLE) AS label
FROM (SELECT primary_type, count(*) AS n FROM feat2 GROUP BY primary_type
      ORDER BY n DESC, primary_type LIMIT {N_TYPES})"""
CTE["types1"] = CTE["types2"].replace("feat2", "feat1")
CTE["loctop"] = f"""
SELECT location_description, count(*) AS n FROM feat2 GROUP BY location_description
ORDER BY n DESC, location_description LIMIT {N_LOCATIONS}"""
CTE["featc"] = """
SELECT f.*, CASE WHEN t.location_description IS NOT NULL THEN f.location_description
                 ELSE 'OTHER' END AS location_description_clean
FROM feat2 f LEFT JOIN loctop t ON f.location_description = t.location_description"""
CTE["loccodes"] = """
SELECT location_description_clean, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, location_description_clean) - 1
            AS DOUBLE) AS location_encoded
FROM featc GROUP BY location_description_clean"""
CTE["desccodes"] = """
SELECT description_grouped, count(*) AS n,
       CAST(row_number() OVER (ORDER BY count(*) DESC, description_grouped) - 1
            AS DOUBLE) AS description_encoded
FROM feat2 GROUP BY description_grouped"""
CTE["d3"] = f"""
SELECT f.incident_key, {', '.join('f.' + c for c in _FEATURES_V2)},
       lc.location_encoded, dc.description_encoded, t.label, f.primary_type
FROM featc f
JOIN types2 t ON f.primary_type = t.primary_type
JOIN loccodes lc ON f.location_description_clean = lc.location_description_clean
JOIN desccodes dc ON f.description_grouped = dc.description_grouped"""
CTE["d3v1"] = f"""
SELECT f.incident_key, {', '.join('f.' + c for c in _FEATURES_V1)}, t.label, f.primary_type
FROM feat1 f JOIN types1 t ON f.primary_type = t.primary_type"""

CTE["pbase"] = """
SELECT district, year, month, count(year) AS crime_count,
       avg(arrest_int) AS arrest_rate, avg(domestic_int) AS domestic_rate,
       avg(hour_of_day) AS avg_hour, avg(is_rush_hour) AS rush_hour_rate,
       avg(is_weekend) AS weekend_rate,
       count(DISTINCT ward) AS unique_wards,
       count(DISTINCT community_area) AS unique_communities
FROM d3 WHERE district IS NOT NULL GROUP BY district, year, month"""
CTE["ploc"] = """
SELECT district, year, month, location_encoded AS top_location FROM (
  SELECT district, year, month, location_encoded,
         row_number() OVER (PARTITION BY district, year, month
                            ORDER BY count(*) DESC, location_encoded) AS rn
  FROM d3 WHERE district IS NOT NULL GROUP BY district, year, month, location_encoded)
WHERE rn = 1"""
CTE["phist"] = f"""
SELECT b.*, l.top_location, {_SEASON_STRICT} AS season,
       lag(crime_count, 1) OVER w AS crime_count_lag1,
       lag(crime_count, 2) OVER w AS crime_count_lag2,
       lag(crime_count, 3) OVER w AS crime_count_lag3,
       CASE WHEN count(crime_count) OVER r = 3 THEN avg(crime_count) OVER r END
         AS rolling_avg_3m,
       lag(crime_count, 1) OVER (PARTITION BY district, month ORDER BY year)
         AS crime_count_yoy
FROM pbase b JOIN ploc l USING (district, year, month)
WINDOW w AS (PARTITION BY district ORDER BY year, month),
       r AS (PARTITION BY district ORDER BY year, month
             ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)"""
_PANEL_COLS = ["district", "year", "month", "season", "crime_count", "arrest_rate",
               "domestic_rate", "avg_hour", "rush_hour_rate", "weekend_rate",
               "unique_wards", "unique_communities", "top_location", "crime_count_lag1",
               "crime_count_lag2", "crime_count_lag3", "rolling_avg_3m", "crime_count_yoy"]
CTE["panel"] = ("SELECT " + ", ".join(_PANEL_COLS) + " FROM phist WHERE "
                + " AND ".join(f"{c} IS NOT NULL" for c in _PANEL_COLS))
CTE["preds"] = f"""
SELECT 'rolling_mean' AS model, district, year, month, CAST(crime_count AS DOUBLE) AS actual,
       CAST(rolling_avg_3m AS DOUBLE) AS predicted FROM panel WHERE year > {CUT_YEAR}
UNION ALL
SELECT 'last_month', district, year, month, CAST(crime_count AS DOUBLE),
       CAST(crime_count_lag1 AS DOUBLE) FROM panel WHERE year > {CUT_YEAR}
UNION ALL
SELECT 'last_year', district, year, month, CAST(crime_count AS DOUBLE),
       CAST(crime_count_yoy AS DOUBLE) FROM panel WHERE year > {CUT_YEAR}"""
# Classifier path: alphabetical label, exact stratified split.
CTE["lab"] = """
SELECT primary_type, CAST(row_number() OVER (ORDER BY primary_type) - 1 AS INT) AS label,
       n
FROM (SELECT primary_type, count(*) AS n FROM d3 GROUP BY primary_type)"""
CTE["c3"] = f"""
SELECT d.* EXCLUDE (label), l.label, md5('{SEED}|' || d.incident_key) AS h
FROM d3 d JOIN lab l ON d.primary_type = l.primary_type"""
CTE["cls"] = "SELECT label, count(*) AS n_c FROM c3 GROUP BY label"
CTE["alloc"] = f"""
SELECT c.label, c.n_c, t.n_test,
       (CAST(t.n_test AS HUGEINT) * c.n_c) // t.n AS base,
       (CAST(t.n_test AS HUGEINT) * c.n_c) % t.n AS rem
FROM cls c CROSS JOIN (
  SELECT sum(n_c) AS n, CAST(ceil(CAST({TEST_FRACTION} AS DOUBLE) * sum(n_c)) AS BIGINT)
         AS n_test FROM cls) t"""
CTE["quota"] = """
SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label)
                              <= n_test - sum(base) OVER () THEN 1 ELSE 0 END AS quota
FROM alloc"""
CTE["sp"] = """
SELECT r.* EXCLUDE (h, rk), r.rk <= q.quota AS is_test FROM (
  SELECT c3.*, row_number() OVER (PARTITION BY label ORDER BY h, incident_key) AS rk
  FROM c3) r JOIN quota q ON r.label = q.label"""
CTE["gc"] = """
SELECT description_encoded, label, count(*) AS n FROM sp WHERE NOT is_test
GROUP BY description_encoded, label"""
CTE["gt"] = "SELECT description_encoded, sum(n) AS g FROM gc GROUP BY description_encoded"
CTE["gp"] = """
SELECT description_encoded, label AS prediction FROM (
  SELECT description_encoded, label,
         row_number() OVER (PARTITION BY description_encoded ORDER BY n DESC, label) AS rn
  FROM gc) WHERE rn = 1"""
CTE["spred"] = """
SELECT te.incident_key, te.label, CAST(coalesce(gp.prediction, 0) AS INT) AS prediction,
       coalesce(CAST(gc.n AS DOUBLE) / gt.g, CAST(0 AS DOUBLE)) AS prob_true
FROM sp te
LEFT JOIN gp ON te.description_encoded = gp.description_encoded
LEFT JOIN gc ON te.description_encoded = gc.description_encoded AND te.label = gc.label
LEFT JOIN gt ON te.description_encoded = gt.description_encoded
WHERE te.is_test"""

_ORDER = ["incidents", "extract", "clean1", "clean2", "feat1", "feat2", "types2",
          "types1", "loctop", "featc", "loccodes", "desccodes", "d3", "d3v1",
          "pbase", "ploc", "phist", "panel", "preds", "lab", "c3", "cls", "alloc",
          "quota", "sp", "gc", "gt", "gp", "spred"]
_DEPS = {
    "extract": ["incidents"], "clean1": ["extract"], "clean2": ["extract"],
    "feat1": ["clean1"], "feat2": ["clean2"], "types2": ["feat2"], "types1": ["feat1"],
    "loctop": ["feat2"], "featc": ["feat2", "loctop"], "loccodes": ["featc"],
    "desccodes": ["feat2"], "d3": ["featc", "types2", "loccodes", "desccodes"],
    "d3v1": ["feat1", "types1"], "pbase": ["d3"], "ploc": ["d3"],
    "phist": ["pbase", "ploc"], "panel": ["phist"], "preds": ["panel"],
    "lab": ["d3"], "c3": ["d3", "lab"], "cls": ["c3"], "alloc": ["cls"],
    "quota": ["alloc"], "sp": ["c3", "quota"], "gc": ["sp"], "gt": ["gc"],
    "gp": ["gc"], "spred": ["sp", "gp", "gc", "gt"],
}


def with_ctes(needs: list[str], extra: list[tuple[str, str]], body: str) -> str:
    """``WITH`` the transitive closure of ``needs`` (in order), then
    ``extra`` CTEs, then ``body``."""
    have: set[str] = set()

    def visit(n):
        if n in have:
            return
        for d in _DEPS.get(n, []):
            visit(d)
        have.add(n)

    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTE[n]})" for n in _ORDER if n in have]
    parts += [f"{n} AS ({sql})" for n, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body
