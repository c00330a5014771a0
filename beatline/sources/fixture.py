"""Incident view over the driver's TPC-H-style tables.

The test data has no incident table, so one is derived by arithmetic on
integer keys (FIXTURES.md §3). The same statement is the leading CTE of
every oracle query, so both engines see identical rows.

At scale this is two equi-joins of ``lineitem`` with ``part`` and
``supplier``; neither dimension is broadcast by hint (both grow with the
data), so Catalyst/AQE choose the strategy and AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The description assigned to each value of
# CAST(l_quantity AS INT) % 17, in order 0..14 (0 gives a null); 15 and 16
# take DESCRIPTION_OTHERWISE.
DESCRIPTION_BY_QUANTITY = [
    None,
    "AGGRAVATED: HANDGUN",
    "UNARMED",
    "ATTEMPT FORCIBLE ENTRY",
    "SIMPLE",
    "DOMESTIC BATTERY SIMPLE",
    "RETAIL THEFT",
    "FINANCIAL IDENTITY THEFT",
    "POSS: CANNABIS 30GMS OR LESS",
    "MANU/DELIVER: HEROIN",
    "TO VEHICLE",
    "CRIMINAL DAMAGE",
    "Forcible Entry",
    "DOMESTIC VIOLENCE",
    "possession of burglary tools",
]
DESCRIPTION_OTHERWISE = "OVER $500"


def _sql_str(v):
    if v is None:
        return "NULL"
    return "'" + v.replace("'", "''") + "'"


def _description_case() -> str:
    arms = " ".join(
        f"WHEN {i} THEN {_sql_str(v)}"
        for i, v in enumerate(DESCRIPTION_BY_QUANTITY)
    )
    return (f"CASE CAST(l.l_quantity AS INT) % 17 {arms} "
            f"ELSE {_sql_str(DESCRIPTION_OTHERWISE)} END")


# Column expressions valid in both Spark SQL and DuckDB.
VIEW_COLUMNS = [
    ("incident_key",
     "CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) || '-' || "
     "CAST(l.l_partkey AS STRING) || '-' || CAST(l.l_suppkey AS STRING) || '-' || "
     "CAST(CAST(l.l_shipdate AS DATE) AS STRING)"),
    ("primary_type", "p.p_brand"),
    ("description", _description_case()),
    ("location_description", "NULLIF(p.p_name, 'red plate')"),
    ("arrest", "(l.l_returnflag = 'R')"),
    ("domestic", "(l.l_linestatus = 'F')"),
    ("district", "NULLIF(s.s_nationkey, 13)"),
    ("ward", "NULLIF(CAST(l.l_suppkey % 50 AS INT), 0)"),
    ("community_area", "NULLIF(CAST(l.l_partkey % 78 AS INT), 0)"),
    ("date",
     "l.l_shipdate + ((l.l_orderkey * 7 + l.l_linenumber * 5 + l.l_partkey) % 24) "
     "* INTERVAL '1' HOUR"),
    ("latitude",
     "CASE WHEN l.l_partkey % 40 = 0 THEN NULL "
     "ELSE CAST(41.6 AS DOUBLE) + s.s_nationkey / CAST(100 AS DOUBLE) END"),
    ("longitude",
     "CASE WHEN l.l_partkey % 40 = 0 THEN NULL "
     "ELSE CAST(-87.9 AS DOUBLE) + p.p_size / CAST(100 AS DOUBLE) END"),
]


def incident_view_sql(lineitem: str = "lineitem", part: str = "part",
                      supplier: str = "supplier") -> str:
    """The view as one SQL statement (used by the DuckDB oracle)."""
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in VIEW_COLUMNS)
    return (f"SELECT\n  {cols}\nFROM {lineitem} l\n"
            f"JOIN {part} p ON l.l_partkey = p.p_partkey\n"
            f"JOIN {supplier} s ON l.l_suppkey = s.s_suppkey")


def incidents_from_tables(lineitem: DataFrame, part: DataFrame,
                          supplier: DataFrame) -> DataFrame:
    """The view over already-loaded tables."""
    joined = (lineitem.alias("l")
              .join(part.alias("p"), lineitem["l_partkey"] == part["p_partkey"])
              .join(supplier.alias("s"),
                    lineitem["l_suppkey"] == supplier["s_suppkey"]))
    return joined.selectExpr(*[f"{expr} AS {name}" for name, expr in VIEW_COLUMNS])


def fixture_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident DataFrame over ``{sf_dir}/{lineitem,part,supplier}.parquet``."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return incidents_from_tables(read("lineitem"), read("part"),
                                 read("supplier"))
