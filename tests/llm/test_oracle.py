"""The registered queries against their DuckDB twins on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from beatline.llm.queries import ORACLE, QUERIES
from conftest import SF_SMALL


def rows_of(cursor_rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in cursor_rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    con.execute(ORACLE[name])
    names = [d[0] for d in con.description]
    want = rows_of(con.fetchall(), names)
    got = QUERIES[name](spark, SF_SMALL)
    assert sorted(got.columns) == sorted(names)
    assert rows_of(map(tuple, got.collect()), got.columns) == want


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
