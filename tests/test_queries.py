"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from oracle import from_spark, from_sql

QUERIES = {name: query for name, query in entry.queries().items() if name in entry.CATALOG}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in entry.CATALOG}


def test_entry_is_the_flagship_query(cluster):
    df = entry.entry(cluster)
    assert df.columns == ["category_id", "pv", "uv"]
    assert df.count() == 10


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(cluster, data, name):
    found = from_spark(QUERIES[name](cluster, data))
    wanted = from_sql(data, SQL[name])
    assert found == wanted


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_estimates_are_close(cluster, data, name):
    exact = {r.category_id: r for r in QUERIES["pv_uv_by_category"](cluster, data).collect()}
    rows = QUERIES[name](cluster, data).collect()
    assert {r.category_id for r in rows} == set(exact)
    for row in rows:
        assert row.pv == exact[row.category_id].pv
        assert abs(row.uv - exact[row.category_id].uv) <= max(2, 0.15 * exact[row.category_id].uv)
