"""Every registered query with SQL equals its DuckDB oracle on sf0.001."""

import math

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
QUERIES = entry.queries()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (2, v) if not math.isnan(v) else (1, "nan")
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    return (4, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def _close(a, b):
    if a == b:
        return True
    if a[0] == b[0] == 2:
        return abs(a[1] - b[1]) <= 1e-9 * max(1.0, abs(a[1]), abs(b[1]))
    return False


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    srows, scols = df.collect(), df.columns
    rel = duck.sql(SQL[name])
    dcols, drows = rel.columns, rel.fetchall()
    assert sorted(scols) == sorted(dcols)
    a, b = _rows(scols, srows), _rows(dcols, drows)
    assert len(a) == len(b)
    for ra, rb in zip(a, b):
        assert all(_close(x, y) for x, y in zip(ra, rb)), (ra, rb)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "total_item_cost", "total_option_cost", "total_cost_per_user",
                          "clv_percent", "clv_tag"]
    assert df.count() > 0
