"""Every registered query with reference SQL equals DuckDB on the smallest scale factor."""

import math

import pytest

from flowsift.catalog import load

QUERIES, ORACLES = load()


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return 0.0 if v == 0 and isinstance(v, float) else v


def rows_of(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, sorted(([plain(v) for v in r] for r in zip(*data)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, oracle, name):
    got = rows_of(QUERIES[name](spark, sf).toArrow())
    want = rows_of(oracle.execute(ORACLES[name]).to_arrow_table())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
