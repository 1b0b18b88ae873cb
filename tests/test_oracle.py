"""The driver's correctness gate, in pytest: Spark query vs DuckDB oracle at
sf0.01 (row count, column names and types, order-insensitive values)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF01
from tests.oracle_check import SPARK_TO_DUCK, digest, duck

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF01)
    rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    dtypes = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes} == dtypes
    want = rel.fetchall()
    assert len(rows) == len(want)
    assert digest(sdf.columns, rows)[0] == digest(rel.columns, want)[0]
