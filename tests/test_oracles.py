"""Every registered query against its SQL on the smallest tables, and the shape of the registry."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

SF = "/root/testdata/sf0.001"

# Fits with many jobs; tests/test_vectors.py covers the operators behind them.
SLOW = {"kmeans", "k_curve", "k_report", "report_all", "cluster_run"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(queries()) - SLOW))
def test_query(spark, con, name):
    result = compare(spark, con, SF, name)
    assert result.startswith(("equal", "rows only")), result
    if name not in {"box_outliers"}:
        assert not result.endswith(" 0 rows"), result


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    rows = {r["class"]: r.n for r in entry(spark).collect()}
    assert rows == {"Low": 4, "Moderate": 13, "High": 16, "Very High": 0}
