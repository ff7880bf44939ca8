"""Every query against its SQL on the small data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points

from . import oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


# The training-data queries have tests of their own.
CORPUS = set(entry_points._corpus()[0])


def test_every_query_has_its_sql():
    assert set(entry_points.queries()) - CORPUS == set(entry_points.oracle_sql()) - CORPUS


@pytest.mark.parametrize("name", [name for name in entry_points.queries() if name not in CORPUS])
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(spark, con, SF, name) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["churn_risk", "customer_count"] and df.count() > 0
