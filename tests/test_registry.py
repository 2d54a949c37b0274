"""Every comparison SQL belongs to a query; a few queries end to end on the smallest data."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle_check import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_registry():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
@pytest.mark.parametrize("key", ["dedup_by_key", "interpolate_linear", "lag_features", "p95_rollup", "breach_report"])
def test_against_sql(spark, key):
    verdict = compare(queries()[key](spark, SMALL).toPandas(), connect(SMALL).execute(oracle_sql()[key]).df())
    # a value halfway between two roundings may fall either way
    assert verdict == "" or "only in the last digits" in verdict


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
def test_heatmap_has_all_days(spark):
    mine = queries()["risk_heatmap_days"](spark, SMALL).toPandas()
    codes = queries()["risk_codes"](spark, SMALL).toPandas()
    assert mine.timestamp.nunique() == codes.timestamp.nunique() > 7
    assert len(mine) == codes.server_id.nunique() * codes.timestamp.nunique() and not mine.duplicated(["server_id", "timestamp"]).any()
    assert compare(mine, connect(SMALL).execute(oracle_sql()["risk_heatmap_days"]).df()) == ""
