"""Every registered query against its DuckDB oracle on the tables of sf0.01 (some results are
rightly empty on smaller ones)."""

import os

import pytest

import __spark_entry__ as E
from oracle_harness import compare, duck
from tidewater.plans.catalog import QUERIES

SF = os.environ.get("TIDEWATER_TEST_SF", "/root/testdata/sf0.01")
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert "oracle" not in r, "every query has an oracle"
    assert r["spark_rows"] > 0
    assert r["cols_match"], r
    assert r["types_match"], r
    assert r["values_match"], r
    spark.catalog.clearCache()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["event_type", "Date", "Agg_mean"]
    assert df.count() > 0
