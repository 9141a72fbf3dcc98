"""Every registered driver query against its DuckDB SQL twin.

sf0.001 for all queries (fast); the headline chain also at sf0.01, the
scale the driver checks.
"""

import pytest

import harness
from conftest import SF0001, SF001

import __spark_entry__ as E

from staffwise.plans.oracle import ORACLE
from staffwise.plans.queries import QUERIES

HEADLINE = ["clean_staffing", "valid_staffing", "duplicate_keys", "facility_daily", "facility_quarterly",
            "staffing_quality", "state_summary", "low_staffing", "readmission_quality", "overview_kpis"]


@pytest.fixture(scope="module")
def con_small():
    return harness.duck(SF0001)


@pytest.fixture(scope="module")
def con_mid():
    return harness.duck(SF001)


def test_every_query_has_oracle_or_is_documented():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle_sf0001(spark, con_small, name):
    r = harness.compare(spark, name, QUERIES[name], ORACLE[name], SF0001, con_small)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("name", HEADLINE)
def test_headline_matches_oracle_sf001(spark, con_mid, name):
    r = harness.compare(spark, name, QUERIES[name], ORACLE[name], SF001, con_mid)
    assert r["spark_rows"] == r["oracle_rows"] and r["hash_match"], r


def test_probed_row_counts_sf001(spark):
    expected = {"facility_daily": 53307, "facility_quarterly": 2800, "staffing_quality": 12544,
                "state_summary": 700, "low_staffing": 280, "readmission_quality": 4592,
                "valid_staffing": 52035, "clean_staffing": 60000}
    for name, n in expected.items():
        assert QUERIES[name](spark, SF001).count() == n, name
    assert QUERIES["duplicate_keys"](spark, SF001).first()["duplicate_keys"] == 6158


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 280
    assert df.columns == ["state", "calendar_quarter", "facility_count", "average_daily_census",
                          "average_staffing_hprd", "average_rn_hprd", "average_occupancy_percent",
                          "average_contract_hour_percent"]
