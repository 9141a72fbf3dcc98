"""Invariants of SURVEY section 5 on the shared-table bindings."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from staffwise.operators import gold, marts, silver
from staffwise.sources import fixtures as fx


@pytest.fixture(scope="module")
def b(spark):
    return fx.Bindings(spark, SF0001)


def test_occupancy_null_iff_no_positive_beds(b):
    d = b.daily
    bad = d.where(
        F.col("occupancy_rate_proxy").isNull()
        != (F.col("certified_beds").isNull() | (F.col("certified_beds") <= 0))
    )
    assert bad.count() == 0
    assert d.where(F.col("occupancy_rate_proxy").isNull()).count() > 0  # the case occurs


def test_quarter_hours_sum_to_daily(b):
    daily = b.daily.agg(F.sum("total_nursing_hours")).first()[0]
    quarterly = b.quarterly.agg(F.sum("total_nursing_hours")).first()[0]
    assert quarterly == pytest.approx(daily)
    assert b.quarterly.agg(F.sum("days_reported")).first()[0] == b.daily.count()


def test_measure_join_row_count(b):
    measures = b.quality.groupBy("facility_ccn").agg(F.count(F.lit(1)).alias("m"))
    expected = (
        b.quarterly.join(measures, "facility_ccn", "left")
        .agg(F.sum(F.greatest(F.coalesce("m", F.lit(0)), F.lit(1)))).first()[0]
    )
    assert b.staffing_quality.count() == expected


def test_ranks_are_one_to_n_per_quarter(b):
    low = marts.low_staffing(marts.stg_quarterly(b.quarterly))
    per_q = low.groupBy("calendar_quarter").agg(
        F.count(F.lit(1)).alias("n"), F.min("staffing_rank").alias("lo"), F.max("staffing_rank").alias("hi"),
        F.count_distinct("staffing_rank").alias("d"))
    assert per_q.where((F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("d") != F.col("n"))).count() == 0


def test_valid_plus_rejected_is_cleaned(b):
    cleaned = silver.clean_staffing(b.pbj_raw)
    assert silver.valid_staffing(cleaned).count() + silver.rejected_staffing(cleaned).count() == cleaned.count()


def test_gold_daily_keeps_every_staffing_row_once(b):
    # the fixture's facility keys are unique, so the left join neither drops nor duplicates rows
    assert gold.facility_daily(b.staffing, b.facility).count() == b.staffing.count()
