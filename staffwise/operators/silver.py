"""Bronze -> Silver cleaning: typed projections, validity filter, union.

All functions are map-only (no shuffle): a projection per input row, so
they scale linearly with the input files and keep Spark's file splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staffwise.functions import (
    ccn,
    hours,
    parse_date,
    sum_columns,
    to_double,
    to_int,
    typed_null,
)
from staffwise.functions.columns import STAFFING_DATE_FORMAT, SURVEY_DATE_FORMAT
from staffwise.sources.schemas import SPLIT_STEMS, STAFF_CATEGORIES

# Source header names of the CMS files.
CCN_HEADER = "CMS Certification Number (CCN)"
VBP_SCORE_HEADER = "Performance Period: FY 2022 Risk-Standardized Readmission Rate"

# Constant tags of the two quality-measure sources.
CLAIMS_SOURCE = "claims_quality_measure"
VBP_SOURCE = "vbp_readmission_rate"
VBP_MEASURE_CODE = "FY2022_READMISSION_RATE"
VBP_MEASURE_NAME = "FY 2022 Risk-Standardized Readmission Rate"
VBP_MEASURE_PERIOD = "FY 2022"

# A valid facility key is exactly six digits.
VALID_CCN_PATTERN = "^[0-9]{6}$"


def clean_staffing(raw: DataFrame) -> DataFrame:
    """Daily payroll staffing file (all strings) -> 16 typed columns."""
    return raw.select(
        ccn("PROVNUM").alias("facility_ccn"),
        parse_date("WorkDate", STAFFING_DATE_FORMAT).alias("work_date"),
        F.col("CY_Qtr").alias("calendar_quarter"),
        F.trim("PROVNAME").alias("facility_name"),
        F.trim("STATE").alias("state"),
        to_int("MDScensus").alias("resident_census"),
        *[hours(stem).alias(name) for stem, name in STAFF_CATEGORIES],
        sum_columns(hours(f"{s}_emp") for s in SPLIT_STEMS).alias("employee_nursing_hours"),
        sum_columns(hours(f"{s}_ctr") for s in SPLIT_STEMS).alias("contract_nursing_hours"),
    )


def _validity_checks() -> list[tuple[str, Column]]:
    return [
        ("invalid_ccn", F.coalesce(F.col("facility_ccn").rlike(VALID_CCN_PATTERN), F.lit(False))),
        ("missing_work_date", F.col("work_date").isNotNull()),
        ("invalid_census", F.coalesce(F.col("resident_census") >= 0, F.lit(False))),
    ]


def is_valid_staffing_row() -> Column:
    """Six-digit facility key AND parsed work date AND census >= 0."""
    checks = [c for _, c in _validity_checks()]
    return checks[0] & checks[1] & checks[2]


def valid_staffing(staffing: DataFrame) -> DataFrame:
    """Rows that pass the validity filter (NULL census or key fails)."""
    return staffing.where(is_valid_staffing_row())


def reject_reason() -> Column:
    """Name of the first failing validity check, NULL for valid rows."""
    expr = None
    for reason, ok in _validity_checks():
        expr = F.when(~ok, F.lit(reason)) if expr is None else expr.when(~ok, F.lit(reason))
    return expr


def rejected_staffing(staffing: DataFrame) -> DataFrame:
    """Complement of ``valid_staffing`` with the reason of rejection."""
    return staffing.withColumn("reject_reason", reject_reason()).where(
        F.col("reject_reason").isNotNull()
    )


def rejected_reason_counts(staffing: DataFrame) -> DataFrame:
    """Rejected rows per reason: (reject_reason, rejected_rows).

    A grouped count with partial aggregation: a hot reason is pre-counted
    in every task before the (tiny) shuffle.
    """
    return (
        rejected_staffing(staffing)
        .groupBy("reject_reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )


def clean_facility(provider: DataFrame) -> DataFrame:
    """Provider information file -> 10 typed facility columns."""
    # fixed values: the source headers and the output names
    return provider.select(
        ccn(CCN_HEADER).alias("facility_ccn"),
        F.trim("Provider Name").alias("facility_name"),
        F.trim("State").alias("state"),
        to_int("Number of Certified Beds").alias("certified_beds"),
        to_double("Average Number of Residents per Day").alias("average_residents_per_day"),
        F.col("Ownership Type").alias("ownership_type"),
        to_int("Overall Rating").alias("overall_rating"),
        to_int("Staffing Rating").alias("staffing_rating"),
        to_double("Total nursing staff turnover").alias("nursing_staff_turnover"),
        to_double("Registered Nurse turnover").alias("rn_turnover"),
    )


def clean_claims_measures(claims: DataFrame) -> DataFrame:
    """Claims-based quality measures file -> measure rows."""
    # fixed values: the source headers and the output names
    return claims.select(
        ccn(CCN_HEADER).alias("facility_ccn"),
        F.trim("State").alias("state"),
        F.lit(CLAIMS_SOURCE).alias("quality_source"),
        F.col("Measure Code").alias("measure_code"),
        F.col("Measure Description").alias("measure_name"),
        F.col("Resident type").alias("resident_type"),
        to_double("Adjusted Score").alias("measure_score"),
        F.col("Measure Period").alias("measure_period"),
    )


def clean_vbp_measures(vbp: DataFrame) -> DataFrame:
    """Value-based purchasing file: one wide score column -> measure rows."""
    return vbp.select(
        ccn(CCN_HEADER).alias("facility_ccn"),
        F.trim("State").alias("state"),
        F.lit(VBP_SOURCE).alias("quality_source"),
        F.lit(VBP_MEASURE_CODE).alias("measure_code"),
        F.lit(VBP_MEASURE_NAME).alias("measure_name"),
        typed_null("string").alias("resident_type"),
        to_double(VBP_SCORE_HEADER).alias("measure_score"),
        F.lit(VBP_MEASURE_PERIOD).alias("measure_period"),
    )


def quality_measures(claims: DataFrame, vbp: DataFrame) -> DataFrame:
    """Union by column name of the two cleaned measure sources."""
    return clean_claims_measures(claims).unionByName(clean_vbp_measures(vbp))


def clean_citations(citations: DataFrame) -> DataFrame:
    """Health citations file -> 8 typed columns (survey date MM/dd/yyyy)."""
    # fixed values: the source headers and the output names
    return citations.select(
        ccn(CCN_HEADER).alias("facility_ccn"),
        F.trim("State").alias("state"),
        parse_date("Survey Date", SURVEY_DATE_FORMAT).alias("survey_date"),
        F.col("Survey Type").alias("survey_type"),
        F.col("Deficiency Category").alias("deficiency_category"),
        F.col("Deficiency Tag Number").alias("deficiency_tag_number"),
        F.col("Scope Severity Code").alias("scope_severity_code"),
        F.col("Complaint Deficiency").alias("complaint_deficiency"),
    )
