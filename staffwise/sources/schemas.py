"""Explicit schemas of the Silver, Gold and mart tables.

Reading with these schemas avoids partition type inference (a state folder
holding only '01' would come back as an int) and keeps column order stable.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, DT = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType()


def _schema(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The eight staffing categories of the daily payroll file, as
# (source column stem, Silver column name).
STAFF_CATEGORIES = [
    ("Hrs_RN", "rn_hours"),
    ("Hrs_LPN", "lpn_hours"),
    ("Hrs_CNA", "cna_hours"),
    ("Hrs_RNDON", "director_rn_hours"),
    ("Hrs_RNadmin", "rn_admin_hours"),
    ("Hrs_LPNadmin", "lpn_admin_hours"),
    ("Hrs_NAtrn", "nurse_aide_training_hours"),
    ("Hrs_MedAide", "medication_aide_hours"),
]
SPLIT_STEMS = [stem for stem, _ in STAFF_CATEGORIES]
CATEGORY_HOURS = [name for _, name in STAFF_CATEGORIES]

SILVER_DAILY_STAFFING = _schema(
    [
        ("facility_ccn", S), ("work_date", DT), ("calendar_quarter", S),
        ("facility_name", S), ("state", S), ("resident_census", I),
    ]
    + [(name, D) for name in CATEGORY_HOURS]
    + [("employee_nursing_hours", D), ("contract_nursing_hours", D)]
)

SILVER_FACILITY = _schema(
    [
        ("facility_ccn", S), ("facility_name", S), ("state", S),
        ("certified_beds", I), ("average_residents_per_day", D),
        ("ownership_type", S), ("overall_rating", I), ("staffing_rating", I),
        ("nursing_staff_turnover", D), ("rn_turnover", D),
    ]
)

SILVER_QUALITY_MEASURES = _schema(
    [
        ("facility_ccn", S), ("state", S), ("quality_source", S),
        ("measure_code", S), ("measure_name", S), ("resident_type", S),
        ("measure_score", D), ("measure_period", S),
    ]
)

SILVER_HEALTH_CITATIONS = _schema(
    [
        ("facility_ccn", S), ("state", S), ("survey_date", DT),
        ("survey_type", S), ("deficiency_category", S),
        ("deficiency_tag_number", S), ("scope_severity_code", S),
        ("complaint_deficiency", S),
    ]
)

GOLD_DAILY = _schema(
    [(f.name, f.dataType) for f in SILVER_DAILY_STAFFING.fields]
    + [
        ("certified_beds", I), ("total_nursing_hours", D),
        ("staffing_hours_per_resident_day", D), ("rn_hours_per_resident_day", D),
        ("occupancy_rate_proxy", D),
    ]
)

GOLD_QUARTERLY = _schema(
    [
        ("facility_ccn", S), ("facility_name", S), ("state", S),
        ("calendar_quarter", S), ("days_reported", L),
        ("average_daily_census", D), ("average_staffing_hprd", D),
        ("average_rn_hprd", D), ("average_occupancy_rate", D),
        ("total_nursing_hours", D), ("employee_nursing_hours", D),
        ("contract_nursing_hours", D), ("contract_hour_percentage", D),
    ]
)

QUALITY_JOIN_COLUMNS = [
    "facility_ccn", "quality_source", "measure_code", "measure_name",
    "measure_score", "measure_period",
]

GOLD_STAFFING_QUALITY = _schema(
    [(f.name, f.dataType) for f in GOLD_QUARTERLY.fields]
    + [
        ("quality_source", S), ("measure_code", S), ("measure_name", S),
        ("measure_score", D), ("measure_period", S),
    ]
)

# Gold tables are partitioned on copies of these two columns, so the data
# columns themselves stay inside the files.
SHADOW_PARTITIONS = [("calendar_quarter", "s3_calendar_quarter"), ("state", "s3_state")]


def with_partitions(schema: T.StructType, names) -> T.StructType:
    """Schema plus string partition columns appended at the end (as Spark
    returns them on read)."""
    out = T.StructType(list(schema.fields))
    for n in names:
        out = out.add(n, S, True)
    return out


def without(schema: T.StructType, names) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in set(names)])
