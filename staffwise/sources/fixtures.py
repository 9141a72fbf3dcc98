"""Bindings of the domain tables to the shared test tables.

The shared tables (TPC-H-like ``lineitem``, ``supplier``, ``nation`` and an
``events`` stream) play the roles of the staffing, provider, measure and
citation files, so every operator runs on data whose size grows with the
scale factor. The same bindings are written as DuckDB SQL in
``staffwise.plans.oracle``; both sides must stay in step.

Roles: a supplier is a facility, a (supplier, ship date) pair is a
facility-day, a nation is a state, an events user is a facility with quality
measures and citations. Modulo rules on keys do not cut any input: every row
of every table is kept. They change texts into the dirty values (unparsable
dates, negative census, ...) and altered keys (facilities unknown to the
provider or the measure files) that the cleaning and join semantics need.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staffwise.functions import ccn
from staffwise.operators import silver
from staffwise.sources.schemas import SPLIT_STEMS, STAFF_CATEGORIES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wall_date(df: DataFrame, name: str) -> Column:
    """Calendar date of a timestamp column, independent of the session time
    zone: a plain cast for TIMESTAMP_NTZ (how these files are read by
    default), UTC epoch days when the column comes back as a session-local
    TIMESTAMP."""
    from pyspark.sql.types import TimestampType

    if isinstance(df.schema[name].dataType, TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(F.col(name)) / 86_400_000_000).cast("int"))
    return F.col(name).cast("date")


def _quarter_label(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string"))


def facility_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier with its nation -> (s_suppkey, s_name, s_acctbal, n_name)."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left").drop("n_nationkey", "s_nationkey")


def with_directory(facts: DataFrame, directory: DataFrame, key: str, *cols: str) -> DataFrame:
    """Facts with directory columns; a left join, so every fact row stays and only the directory can be broadcast."""
    d = directory.select("s_suppkey", *cols)
    return facts.join(d, facts[key] == d.s_suppkey, "left")


def _dir(spark: SparkSession, sf_dir: str, directory: DataFrame | None) -> DataFrame:
    return directory if directory is not None else facility_directory(spark, sf_dir)


# ---------------------------------------------------------------- staffing


def _category_quantity(line: int, status: str | None = None) -> Column:
    cond = F.col("l_linenumber") == line
    if status is not None:
        cond = cond & (F.col("l_linestatus") == status)
    return cond


# Category of each staffing column as a lineitem predicate (fixture rule).
CATEGORY_RULES = {
    "rn_hours": (1, None),
    "lpn_hours": (2, None),
    "cna_hours": (3, None),
    "director_rn_hours": (4, None),
    "rn_admin_hours": (5, None),
    "lpn_admin_hours": (6, None),
    "nurse_aide_training_hours": (7, "O"),
    "medication_aide_hours": (7, "F"),
}


def fx_staffing(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    """Silver daily staffing: one row per (supplier, ship date).

    lineitem is aggregated first (partial aggregation before the shuffle),
    then joined with the small directory for name and state.
    """
    li = table(spark, sf_dir, "lineitem")
    qty = F.col("l_quantity")
    day = li.withColumn("work_date", wall_date(li, "l_shipdate"))
    agg = day.groupBy("l_suppkey", "work_date").agg(
        F.sum(F.col("l_partkey") % 5).cast("int").alias("resident_census"),
        *[
            F.sum(F.when(_category_quantity(*rule), qty).otherwise(F.lit(0.0))).alias(name)
            for name, rule in CATEGORY_RULES.items()
        ],
        F.sum(F.when(F.col("l_returnflag") != "R", qty).otherwise(F.lit(0.0))).alias(
            "employee_nursing_hours"
        ),
        F.sum(F.when(F.col("l_returnflag") == "R", qty).otherwise(F.lit(0.0))).alias(
            "contract_nursing_hours"
        ),
    )
    return with_directory(agg, _dir(spark, sf_dir, directory), "l_suppkey", "s_name", "n_name").select(
        ccn("l_suppkey").alias("facility_ccn"),
        "work_date",
        _quarter_label(F.col("work_date")).alias("calendar_quarter"),
        F.trim("s_name").alias("facility_name"),
        F.trim("n_name").alias("state"),
        "resident_census",
        *CATEGORY_RULES.keys(),
        "employee_nursing_hours",
        "contract_nursing_hours",
    )


def fx_pbj_raw(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    """Raw daily staffing file (all strings, one row per lineitem) with the
    dirty values of a real payroll extract."""
    return _pbj_rows(table(spark, sf_dir, "lineitem"), _dir(spark, sf_dir, directory), [])


def _pbj_rows(li: DataFrame, directory: DataFrame, extra: list[Column]) -> DataFrame:
    j = with_directory(li, directory, "l_suppkey", "s_name", "n_name")
    ok, sk, pk = F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_partkey")
    day = wall_date(li, "l_shipdate")
    qty_text = F.col("l_quantity").cast("string")
    provnum = F.when(sk % 13 == 5, F.concat(F.lit(" A"), sk.cast("string"))).otherwise(
        F.concat(F.lit(" "), sk.cast("string"), F.lit(" "))
    )
    work_date = F.when(ok % 97 == 0, F.lit("bad")).otherwise(F.date_format(day, "yyyyMMdd"))
    census = (
        F.when(ok % 89 == 0, F.lit(None).cast("string"))
        .when(ok % 83 == 0, F.lit("-1"))
        .when(ok % 79 == 0, F.lit("12.7"))
        .when(ok % 73 == 0, F.lit("12d"))
        .when(ok % 71 == 0, F.lit("1e2"))
        .otherwise((pk % 5).cast("string"))
    )
    category_text = {}
    for stem, name in STAFF_CATEGORIES:
        cond = _category_quantity(*CATEGORY_RULES[name])
        text = F.when(cond, qty_text)
        if stem == "Hrs_RN":
            text = text.when(F.col("l_linenumber") == 2, F.lit("N/A"))
        category_text[stem] = text
    is_contract = F.col("l_returnflag") == "R"
    split_cols = []
    for stem in SPLIT_STEMS:
        split_cols.append(F.when(~is_contract, category_text[stem]).alias(f"{stem}_emp"))
        split_cols.append(F.when(is_contract, category_text[stem]).alias(f"{stem}_ctr"))
    return j.select(
        provnum.alias("PROVNUM"),
        work_date.alias("WorkDate"),
        _quarter_label(day).alias("CY_Qtr"),
        F.concat(F.lit(" "), F.col("s_name")).alias("PROVNAME"),
        F.col("n_name").alias("STATE"),
        census.alias("MDScensus"),
        *[category_text[stem].alias(stem) for stem, _ in STAFF_CATEGORIES],
        *split_cols,
        *extra,
    )


def fx_profile_raw(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    """The raw staffing file with an empty column, a truth-value column and
    numbers with a letter behind them, for the profiling types."""
    li = table(spark, sf_dir, "lineitem")
    extra = [
        F.lit(None).cast("string").alias("Notes"),
        F.when(F.col("l_returnflag") == "R", F.lit("True")).otherwise(F.lit("FALSE")).alias("Is_Contract"),
        F.concat((F.col("l_linenumber") % 3).cast("string"), F.when(F.col("l_linenumber") % 2 == 0, F.lit("d")).otherwise(F.lit("f"))).alias("Shift_Code"),
    ]
    return _pbj_rows(li, _dir(spark, sf_dir, directory), extra)


# ---------------------------------------------------------------- facility


def fx_provider_raw(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    """Raw provider file: every supplier; one in seven is under another key,
    so its facility is unknown to the provider file."""
    d = _dir(spark, sf_dir, directory)
    sk = F.col("s_suppkey")
    beds = F.when(sk % 10 == 0, F.lit(0)).otherwise(F.lit(5) + sk % 20)
    return d.select(
        F.concat(F.when(sk % 7 == 3, F.lit(" P")).otherwise(F.lit(" ")), sk.cast("string")).alias(silver.CCN_HEADER),
        F.concat(F.col("s_name"), F.lit(" ")).alias("Provider Name"),
        F.col("n_name").alias("State"),
        beds.cast("string").alias("Number of Certified Beds"),
        F.col("s_acctbal").cast("string").alias("Average Number of Residents per Day"),
        F.when(sk % 3 == 0, F.lit("For profit"))
        .when(sk % 3 == 1, F.lit("Non profit"))
        .otherwise(F.lit("Government"))
        .alias("Ownership Type"),
        (F.lit(1) + sk % 5).cast("string").alias("Overall Rating"),
        F.when(sk % 11 == 0, F.lit("N/A"))
        .otherwise((F.lit(1) + sk % 4).cast("string"))
        .alias("Staffing Rating"),
        (sk % 60).cast("string").alias("Total nursing staff turnover"),
        F.when(sk % 4 == 0, F.lit(None).cast("string"))
        .otherwise((sk % 45).cast("string"))
        .alias("Registered Nurse turnover"),
    )


def fx_facility(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    return silver.clean_facility(fx_provider_raw(spark, sf_dir, directory))


# ---------------------------------------------------------------- measures

# Measure descriptions of the fixture (event type -> name).
SIGNUP_TYPE = "signup"
ERROR_TYPE = "error"
ERROR_MEASURE_NAME = "Short-stay Rehospitalization"


def _measure_base(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    """events per (user, event type) with the user's state; one user in eight
    is under another key, so its facility has no measures."""
    base = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.avg("value").alias("score"))
    uid = F.col("user_id")
    key = F.concat(F.when(uid % 8 == 0, F.lit("M")).otherwise(F.lit("")), uid.cast("string"))
    return with_directory(base, _dir(spark, sf_dir, directory), "user_id", "n_name").withColumn("ccn_text", key)


def fx_claims_raw(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    b = _measure_base(spark, sf_dir, directory).where(F.col("event_type") != SIGNUP_TYPE)
    et = F.col("event_type")
    null_score = (et == ERROR_TYPE) & (F.col("user_id") % 9 == 0)
    return b.select(
        F.col("ccn_text").alias(silver.CCN_HEADER),
        F.col("n_name").alias("State"),
        et.alias("Measure Code"),
        F.when(et == ERROR_TYPE, F.lit(ERROR_MEASURE_NAME))
        .otherwise(F.concat(F.lit("Other "), et))
        .alias("Measure Description"),
        F.when(et == ERROR_TYPE, F.lit("Short Stay")).otherwise(F.lit("Long Stay")).alias(
            "Resident type"
        ),
        F.when(null_score, F.lit(None).cast("string"))
        .otherwise(F.col("score").cast("string"))
        .alias("Adjusted Score"),
        F.lit("2024").alias("Measure Period"),
    )


def fx_vbp_raw(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    b = _measure_base(spark, sf_dir, directory).where(F.col("event_type") == SIGNUP_TYPE)
    return b.select(
        F.col("ccn_text").alias(silver.CCN_HEADER),
        F.col("n_name").alias("State"),
        F.col("score").cast("string").alias(silver.VBP_SCORE_HEADER),
    )


def fx_quality(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    d = _dir(spark, sf_dir, directory)
    return silver.quality_measures(fx_claims_raw(spark, sf_dir, d), fx_vbp_raw(spark, sf_dir, d))


# --------------------------------------------------------------- citations


def fx_citations_raw(spark: SparkSession, sf_dir: str, directory: DataFrame | None = None) -> DataFrame:
    """Raw citations file: one deficiency per event; every 50th event has a
    non-padded survey date (M/d/yyyy), which does not parse."""
    ev = table(spark, sf_dir, "events")
    j = with_directory(ev, _dir(spark, sf_dir, directory), "user_id", "n_name")
    eid = F.col("event_id")
    day = wall_date(ev, "ts")
    return j.select(
        F.col("user_id").cast("string").alias(silver.CCN_HEADER),
        F.col("n_name").alias("State"),
        F.when(eid % 50 == 0, F.date_format(day, "M/d/yyyy"))
        .otherwise(F.date_format(day, "MM/dd/yyyy"))
        .alias("Survey Date"),
        F.when(eid % 2 == 0, F.lit("Health")).otherwise(F.lit("Fire Safety")).alias("Survey Type"),
        F.col("event_type").alias("Deficiency Category"),
        F.lpad((eid % 1000).cast("string"), 4, "0").alias("Deficiency Tag Number"),
        F.substring(F.lit("ABCDEFGHIJKL"), (eid % 12 + 1).cast("int"), 1).alias(
            "Scope Severity Code"
        ),
        F.when(F.col("event_type") == ERROR_TYPE, F.lit("Y")).otherwise(F.lit("N")).alias(
            "Complaint Deficiency"
        ),
    )


# -------------------------------------------------------------- Gold chain


class Bindings:
    """Every binding of one folder of shared tables, each built once, so a
    query that needs several layers reuses the same sub-plans and Spark can
    reuse their exchanges."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def directory(self) -> DataFrame:
        return facility_directory(self.spark, self.sf_dir)

    @cached_property
    def staffing(self) -> DataFrame:
        return fx_staffing(self.spark, self.sf_dir, self.directory)

    @cached_property
    def pbj_raw(self) -> DataFrame:
        return fx_pbj_raw(self.spark, self.sf_dir, self.directory)

    @cached_property
    def profile_raw(self) -> DataFrame:
        return fx_profile_raw(self.spark, self.sf_dir, self.directory)

    @cached_property
    def facility(self) -> DataFrame:
        return fx_facility(self.spark, self.sf_dir, self.directory)

    @cached_property
    def quality(self) -> DataFrame:
        return fx_quality(self.spark, self.sf_dir, self.directory)

    @cached_property
    def citations_raw(self) -> DataFrame:
        return fx_citations_raw(self.spark, self.sf_dir, self.directory)

    @cached_property
    def daily(self) -> DataFrame:
        from staffwise.operators import gold

        return gold.facility_daily(self.staffing, self.facility)

    @cached_property
    def quarterly(self) -> DataFrame:
        from staffwise.operators import gold

        return gold.facility_quarterly(self.daily)

    @cached_property
    def staffing_quality(self) -> DataFrame:
        from staffwise.operators import gold

        return gold.staffing_quality(self.quarterly, self.quality)


def fx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Bindings(spark, sf_dir).daily


def fx_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Bindings(spark, sf_dir).quarterly


def fx_staffing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Bindings(spark, sf_dir).staffing_quality
