"""Driver queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the shared tables through the bindings in
``staffwise.sources.fixtures`` and runs over whole tables. Averages of
doubles are rounded to 6 decimals here (and in the matching DuckDB SQL in
``staffwise.plans.oracle``) because two engines sum in different orders;
the library operators themselves return unrounded values.
"""

from __future__ import annotations

import uuid
from typing import Callable, Dict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffwise.functions import bronze_key, round_half_up, sum_columns
from staffwise.operators import checks, marts, pages, profiling, silver
from staffwise.sources import fixtures as fx
from staffwise.sources import readers, writers
from staffwise.sources.schemas import CATEGORY_HOURS

QueryFn = Callable[[SparkSession, str], DataFrame]

AVG_COLUMNS = [
    "average_daily_census", "average_staffing_hprd", "average_rn_hprd",
    "average_occupancy_rate", "average_occupancy_percent",
]


def r6(df: DataFrame, cols=None) -> DataFrame:
    """Round the named (default: average) double columns to 6 decimals."""
    names = [c for c in (cols or AVG_COLUMNS + ["measure_score"]) if c in df.columns]
    return df.withColumns({c: round_half_up(c, 6) for c in names})


# ------------------------------------------------------------------ Silver


def _bindings(spark, d) -> fx.Bindings:
    return fx.Bindings(spark, d)


def _clean(b: fx.Bindings) -> DataFrame:
    return silver.clean_staffing(b.pbj_raw)


def q_clean_staffing(spark, d):
    return _clean(_bindings(spark, d))


def q_valid_staffing(spark, d):
    return silver.valid_staffing(_clean(_bindings(spark, d)))


def q_rejected_staffing_reasons(spark, d):
    return silver.rejected_reason_counts(_clean(_bindings(spark, d)))


def q_duplicate_keys(spark, d):
    return checks.duplicate_key_count(_clean(_bindings(spark, d)), ["facility_ccn", "work_date"])


def q_horizontal_hours(spark, d):
    s = _clean(_bindings(spark, d))
    return s.select(
        "facility_ccn", "work_date",
        sum_columns(CATEGORY_HOURS).alias("total_nursing_hours"),
        "employee_nursing_hours", "contract_nursing_hours",
    )


def q_union_measures(spark, d):
    return r6(_bindings(spark, d).quality)


def q_clean_facility(spark, d):
    return _bindings(spark, d).facility


def q_clean_citations(spark, d):
    return silver.clean_citations(_bindings(spark, d).citations_raw)


# -------------------------------------------------------------------- Gold


def q_facility_daily(spark, d):
    return _bindings(spark, d).daily


def q_facility_quarterly(spark, d):
    return r6(_bindings(spark, d).quarterly)


def q_staffing_quality(spark, d):
    return r6(_bindings(spark, d).staffing_quality)


# --------------------------------------------------------- staging + marts


def _stg_quarterly(b: fx.Bindings) -> DataFrame:
    return marts.stg_quarterly(b.quarterly)


def _state_summary(b: fx.Bindings) -> DataFrame:
    return marts.state_summary(_stg_quarterly(b))


def _low_staffing(b: fx.Bindings) -> DataFrame:
    return marts.low_staffing(_stg_quarterly(b))


def _readmission(b: fx.Bindings) -> DataFrame:
    return marts.readmission_quality(marts.stg_quality(b.staffing_quality))


def q_stg_daily(spark, d):
    return marts.stg_daily(_bindings(spark, d).daily)


def q_stg_quarterly(spark, d):
    return r6(_stg_quarterly(_bindings(spark, d)))


def q_stg_quality(spark, d):
    return r6(marts.stg_quality(_bindings(spark, d).staffing_quality))


def q_state_summary(spark, d):
    return _state_summary(_bindings(spark, d))


def q_low_staffing(spark, d):
    return r6(_low_staffing(_bindings(spark, d)))


def q_readmission_quality(spark, d):
    return r6(_readmission(_bindings(spark, d)))


def q_not_null_results(spark, d):
    b = _bindings(spark, d)
    stg_q = marts.stg_quarterly(b.quarterly)
    key, staged = ["facility_ccn"], marts.is_staged()
    # models that only filter their source are tested in the source's pass
    return checks.not_null_results(
        {
            "FACILITY_DAILY_STAFFING": (b.daily, key),
            "stg_facility_daily_staffing": (b.daily, ["facility_ccn", "work_date"], staged),
            "FACILITY_QUARTERLY_SUMMARY": (b.quarterly, key),
            "stg_facility_quarterly_summary": (b.quarterly, key, staged),
            "STAFFING_QUALITY_ANALYSIS": (b.staffing_quality, key),
            "stg_staffing_quality_analysis": (b.staffing_quality, key, staged),
            "mart_staffing_quality": (b.staffing_quality, key, staged & marts.is_readmission()),
            "mart_state_staffing_summary": (marts.state_summary(stg_q), ["state"]),
            "mart_low_staffing_facilities": (marts.low_staffing(stg_q), key),
        }
    )


# --------------------------------------------------------------- profiling

PROFILE_NAME = "PBJ_Daily_Nurse_Staffing"


def _raw(spark, d):
    return _bindings(spark, d).profile_raw


def q_profile_overview(spark, d):
    return profiling.profile_overview(_raw(spark, d), PROFILE_NAME)


def q_profile_dictionary(spark, d):
    return profiling.profile_dictionary(_raw(spark, d))


def q_profile_missing(spark, d):
    return profiling.profile_missing(_raw(spark, d))


def q_profile_statistics(spark, d):
    """As in the profile job, the histogram is stored once: ten steps read it."""
    raw = _raw(spark, d)
    hist = writers.stored(profiling.value_histogram(raw), f"{_folder(spark)}/histogram")
    return r6(profiling.profile_statistics(raw, hist=hist), ["mean", "std", "p25", "p50", "p75"])


def q_profile_quality(spark, d):
    return profiling.profile_quality(_raw(spark, d))


def q_profile_sample(spark, d):
    raw = _raw(spark, d)
    return profiling.profile_sample(raw, order_by=raw.columns)


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


def q_profile_sample_roundtrip_files(spark, d):
    """Orders written by key as eight files; the first rows of the first file."""
    path = f"{_folder(spark)}/orders"
    by_key = fx.table(spark, d, "orders").select(*ORDER_COLUMNS).repartitionByRange(8, "o_orderkey")
    by_key.sortWithinPartitions("o_orderkey").write.parquet(path)
    return profiling.profile_sample(spark.read.parquet(path))


def q_profile_overview_roundtrip_files(spark, d):
    """Orders without their key written as lines of text, their overview with the input size."""
    path, names = f"{_folder(spark)}/orders", ORDER_COLUMNS[1:]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names]
    fx.table(spark, d, "orders").select(F.concat_ws(",", *cells).alias("value")).write.text(path)
    raw = spark.read.schema(", ".join(f"{c} string" for c in names)).csv(path)
    return profiling.profile_overview(raw, "orders", profiling.input_size(raw))


# ------------------------------------------------------------------- pages


def q_filter_values(spark, d):
    b = _bindings(spark, d)
    return pages.filter_values(_state_summary(b), _readmission(b))


def q_overview_kpis(spark, d):
    return r6(pages.overview_kpis(_state_summary(_bindings(spark, d))))


def q_overview_bar(spark, d):
    return pages.overview_bar(_state_summary(_bindings(spark, d)))


def q_overview_scatter(spark, d):
    return pages.overview_scatter(_state_summary(_bindings(spark, d)))


def q_state_grouped_bar(spark, d):
    return pages.state_grouped_bar(_state_summary(_bindings(spark, d)))


def q_contractor_bar(spark, d):
    return pages.contractor_bar(_state_summary(_bindings(spark, d)))


def q_state_table(spark, d):
    return pages.state_table(_state_summary(_bindings(spark, d)))


def q_watchlist_scatter(spark, d):
    return r6(pages.watchlist_scatter(_low_staffing(_bindings(spark, d))))


def q_watchlist_table(spark, d):
    return r6(pages.watchlist_table(_low_staffing(_bindings(spark, d))))


def q_quality_scatter(spark, d):
    return r6(pages.quality_scatter(_readmission(_bindings(spark, d))))


def q_quality_detail(spark, d):
    return r6(pages.quality_detail(_readmission(_bindings(spark, d))))


# Filter values for the page queries run with explicit selections.
PAGE_QUARTER = "1998Q3"
PAGE_STATES = ["NATION_12", "NATION_13", "NATION_3", "NATION_5", "NATION_9"]
PAGE_SOURCE = "claims_quality_measure"


def q_state_table_selected(spark, d):
    return pages.state_table(_state_summary(_bindings(spark, d)), quarter=PAGE_QUARTER, states=PAGE_STATES)


def q_watchlist_table_selected(spark, d):
    return r6(pages.watchlist_table(_low_staffing(_bindings(spark, d)), quarter=PAGE_QUARTER, states=PAGE_STATES))


def q_quality_detail_claims(spark, d):
    return r6(pages.quality_detail(_readmission(_bindings(spark, d)), source=PAGE_SOURCE))


def q_state_table_display(spark, d):
    return pages.display_table(pages.state_table(_state_summary(_bindings(spark, d))), "state_table")


def q_quality_detail_display(spark, d):
    return pages.display_table(pages.quality_detail(_readmission(_bindings(spark, d))), "quality_detail")


# --------------------------------------------------------------- sources


def _folder(spark) -> str:
    """A new folder below the session's shared folder."""
    return f"{readers.shared_dir(spark)}/roundtrip-{uuid.uuid4().hex}"


def q_parquet_roundtrip_gold(spark, d):
    """Write Gold quarterly with shadow partitions under the session's
    shared folder, read it back with the explicit schema."""
    path = f"{_folder(spark)}/gold_facility_quarterly_summary"
    writers.write_gold(_bindings(spark, d).quarterly, path)
    back = readers.read_gold_quarterly(spark, path)
    return r6(back.select(*[c for c in back.columns if not c.startswith("s3_")]))


def _bronze_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).option("encoding", readers.BRONZE_CHARSET).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


def q_csv_roundtrip_staffing(spark, d):
    """Raw staffing as a Bronze CSV folder, read back and cleaned."""
    path = _bronze_csv(_bindings(spark, d).pbj_raw, f"{_folder(spark)}/{readers.STAFFING_FILE}")
    return silver.clean_staffing(readers.read_bronze_csv(spark, path))


def q_csv_roundtrip_supporting(spark, d):
    """The four supporting files as Bronze CSV folders, read back; their measures."""
    b, folder = _bindings(spark, d), _folder(spark)
    raw = {
        readers.PROVIDER_FILE: fx.fx_provider_raw(spark, d, b.directory), readers.CLAIMS_FILE: fx.fx_claims_raw(spark, d, b.directory),
        readers.VBP_FILE: fx.fx_vbp_raw(spark, d, b.directory), readers.CITATIONS_FILE: b.citations_raw,
    }
    for name, df in raw.items():
        _bronze_csv(df, readers.bronze_file(folder, name))
    back = readers.read_supporting(spark, folder)
    return r6(silver.quality_measures(back["claims"], back["vbp"]))


def q_silver_roundtrip_staffing(spark, d):
    """Valid staffing written as Silver by state, read back."""
    path = f"{_folder(spark)}/silver_daily_staffing"
    writers.write_silver(silver.valid_staffing(_clean(_bindings(spark, d))), path)
    return readers.read_silver_staffing(spark, path)


def q_report_roundtrip_missing(spark, d):
    """The missing-value table written as a report folder, read back."""
    folder = _folder(spark)
    writers.write_report({"missing_values": profiling.profile_missing(_raw(spark, d))}, folder)
    return spark.read.parquet(f"{folder}/missing_values")


def q_catalog_roundtrip_state_summary(spark, d):
    """Quarterly Gold saved as its RAW table, the state summary built from the
    source and saved as a mart, and the mart loaded by its page key."""
    database = f"staffwise_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    writers.save_table(_bindings(spark, d).quarterly, readers.source_table("FACILITY_QUARTERLY_SUMMARY", database))
    quarterly = readers.source(spark, "FACILITY_QUARTERLY_SUMMARY", database)
    mart = f"{database}.{readers.MARTS['state_summary']}"
    writers.save_table(marts.state_summary(marts.stg_quarterly(quarterly)), mart)
    return readers.load_mart(spark, mart)


def q_bronze_key(spark, d):
    pg = fx.table(spark, d, "pages")
    return pg.select("page_id", bronze_key("/bronze/pages/", F.col("url")).alias("bronze_key"))


QUERIES: Dict[str, QueryFn] = {
    "clean_staffing": q_clean_staffing,
    "valid_staffing": q_valid_staffing,
    "rejected_staffing_reasons": q_rejected_staffing_reasons,
    "duplicate_keys": q_duplicate_keys,
    "horizontal_hours": q_horizontal_hours,
    "union_measures": q_union_measures,
    "clean_facility": q_clean_facility,
    "clean_citations": q_clean_citations,
    "facility_daily": q_facility_daily,
    "facility_quarterly": q_facility_quarterly,
    "staffing_quality": q_staffing_quality,
    "stg_daily": q_stg_daily,
    "stg_quarterly": q_stg_quarterly,
    "stg_quality": q_stg_quality,
    "state_summary": q_state_summary,
    "low_staffing": q_low_staffing,
    "readmission_quality": q_readmission_quality,
    "not_null_results": q_not_null_results,
    "profile_overview": q_profile_overview,
    "profile_dictionary": q_profile_dictionary,
    "profile_missing": q_profile_missing,
    "profile_statistics": q_profile_statistics,
    "profile_quality": q_profile_quality,
    "profile_sample": q_profile_sample,
    "profile_sample_roundtrip_files": q_profile_sample_roundtrip_files,
    "profile_overview_roundtrip_files": q_profile_overview_roundtrip_files,
    "filter_values": q_filter_values,
    "overview_kpis": q_overview_kpis,
    "overview_bar": q_overview_bar,
    "overview_scatter": q_overview_scatter,
    "state_grouped_bar": q_state_grouped_bar,
    "contractor_bar": q_contractor_bar,
    "state_table": q_state_table,
    "watchlist_scatter": q_watchlist_scatter,
    "watchlist_table": q_watchlist_table,
    "quality_scatter": q_quality_scatter,
    "quality_detail": q_quality_detail,
    "state_table_selected": q_state_table_selected,
    "watchlist_table_selected": q_watchlist_table_selected,
    "quality_detail_claims": q_quality_detail_claims,
    "state_table_display": q_state_table_display,
    "quality_detail_display": q_quality_detail_display,
    "parquet_roundtrip_gold": q_parquet_roundtrip_gold,
    "csv_roundtrip_staffing": q_csv_roundtrip_staffing,
    "csv_roundtrip_supporting": q_csv_roundtrip_supporting,
    "silver_roundtrip_staffing": q_silver_roundtrip_staffing,
    "report_roundtrip_missing": q_report_roundtrip_missing,
    "catalog_roundtrip_state_summary": q_catalog_roundtrip_state_summary,
    "bronze_key": q_bronze_key,
}
