"""Data sets behind the four report pages (rendering is not built).

Each page function takes a mart DataFrame plus filter values and returns
only the rows the page shows. Filters are column predicates, so they reach
the Parquet scan of a mart or Gold table; the default quarter ("latest") is
a scalar subquery, not a driver-side collect.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staffwise.operators.checks import assert_not_empty
from staffwise.functions import fixed_text, percent_text, round_half_up, thousands_text, to_percent

ALL_SOURCES = "All sources"


def choose_quarter(df: DataFrame, quarter: Optional[str] = None) -> DataFrame:
    """Rows of one quarter (default: the latest, compared as text). Tables
    without a quarter column pass through."""
    if "calendar_quarter" not in df.columns:
        return df
    q = F.col("calendar_quarter")
    if quarter is not None:
        return df.where(q == F.lit(quarter))
    latest = df.agg(F.max("calendar_quarter")).scalar()
    return df.where(q == latest)


def filter_states(df: DataFrame, states: Optional[Sequence[str]] = None) -> DataFrame:
    """Rows of the selected states (default: every non-null state)."""
    if states is None:
        return df.where(F.col("state").isNotNull())
    return df.where(F.col("state").isin(list(states)))


def with_occupancy_percent(df: DataFrame) -> DataFrame:
    """Add occupancy in percent when the rate column exists."""
    if "average_occupancy_rate" in df.columns:
        return df.withColumn("average_occupancy_percent", to_percent("average_occupancy_rate"))
    return df


def _state_page(state_summary: DataFrame, quarter, states) -> DataFrame:
    return filter_states(choose_quarter(state_summary, quarter), states)


# ------------------------------------------------------------- overview


def overview_kpis(state_summary: DataFrame, quarter=None, states=None) -> DataFrame:
    """One row: facilities (sum of distinct counts per state) and plain means
    over states of the rounded state averages, with display texts."""
    d = _state_page(state_summary, quarter, states)
    kpi = d.agg(
        F.max("calendar_quarter").alias("calendar_quarter"),
        F.sum("facility_count").cast("long").alias("total_facilities"),
        F.avg("average_staffing_hprd").alias("average_staffing_hprd"),
        F.avg("average_rn_hprd").alias("average_rn_hprd"),
        F.avg("average_occupancy_percent").alias("average_occupancy_percent"),
        F.count(F.lit(1)).alias("states"),
    ).where(F.col("states") > 0)
    return kpi.select(
        "calendar_quarter",
        "total_facilities",
        "average_staffing_hprd",
        "average_rn_hprd",
        "average_occupancy_percent",
        thousands_text("total_facilities").alias("facilities_text"),
        fixed_text(round_half_up("average_staffing_hprd", 2), 2).alias("staffing_hprd_text"),
        fixed_text(round_half_up("average_rn_hprd", 2), 2).alias("rn_hprd_text"),
        percent_text(round_half_up("average_occupancy_percent", 1), 1).alias("occupancy_text"),
    )


def overview_bar(state_summary: DataFrame, quarter=None, states=None) -> DataFrame:
    """State and HPRD, highest first (NULL last, ties by state)."""
    return (
        _state_page(state_summary, quarter, states)
        .select("state", "average_staffing_hprd")
        .orderBy(F.col("average_staffing_hprd").desc_nulls_last(), "state")
    )


def overview_scatter(state_summary: DataFrame, quarter=None, states=None) -> DataFrame:
    return _state_page(state_summary, quarter, states).select(
        "state", "average_occupancy_percent", "average_staffing_hprd", "facility_count"
    )


# --------------------------------------------------------- state staffing


def state_grouped_bar(state_summary: DataFrame, quarter=None, states=None) -> DataFrame:
    """Long form (state, metric, value) of total and RN HPRD."""
    d = _state_page(state_summary, quarter, states).select(
        "state", "average_staffing_hprd", "average_rn_hprd"
    )
    return d.unpivot(
        ["state"], ["average_staffing_hprd", "average_rn_hprd"], "metric", "value"
    )


def contractor_bar(state_summary: DataFrame, quarter=None, states=None) -> DataFrame:
    return (
        _state_page(state_summary, quarter, states)
        .select("state", "average_contract_hour_percent")
        .orderBy(F.col("average_contract_hour_percent").desc_nulls_last(), "state")
    )


STATE_TABLE_COLUMNS = [
    "state", "facility_count", "average_daily_census", "average_staffing_hprd",
    "average_rn_hprd", "average_occupancy_percent", "average_contract_hour_percent",
]


def state_table(state_summary: DataFrame, quarter=None, states=None) -> DataFrame:
    return (
        _state_page(state_summary, quarter, states)
        .select(*STATE_TABLE_COLUMNS)
        .orderBy(F.col("average_staffing_hprd").desc_nulls_last(), "state")
    )


# ------------------------------------------------------ facility watchlist


def _watchlist(low_staffing: DataFrame, quarter, states) -> DataFrame:
    return with_occupancy_percent(filter_states(choose_quarter(low_staffing, quarter), states))


def watchlist_scatter(low_staffing: DataFrame, quarter=None, states=None) -> DataFrame:
    return _watchlist(low_staffing, quarter, states).select(
        "facility_name", "facility_ccn", "state", "average_daily_census",
        "average_staffing_hprd", "average_rn_hprd", "average_occupancy_percent",
    )


def watchlist_table(low_staffing: DataFrame, quarter=None, states=None) -> DataFrame:
    """Watchlist by rank. ``contract_hour_percentage`` stays a fraction as in
    the mart; ``contract_hour_percent`` carries it x 100 for display."""
    return (
        _watchlist(low_staffing, quarter, states)
        .select(
            "staffing_rank", "facility_name", "facility_ccn", "state",
            "average_daily_census", "average_staffing_hprd", "average_rn_hprd",
            "average_occupancy_percent", "contract_hour_percentage",
            to_percent("contract_hour_percentage").alias("contract_hour_percent"),
        )
        .orderBy("staffing_rank")
    )


# ------------------------------------------------------ staffing & quality


def _quality_filter(states, source) -> F.Column:
    keep = F.col("state").isNotNull() if states is None else F.col("state").isin(list(states))
    if source is not None and source != ALL_SOURCES:
        keep = keep & (F.col("quality_source") == F.lit(source))
    return keep


def _quality_page(quality_mart: DataFrame, quarter, states, source, measure) -> DataFrame:
    """Rows of one quarter (default: latest of the whole mart), the selected
    states and source, and one measure (default: the first name, in
    alphabetical order, among the rows left by those filters).

    Both defaults come from ONE small aggregation -- per quarter, the first
    measure name among the kept rows -- instead of two nested scalar
    subqueries, so the mart is read twice, not three times. The one-row
    result is broadcast (bounded by ``limit(1)``) and joined back.
    """
    keep = _quality_filter(states, source)
    q, m = F.col("calendar_quarter"), F.col("measure_name")
    rows = quality_mart.where(keep)
    if quarter is not None and measure is not None:
        return rows.where((q == F.lit(quarter)) & (m == F.lit(measure)))
    if quarter is None:
        per_quarter = (
            quality_mart.where(q.isNotNull())
            .groupBy("calendar_quarter")
            .agg(F.min(F.when(keep, m)).alias("_m"))
        )
        chosen = per_quarter.orderBy(q.desc()).limit(1)
    else:
        chosen = rows.where(q == F.lit(quarter)).agg(F.min(m).alias("_m")).select(
            F.lit(quarter).alias("calendar_quarter"), "_m"
        )
    if measure is not None:
        chosen = chosen.withColumn("_m", F.lit(measure))
    chosen = F.broadcast(chosen.select(q.alias("_q"), "_m"))
    return rows.join(chosen, (q == F.col("_q")) & (m == F.col("_m"))).drop("_q", "_m")


def quality_scatter(quality_mart: DataFrame, quarter=None, states=None,
                    source: Optional[str] = ALL_SOURCES, measure: Optional[str] = None) -> DataFrame:
    return _quality_page(quality_mart, quarter, states, source, measure).select(
        "facility_name", "facility_ccn", "state", "average_staffing_hprd",
        "measure_score", "average_rn_hprd", "average_daily_census", "measure_period",
    )


def quality_detail(quality_mart: DataFrame, quarter=None, states=None,
                   source: Optional[str] = ALL_SOURCES, measure: Optional[str] = None) -> DataFrame:
    """Detail rows by score, lowest first (NULL last, ties by facility)."""
    return (
        _quality_page(quality_mart, quarter, states, source, measure)
        .select(
            "facility_name", "facility_ccn", "state", "average_staffing_hprd",
            "average_rn_hprd", "measure_name", "measure_score", "measure_period",
        )
        .orderBy(F.col("measure_score").asc_nulls_last(), "facility_ccn")
    )


# ------------------------------------------------------------ filter lists


def filter_values(state_summary: DataFrame, quality_mart: DataFrame) -> DataFrame:
    """Sorted distinct non-null values offered by the page filters:
    quarters (latest first), states, quality sources and measures of the
    latest quarter (alphabetical). (filter_name, filter_value, position).

    Each mart is read once, for its distinct combinations of filter values;
    the latest quarter and the lists come from that small table.
    """
    everything = Window.partitionBy()

    def offered(combinations: DataFrame, *lists: Column) -> DataFrame:
        latest = F.max("calendar_quarter").over(everything)
        rows = combinations.withColumn("latest", F.col("calendar_quarter") == latest)
        return rows.select(F.inline(F.array(*lists))).where(F.col("filter_value").isNotNull()).distinct()

    def listed(name: str, column: str, when: Column) -> Column:
        return F.struct(F.lit(name).alias("filter_name"), F.when(when, F.col(column)).alias("filter_value"))

    states = state_summary.select("calendar_quarter", "state").distinct()
    measures = quality_mart.groupBy("calendar_quarter", "quality_source", "measure_name").agg(F.count("state").alias("stated"))
    # sources and measures are offered after the (default) state filter
    shown = F.col("latest") & (F.col("stated") > 0)
    parts = offered(
        states, listed("calendar_quarter", "calendar_quarter", F.lit(True)), listed("state", "state", F.col("latest"))
    ).unionByName(offered(measures, listed("quality_source", "quality_source", shown), listed("measure_name", "measure_name", shown)))
    desc = F.col("filter_name") == "calendar_quarter"
    key = F.when(desc, F.lit(None)).otherwise(F.col("filter_value"))
    key_desc = F.when(desc, F.col("filter_value"))
    w = Window.partitionBy("filter_name").orderBy(key.asc(), key_desc.desc())
    return parts.withColumn("position", F.row_number().over(w))


# ------------------------------------------------------------- empty pages


def shown(df: DataFrame, page: str) -> DataFrame:
    """A page's data set, or an error when the selection leaves no row (reads at most one row)."""
    assert_not_empty(df, f"the selection of page {page}")
    return df


# ---------------------------------------------------------- display tables

# Display labels and number formats of the three page tables,
# as (column, label, format); format is None for text, "int" for a whole
# number, "f1"/"f2" for 1/2 decimals, "pct1" for 1 decimal and a percent sign.
DISPLAY_COLUMNS = {
    "state_table": [
        ("state", "state", None),
        ("facility_count", "Facilities", "int"),
        ("average_daily_census", "Average daily census", "f1"),
        ("average_staffing_hprd", "Staffing HPRD", "f2"),
        ("average_rn_hprd", "RN HPRD", "f2"),
        ("average_occupancy_percent", "Occupancy proxy", "pct1"),
        ("average_contract_hour_percent", "Contractor hours", "pct1"),
    ],
    "watchlist_table": [
        ("staffing_rank", "Rank", "int"),
        ("facility_name", "Facility", None),
        ("facility_ccn", "CMS CCN", None),
        ("state", "state", None),
        ("average_daily_census", "Average daily census", "f1"),
        ("average_staffing_hprd", "Staffing HPRD", "f2"),
        ("average_rn_hprd", "RN HPRD", "f2"),
        ("average_occupancy_percent", "Occupancy proxy", "pct1"),
        ("contract_hour_percent", "Contractor hours", "pct1"),
    ],
    "quality_detail": [
        ("facility_name", "Facility", None),
        ("facility_ccn", "CMS CCN", None),
        ("state", "state", None),
        ("average_staffing_hprd", "Staffing HPRD", "f2"),
        ("average_rn_hprd", "RN HPRD", "f2"),
        ("measure_name", "Quality measure", None),
        ("measure_score", "Score", "f2"),
        ("measure_period", "Reporting period", None),
    ],
}


def _display_value(col: str, fmt: Optional[str]):
    c = F.col(col)
    if fmt is None:
        return c
    if fmt == "int":
        return c.cast("long").cast("string")
    if fmt == "f1":
        return fixed_text(round_half_up(c, 1), 1)
    if fmt == "f2":
        return fixed_text(round_half_up(c, 2), 2)
    if fmt == "pct1":
        return percent_text(round_half_up(c, 1), 1)
    raise ValueError(fmt)


def display_table(df: DataFrame, table: str, formatted: bool = True) -> DataFrame:
    """A page table with display labels as column names and, when
    ``formatted``, numbers as display texts (values rounded half-up before
    formatting). Row order is kept."""
    spec = DISPLAY_COLUMNS[table]
    if formatted:
        return df.select(*[_display_value(c, fmt).alias(label) for c, label, fmt in spec])
    return df.select(*[c for c, _, _ in spec]).withColumnsRenamed({c: label for c, label, _ in spec})
