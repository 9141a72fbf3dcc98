"""DuckDB SQL twins of the driver queries (``staffwise.plans.queries``).

The shared tables are views in DuckDB. The fixture bindings are written a
second time here as CTEs, independently of the Spark code, so that a
binding or operator bug shows up as a mismatch. Helpers below spell out the
ANSI-safe semantics of the Spark column builders in DuckDB terms.
"""

from __future__ import annotations

from typing import Dict, Sequence

# Fixed values, written out here a second time so that an error in the
# library's lists shows up as a mismatch.
NA_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
STAFF_CATEGORIES = [
    ("Hrs_RN", "rn_hours"), ("Hrs_LPN", "lpn_hours"), ("Hrs_CNA", "cna_hours"), ("Hrs_RNDON", "director_rn_hours"),
    ("Hrs_RNadmin", "rn_admin_hours"), ("Hrs_LPNadmin", "lpn_admin_hours"), ("Hrs_NAtrn", "nurse_aide_training_hours"),
    ("Hrs_MedAide", "medication_aide_hours"),
]
SPLIT_STEMS = [stem for stem, _ in STAFF_CATEGORIES]
INT_RE = r"\s*[+-]?[0-9]+\s*"
NUMBER_RE = r"\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*|\s*[+-]?(?i:inf|infinity)\s*"

# ------------------------------------------------------------ expressions


def ccn(x: str) -> str:
    return f"lpad(trim(CAST({x} AS VARCHAR)), 6, '0')"


def to_double(x: str) -> str:
    return f"TRY_CAST({x} AS DOUBLE)"


def to_int(x: str) -> str:
    whole = r"\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\s*"
    return f"CASE WHEN regexp_full_match({x}, '{whole}') THEN TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS INTEGER) END"


def hours(x: str) -> str:
    return f"COALESCE(TRY_CAST({x} AS DOUBLE), 0.0)"


def parse_date(x: str, layout: str) -> str:
    """Exact-width date parse (Spark's parser rejects '1/5/2024' for
    MM/dd/yyyy; DuckDB's strptime would accept it)."""
    if layout == "yyyyMMdd":
        return f"CASE WHEN regexp_full_match({x}, '[0-9]{{8}}') THEN CAST(TRY_STRPTIME({x}, '%Y%m%d') AS DATE) END"
    if layout == "MM/dd/yyyy":
        return (
            f"CASE WHEN regexp_full_match({x}, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') "
            f"THEN CAST(TRY_STRPTIME({x}, '%m/%d/%Y') AS DATE) END"
        )
    raise ValueError(layout)


def ratio(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) END"


def rnd(x: str, scale: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(30,9)), {scale}) AS DOUBLE)"


def quarter(d: str) -> str:
    return f"(CAST(year({d}) AS VARCHAR) || 'Q' || CAST(quarter({d}) AS VARCHAR))"


def sql_list(items: Sequence[str]) -> str:
    return ", ".join("'" + i.replace("'", "''") + "'" for i in items)


AVG_COLUMNS = [
    "average_daily_census", "average_staffing_hprd", "average_rn_hprd",
    "average_occupancy_rate", "average_occupancy_percent", "measure_score",
]


def r6_select(inner: str, cols: Sequence[str]) -> str:
    """SELECT * with the listed columns rounded to 6 decimals."""
    rep = ", ".join(f"{rnd(c, 6)} AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS t"


# --------------------------------------------------------------- fixtures

CATEGORY_RULES = {
    "rn_hours": "l_linenumber = 1",
    "lpn_hours": "l_linenumber = 2",
    "cna_hours": "l_linenumber = 3",
    "director_rn_hours": "l_linenumber = 4",
    "rn_admin_hours": "l_linenumber = 5",
    "lpn_admin_hours": "l_linenumber = 6",
    "nurse_aide_training_hours": "l_linenumber = 7 AND l_linestatus = 'O'",
    "medication_aide_hours": "l_linenumber = 7 AND l_linestatus = 'F'",
}
CATS = list(CATEGORY_RULES)


def _pbj_raw_columns() -> str:
    cols = [
        "CASE WHEN l.l_suppkey % 13 = 5 THEN ' A' || CAST(l.l_suppkey AS VARCHAR) "
        "ELSE ' ' || CAST(l.l_suppkey AS VARCHAR) || ' ' END AS PROVNUM",
        "CASE WHEN l.l_orderkey % 97 = 0 THEN 'bad' "
        "ELSE strftime(CAST(l.l_shipdate AS DATE), '%Y%m%d') END AS WorkDate",
        f"{quarter('CAST(l.l_shipdate AS DATE)')} AS CY_Qtr",
        "' ' || d.s_name AS PROVNAME",
        "d.n_name AS STATE",
        "CASE WHEN l.l_orderkey % 89 = 0 THEN NULL WHEN l.l_orderkey % 83 = 0 THEN '-1' "
        "WHEN l.l_orderkey % 79 = 0 THEN '12.7' WHEN l.l_orderkey % 73 = 0 THEN '12d' "
        "WHEN l.l_orderkey % 71 = 0 THEN '1e2' ELSE CAST(l.l_partkey % 5 AS VARCHAR) END AS MDScensus",
    ]
    text = {}
    for stem, name in STAFF_CATEGORIES:
        t = f"CASE WHEN {CATEGORY_RULES[name]} THEN CAST(l.l_quantity AS VARCHAR)"
        if stem == "Hrs_RN":
            t += " WHEN l_linenumber = 2 THEN 'N/A'"
        text[stem] = t + " END"
        cols.append(f"{text[stem]} AS {stem}")
    for stem in SPLIT_STEMS:
        cols.append(f"CASE WHEN NOT (l.l_returnflag = 'R') THEN {text[stem]} END AS {stem}_emp")
        cols.append(f"CASE WHEN l.l_returnflag = 'R' THEN {text[stem]} END AS {stem}_ctr")
    return ",\n    ".join(cols)


PBJ_COLUMNS = (
    ["PROVNUM", "WorkDate", "CY_Qtr", "PROVNAME", "STATE", "MDScensus"]
    + [s for s, _ in STAFF_CATEGORIES]
    + [f"{s}_{k}" for s in SPLIT_STEMS for k in ("emp", "ctr")]
)


def _clean_staffing_columns() -> str:
    cols = [
        f"{ccn('PROVNUM')} AS facility_ccn",
        f"{parse_date('WorkDate', 'yyyyMMdd')} AS work_date",
        "CY_Qtr AS calendar_quarter",
        "trim(PROVNAME) AS facility_name",
        "trim(STATE) AS state",
        f"{to_int('MDScensus')} AS resident_census",
    ]
    cols += [f"{hours(stem)} AS {name}" for stem, name in STAFF_CATEGORIES]
    cols.append(" + ".join(hours(f"{s}_emp") for s in SPLIT_STEMS) + " AS employee_nursing_hours")
    cols.append(" + ".join(hours(f"{s}_ctr") for s in SPLIT_STEMS) + " AS contract_nursing_hours")
    return ",\n    ".join(cols)


def _staffing_agg_columns() -> str:
    cols = [f"SUM(CASE WHEN {rule} THEN l_quantity ELSE 0.0 END) AS {name}" for name, rule in CATEGORY_RULES.items()]
    cols.append("SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0 END) AS employee_nursing_hours")
    cols.append("SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS contract_nursing_hours")
    return ",\n    ".join(cols)


TOTAL = " + ".join(CATS)

FIXTURE_CTES = f"""
directory AS (
  SELECT s.s_suppkey, s.s_name, s.s_acctbal, n.n_name
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
),
staffing_agg AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS work_date,
    CAST(SUM(l_partkey % 5) AS INTEGER) AS resident_census,
    {_staffing_agg_columns()}
  FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
),
fx_staffing AS (
  SELECT {ccn('a.l_suppkey')} AS facility_ccn, a.work_date,
    {quarter('a.work_date')} AS calendar_quarter,
    trim(d.s_name) AS facility_name, trim(d.n_name) AS state, a.resident_census,
    {", ".join("a." + c for c in CATS)},
    a.employee_nursing_hours, a.contract_nursing_hours
  FROM staffing_agg a LEFT JOIN directory d ON a.l_suppkey = d.s_suppkey
),
pbj_raw AS (
  SELECT {_pbj_raw_columns()}
  FROM lineitem l LEFT JOIN directory d ON l.l_suppkey = d.s_suppkey
),
clean_staffing AS (
  SELECT {_clean_staffing_columns()}
  FROM pbj_raw
),
provider_raw AS (
  SELECT CASE WHEN s_suppkey % 7 = 3 THEN ' P' ELSE ' ' END || CAST(s_suppkey AS VARCHAR) AS ccn_text,
    s_name || ' ' AS provider_name, n_name AS state_text,
    CAST(CASE WHEN s_suppkey % 10 = 0 THEN 0 ELSE 5 + s_suppkey % 20 END AS VARCHAR) AS beds_text,
    CAST(s_acctbal AS VARCHAR) AS residents_text,
    CASE WHEN s_suppkey % 3 = 0 THEN 'For profit' WHEN s_suppkey % 3 = 1 THEN 'Non profit'
         ELSE 'Government' END AS ownership,
    CAST(1 + s_suppkey % 5 AS VARCHAR) AS overall_text,
    CASE WHEN s_suppkey % 11 = 0 THEN 'N/A' ELSE CAST(1 + s_suppkey % 4 AS VARCHAR) END AS staffing_text,
    CAST(s_suppkey % 60 AS VARCHAR) AS turnover_text,
    CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey % 45 AS VARCHAR) END AS rn_turnover_text
  FROM directory
),
fx_facility AS (
  SELECT {ccn('ccn_text')} AS facility_ccn, trim(provider_name) AS facility_name,
    trim(state_text) AS state, {to_int('beds_text')} AS certified_beds,
    {to_double('residents_text')} AS average_residents_per_day, ownership AS ownership_type,
    {to_int('overall_text')} AS overall_rating, {to_int('staffing_text')} AS staffing_rating,
    {to_double('turnover_text')} AS nursing_staff_turnover, {to_double('rn_turnover_text')} AS rn_turnover
  FROM provider_raw
),
measure_base AS (
  SELECT b.user_id, b.event_type, b.score, d.n_name,
    CASE WHEN b.user_id % 8 = 0 THEN 'M' ELSE '' END || CAST(b.user_id AS VARCHAR) AS ccn_text
  FROM (SELECT user_id, event_type, avg(value) AS score FROM events GROUP BY user_id, event_type) b
  LEFT JOIN directory d ON b.user_id = d.s_suppkey
),
fx_quality AS (
  SELECT {ccn('ccn_text')} AS facility_ccn, trim(n_name) AS state,
    'claims_quality_measure' AS quality_source, event_type AS measure_code,
    CASE WHEN event_type = 'error' THEN 'Short-stay Rehospitalization' ELSE 'Other ' || event_type END AS measure_name,
    CASE WHEN event_type = 'error' THEN 'Short Stay' ELSE 'Long Stay' END AS resident_type,
    CASE WHEN event_type = 'error' AND user_id % 9 = 0 THEN NULL ELSE score END AS measure_score,
    '2024' AS measure_period
  FROM measure_base WHERE event_type <> 'signup'
  UNION ALL
  SELECT {ccn('ccn_text')}, trim(n_name), 'vbp_readmission_rate', 'FY2022_READMISSION_RATE',
    'FY 2022 Risk-Standardized Readmission Rate', CAST(NULL AS VARCHAR), score, 'FY 2022'
  FROM measure_base WHERE event_type = 'signup'
),
citations_raw AS (
  SELECT CAST(e.user_id AS VARCHAR) AS ccn_text, d.n_name AS state_text,
    CASE WHEN e.event_id % 50 = 0 THEN strftime(CAST(e.ts AS DATE), '%-m/%-d/%Y')
         ELSE strftime(CAST(e.ts AS DATE), '%m/%d/%Y') END AS date_text,
    CASE WHEN e.event_id % 2 = 0 THEN 'Health' ELSE 'Fire Safety' END AS survey_type,
    e.event_type AS deficiency_category,
    lpad(CAST(e.event_id % 1000 AS VARCHAR), 4, '0') AS deficiency_tag_number,
    substr('ABCDEFGHIJKL', CAST(e.event_id % 12 + 1 AS INTEGER), 1) AS scope_severity_code,
    CASE WHEN e.event_type = 'error' THEN 'Y' ELSE 'N' END AS complaint_deficiency
  FROM events e LEFT JOIN directory d ON e.user_id = d.s_suppkey
),
fx_daily_base AS (
  SELECT s.*, f.certified_beds, ({TOTAL}) AS total_nursing_hours
  FROM fx_staffing s LEFT JOIN (SELECT facility_ccn, certified_beds FROM fx_facility) f
    ON s.facility_ccn = f.facility_ccn
),
fx_daily AS (
  SELECT *, {ratio('total_nursing_hours', 'resident_census')} AS staffing_hours_per_resident_day,
    {ratio('rn_hours', 'resident_census')} AS rn_hours_per_resident_day,
    {ratio('resident_census', 'certified_beds')} AS occupancy_rate_proxy
  FROM fx_daily_base
),
fx_quarterly_agg AS (
  SELECT facility_ccn, facility_name, state, calendar_quarter,
    count(work_date) AS days_reported,
    avg(resident_census) AS average_daily_census,
    avg(staffing_hours_per_resident_day) AS average_staffing_hprd,
    avg(rn_hours_per_resident_day) AS average_rn_hprd,
    avg(occupancy_rate_proxy) AS average_occupancy_rate,
    sum(total_nursing_hours) AS total_nursing_hours,
    sum(employee_nursing_hours) AS employee_nursing_hours,
    sum(contract_nursing_hours) AS contract_nursing_hours
  FROM fx_daily GROUP BY facility_ccn, facility_name, state, calendar_quarter
),
fx_quarterly AS (
  SELECT *, {ratio('contract_nursing_hours', 'employee_nursing_hours + contract_nursing_hours')}
    AS contract_hour_percentage
  FROM fx_quarterly_agg
),
fx_staffing_quality AS (
  SELECT q.*, m.quality_source, m.measure_code, m.measure_name, m.measure_score, m.measure_period
  FROM fx_quarterly q LEFT JOIN fx_quality m ON q.facility_ccn = m.facility_ccn
),
stg_daily AS (
  SELECT facility_ccn, facility_name, state, calendar_quarter, work_date, resident_census,
    certified_beds, rn_hours, lpn_hours, cna_hours, employee_nursing_hours, contract_nursing_hours,
    total_nursing_hours, staffing_hours_per_resident_day, rn_hours_per_resident_day, occupancy_rate_proxy
  FROM fx_daily WHERE facility_ccn IS NOT NULL
),
stg_quarterly AS (
  SELECT facility_ccn, facility_name, state, calendar_quarter, days_reported, average_daily_census,
    average_staffing_hprd, average_rn_hprd, average_occupancy_rate, total_nursing_hours,
    employee_nursing_hours, contract_nursing_hours, contract_hour_percentage
  FROM fx_quarterly WHERE facility_ccn IS NOT NULL
),
stg_quality AS (
  SELECT facility_ccn, facility_name, state, calendar_quarter, average_daily_census,
    average_staffing_hprd, average_rn_hprd, average_occupancy_rate, contract_hour_percentage,
    quality_source, measure_code, measure_name, measure_score, measure_period
  FROM fx_staffing_quality WHERE facility_ccn IS NOT NULL
),
mart_state AS (
  SELECT state, calendar_quarter, CAST(count(DISTINCT facility_ccn) AS BIGINT) AS facility_count,
    {rnd('avg(average_daily_census)', 2)} AS average_daily_census,
    {rnd('avg(average_staffing_hprd)', 2)} AS average_staffing_hprd,
    {rnd('avg(average_rn_hprd)', 2)} AS average_rn_hprd,
    {rnd('avg(average_occupancy_rate) * 100', 2)} AS average_occupancy_percent,
    {rnd('avg(contract_hour_percentage) * 100', 2)} AS average_contract_hour_percent
  FROM stg_quarterly WHERE state IS NOT NULL GROUP BY state, calendar_quarter
),
mart_low_ranked AS (
  SELECT facility_ccn, facility_name, state, calendar_quarter, average_daily_census,
    average_staffing_hprd, average_rn_hprd, average_occupancy_rate, contract_hour_percentage,
    CAST(row_number() OVER (PARTITION BY calendar_quarter ORDER BY average_staffing_hprd ASC,
      facility_ccn ASC NULLS LAST, facility_name ASC NULLS LAST, state ASC NULLS LAST) AS INTEGER)
      AS staffing_rank
  FROM stg_quarterly WHERE average_staffing_hprd IS NOT NULL
),
mart_low AS (SELECT * FROM mart_low_ranked WHERE staffing_rank <= 10),
mart_quality AS (
  SELECT * FROM stg_quality
  WHERE measure_score IS NOT NULL
    AND (lower(measure_name) LIKE '%rehospital%' OR lower(measure_name) LIKE '%readmission%')
),
page_state AS (
  SELECT * FROM mart_state
  WHERE calendar_quarter = (SELECT max(calendar_quarter) FROM mart_state) AND state IS NOT NULL
),
page_low AS (
  SELECT *, average_occupancy_rate * 100.0 AS average_occupancy_percent FROM mart_low
  WHERE calendar_quarter = (SELECT max(calendar_quarter) FROM mart_low) AND state IS NOT NULL
),
page_quality_base AS (
  SELECT * FROM mart_quality
  WHERE calendar_quarter = (SELECT max(calendar_quarter) FROM mart_quality) AND state IS NOT NULL
),
page_quality AS (
  SELECT * FROM page_quality_base
  WHERE measure_name = (SELECT min(measure_name) FROM page_quality_base)
)"""


def with_fixtures(body: str) -> str:
    return f"WITH {FIXTURE_CTES}\n{body}"


# --------------------------------------------------------------- profiling


def _na(col: str) -> str:
    return f"CASE WHEN CAST({col} AS VARCHAR) IN ({sql_list(NA_WORDS)}) THEN NULL ELSE CAST({col} AS VARCHAR) END"


PROFILE_COLUMNS = PBJ_COLUMNS + ["Notes", "Is_Contract", "Shift_Code"]
PROFILE_RAW = f"""profile_raw AS (
  SELECT {_pbj_raw_columns()}, CAST(NULL AS VARCHAR) AS Notes,
    CASE WHEN l.l_returnflag = 'R' THEN 'True' ELSE 'FALSE' END AS Is_Contract,
    CAST(l.l_linenumber % 3 AS VARCHAR) || CASE WHEN l.l_linenumber % 2 = 0 THEN 'd' ELSE 'f' END AS Shift_Code
  FROM lineitem l LEFT JOIN directory d ON l.l_suppkey = d.s_suppkey
)"""
PROFILE_NA = "profile_na AS (SELECT " + ", ".join(f"{_na(c)} AS {c}" for c in PROFILE_COLUMNS) + " FROM profile_raw)"
NUM = f"CASE WHEN regexp_full_match(s, '{NUMBER_RE}') THEN TRY_CAST(s AS DOUBLE) END"

PROFILE_LONG = "profile_long AS (\n" + "\n  UNION ALL\n".join(
    f"  SELECT {i} AS position, '{c}' AS column_name, {c} AS s FROM profile_na" for i, c in enumerate(PROFILE_COLUMNS)
) + "\n)"

PROFILE_COLS = f"""profile_cols AS (
  SELECT position, column_name,
    CAST(count(s) AS BIGINT) AS count,
    CAST(count(*) FILTER (WHERE s IS NULL) AS BIGINT) AS missing_count,
    count(*) FILTER (WHERE s IS NOT NULL AND {NUM} IS NULL) AS bad,
    count(*) FILTER (WHERE s IS NOT NULL AND NOT regexp_full_match(s, '{INT_RE}')) AS nonint,
    avg({NUM}) AS mean, stddev_samp({NUM}) AS std,
    count(*) FILTER (WHERE s IN ('True', 'TRUE', 'true')) AS n_true, count(*) FILTER (WHERE s IN ('False', 'FALSE', 'false')) AS n_false,
    min({NUM}) AS min, max({NUM}) AS max,
    CAST(count(*) AS BIGINT) AS rows
  FROM profile_long GROUP BY position, column_name
),
profile_typed AS (
  SELECT *, CASE WHEN n_true + n_false = count AND missing_count = 0 AND count > 0 THEN 'bool'
                 WHEN bad = 0 AND missing_count = 0 AND nonint = 0 AND count > 0 THEN 'int64'
                 WHEN bad = 0 THEN 'float64' ELSE 'object' END AS data_type,
    CASE WHEN n_true > 0 AND n_false > 0 THEN 2 ELSE 1 END AS unique_truth,
    {rnd('CASE WHEN rows > 0 THEN missing_count / rows * 100.0 END', 2)} AS missing_pct
  FROM profile_cols
),
profile_hist AS (
  SELECT column_name, s, count(*) AS cnt FROM profile_long WHERE s IS NOT NULL GROUP BY column_name, s
),
profile_values AS (
  SELECT column_name, count(*) AS unique_text, count(DISTINCT {NUM}) AS unique_number,
    min({{'neg': -cnt, 's': s}}) AS top_struct
  FROM profile_hist GROUP BY column_name
),
profile_quart AS (
  SELECT column_name, quantile_cont(v, [0.25, 0.5, 0.75]) AS qs
  FROM (SELECT column_name, {NUM} AS v FROM profile_long) x
  WHERE v IS NOT NULL GROUP BY column_name
)"""

PROFILE_CTES = ",\n".join([PROFILE_RAW, PROFILE_NA, PROFILE_LONG, PROFILE_COLS])

PROFILE_DUP = (
    "SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    f"(SELECT count(*) AS n FROM profile_na GROUP BY {', '.join(PROFILE_COLUMNS)}) g"
)


def _profile(body: str) -> str:
    return f"WITH {FIXTURE_CTES},\n{PROFILE_CTES}\n{body}"


PROFILE_SQL = {
    "profile_overview": _profile(
        f"""SELECT * FROM (
  SELECT 0 AS position, 'Dataset Name' AS metric, 'PBJ_Daily_Nurse_Staffing' AS value
  UNION ALL SELECT 1, 'Total Rows', CAST(max(rows) AS VARCHAR) FROM profile_typed
  UNION ALL SELECT 2, 'Total Columns', CAST(count(*) AS VARCHAR) FROM profile_typed
  UNION ALL SELECT 3, 'Numeric Columns', CAST(count(*) FILTER (WHERE data_type NOT IN ('object', 'bool')) AS VARCHAR) FROM profile_typed
  UNION ALL SELECT 4, 'Categorical Columns', CAST(count(*) FILTER (WHERE data_type IN ('object', 'bool')) AS VARCHAR) FROM profile_typed
  UNION ALL SELECT 5, 'Duplicate Rows', CAST(duplicate_rows AS VARCHAR) FROM ({PROFILE_DUP}) d
  UNION ALL SELECT 6, 'Total Missing Cells', CAST(sum(missing_count) AS VARCHAR) FROM profile_typed
) o"""
    ),
    "profile_dictionary": _profile(
        """SELECT t.position, t.column_name, t.data_type, t.missing_count, t.missing_pct,
  CAST(COALESCE(CASE t.data_type WHEN 'bool' THEN t.unique_truth WHEN 'object' THEN v.unique_text ELSE v.unique_number END, 0) AS BIGINT) AS unique_values
FROM profile_typed t LEFT JOIN profile_values v ON t.column_name = v.column_name"""
    ),
    "profile_missing": _profile(
        """SELECT position, column_name, missing_count, missing_pct,
  CASE WHEN missing_pct = 0 THEN 'ok' WHEN missing_pct >= 0.0001 AND missing_pct <= 0.10 THEN 'warn'
       WHEN missing_pct > 0.10 THEN 'bad' END AS severity
FROM profile_typed"""
    ),
    "profile_statistics": _profile(
        f"""SELECT t.position, t.column_name, t.data_type, t.count,
  CAST(CASE t.data_type WHEN 'bool' THEN t.unique_truth WHEN 'object' THEN v.unique_text END AS BIGINT) AS "unique",
  CASE t.data_type WHEN 'bool' THEN CASE WHEN n_true > n_false THEN 'True' ELSE 'False' END WHEN 'object' THEN v.top_struct.s END AS top,
  CAST(CASE t.data_type WHEN 'bool' THEN greatest(n_true, n_false) WHEN 'object' THEN -v.top_struct.neg END AS BIGINT) AS freq,
  CASE WHEN t.data_type NOT IN ('object', 'bool') THEN {rnd('t.mean', 6)} END AS mean,
  CASE WHEN t.data_type NOT IN ('object', 'bool') THEN {rnd('t.std', 6)} END AS std,
  CASE WHEN t.data_type NOT IN ('object', 'bool') THEN t.min END AS min,
  CASE WHEN t.data_type NOT IN ('object', 'bool') THEN {rnd('q.qs[1]', 6)} END AS p25,
  CASE WHEN t.data_type NOT IN ('object', 'bool') THEN {rnd('q.qs[2]', 6)} END AS p50,
  CASE WHEN t.data_type NOT IN ('object', 'bool') THEN {rnd('q.qs[3]', 6)} END AS p75,
  CASE WHEN t.data_type NOT IN ('object', 'bool') THEN t.max END AS max
FROM profile_typed t LEFT JOIN profile_values v ON t.column_name = v.column_name
LEFT JOIN profile_quart q ON t.column_name = q.column_name"""
    ),
    "profile_quality": _profile(
        f"""SELECT -1 AS position, 'Duplicate Rows' AS "check", duplicate_rows AS result FROM ({PROFILE_DUP}) d
UNION ALL
SELECT position, 'Missing Values - ' || column_name, missing_count FROM profile_typed"""
    ),
    "profile_sample": _profile(
        "SELECT * FROM profile_na ORDER BY "
        + ", ".join(f"{c} ASC NULLS FIRST" for c in PROFILE_COLUMNS)
        + " LIMIT 20"
    ),
    "profile_sample_roundtrip_files": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CAST(o_orderstatus AS VARCHAR) AS o_orderstatus, CAST(o_orderpriority AS VARCHAR) AS o_orderpriority
FROM orders ORDER BY orders.o_orderkey LIMIT 20""",
    "profile_overview_roundtrip_files": """WITH cells AS (
  SELECT COALESCE(CAST(o_custkey AS VARCHAR), '') AS a, COALESCE(o_orderstatus, '') AS b, COALESCE(o_orderpriority, '') AS c FROM orders
), counted AS (
  SELECT count(*) AS n, count(DISTINCT (a, b, c)) AS different, sum(strlen(a) + strlen(b) + strlen(c) + 3) AS bytes,
    count(*) FILTER (WHERE a = '') + count(*) FILTER (WHERE b = '') + count(*) FILTER (WHERE c = '') AS missing FROM cells
)
SELECT 0 AS position, 'Dataset Name' AS metric, 'orders' AS value
UNION ALL SELECT 1, 'Total Rows', CAST(n AS VARCHAR) FROM counted
UNION ALL SELECT 2, 'Total Columns', '3'
UNION ALL SELECT 3, 'Numeric Columns', '1'
UNION ALL SELECT 4, 'Categorical Columns', '2'
UNION ALL SELECT 5, 'Duplicate Rows', CAST(n - different AS VARCHAR) FROM counted
UNION ALL SELECT 6, 'Total Missing Cells', CAST(missing AS VARCHAR) FROM counted
UNION ALL SELECT 7, 'Input Size (MB)', CAST(round(bytes / 1048576.0, 2) AS VARCHAR) FROM counted""",
}


# ----------------------------------------------------------------- queries

QUARTERLY_COLS = (
    "facility_ccn, facility_name, state, calendar_quarter, days_reported, average_daily_census, "
    "average_staffing_hprd, average_rn_hprd, average_occupancy_rate, total_nursing_hours, "
    "employee_nursing_hours, contract_nursing_hours, contract_hour_percentage"
)

_NOT_NULL_TESTS = [
    ("FACILITY_DAILY_STAFFING", "fx_daily", "facility_ccn"),
    ("FACILITY_QUARTERLY_SUMMARY", "fx_quarterly", "facility_ccn"),
    ("STAFFING_QUALITY_ANALYSIS", "fx_staffing_quality", "facility_ccn"),
    ("stg_facility_daily_staffing", "stg_daily", "facility_ccn"),
    ("stg_facility_daily_staffing", "stg_daily", "work_date"),
    ("stg_facility_quarterly_summary", "stg_quarterly", "facility_ccn"),
    ("stg_staffing_quality_analysis", "stg_quality", "facility_ccn"),
    ("mart_state_staffing_summary", "mart_state", "state"),
    ("mart_low_staffing_facilities", "mart_low", "facility_ccn"),
    ("mart_staffing_quality", "mart_quality", "facility_ccn"),
]
NOT_NULL_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
    f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failing_rows, "
    f"count(*) FILTER (WHERE {c} IS NULL) = 0 AS passed FROM {v}"
    for t, v, c in _NOT_NULL_TESTS
)

REJECT_REASON = (
    "CASE WHEN NOT COALESCE(regexp_full_match(facility_ccn, '[0-9]{6}'), false) THEN 'invalid_ccn' "
    "WHEN work_date IS NULL THEN 'missing_work_date' "
    "WHEN NOT COALESCE(resident_census >= 0, false) THEN 'invalid_census' END"
)


def _avg_cols(cols: str) -> list[str]:
    return [c for c in AVG_COLUMNS if c in cols]


ORACLE: Dict[str, str] = {
    "clean_staffing": with_fixtures("SELECT * FROM clean_staffing"),
    "valid_staffing": with_fixtures(
        "SELECT * FROM clean_staffing WHERE regexp_full_match(facility_ccn, '[0-9]{6}') "
        "AND work_date IS NOT NULL AND resident_census >= 0"
    ),
    "rejected_staffing_reasons": with_fixtures(
        f"SELECT reject_reason, CAST(count(*) AS BIGINT) AS rejected_rows FROM "
        f"(SELECT {REJECT_REASON} AS reject_reason FROM clean_staffing) r "
        f"WHERE reject_reason IS NOT NULL GROUP BY reject_reason"
    ),
    "duplicate_keys": with_fixtures(
        "SELECT CAST(count(*) AS BIGINT) AS duplicate_keys FROM "
        "(SELECT facility_ccn, work_date FROM clean_staffing GROUP BY facility_ccn, work_date "
        "HAVING count(*) > 1) d"
    ),
    "horizontal_hours": with_fixtures(
        f"SELECT facility_ccn, work_date, ({TOTAL}) AS total_nursing_hours, "
        "employee_nursing_hours, contract_nursing_hours FROM clean_staffing"
    ),
    "union_measures": with_fixtures(r6_select("SELECT * FROM fx_quality", ["measure_score"])),
    "clean_facility": with_fixtures("SELECT * FROM fx_facility"),
    "clean_citations": with_fixtures(
        f"SELECT {ccn('ccn_text')} AS facility_ccn, trim(state_text) AS state, "
        f"{parse_date('date_text', 'MM/dd/yyyy')} AS survey_date, survey_type, deficiency_category, "
        "deficiency_tag_number, scope_severity_code, complaint_deficiency FROM citations_raw"
    ),
    "facility_daily": with_fixtures("SELECT * FROM fx_daily"),
    "facility_quarterly": with_fixtures(
        r6_select("SELECT * FROM fx_quarterly", _avg_cols(QUARTERLY_COLS))
    ),
    "staffing_quality": with_fixtures(
        r6_select("SELECT * FROM fx_staffing_quality", _avg_cols(QUARTERLY_COLS) + ["measure_score"])
    ),
    "stg_daily": with_fixtures("SELECT * FROM stg_daily"),
    "stg_quarterly": with_fixtures(r6_select("SELECT * FROM stg_quarterly", _avg_cols(QUARTERLY_COLS))),
    "stg_quality": with_fixtures(
        r6_select("SELECT * FROM stg_quality", _avg_cols(QUARTERLY_COLS) + ["measure_score"])
    ),
    "state_summary": with_fixtures("SELECT * FROM mart_state"),
    "low_staffing": with_fixtures(r6_select("SELECT * FROM mart_low", _avg_cols(QUARTERLY_COLS))),
    "readmission_quality": with_fixtures(
        r6_select("SELECT * FROM mart_quality", _avg_cols(QUARTERLY_COLS) + ["measure_score"])
    ),
    "not_null_results": with_fixtures(NOT_NULL_SQL),
    **PROFILE_SQL,
    "filter_values": with_fixtures(
        """SELECT filter_name, filter_value, CAST(row_number() OVER (PARTITION BY filter_name ORDER BY
    CASE WHEN filter_name = 'calendar_quarter' THEN NULL ELSE filter_value END ASC NULLS FIRST,
    CASE WHEN filter_name = 'calendar_quarter' THEN filter_value END DESC NULLS LAST) AS INTEGER) AS position
FROM (
  SELECT DISTINCT 'calendar_quarter' AS filter_name, calendar_quarter AS filter_value FROM mart_state WHERE calendar_quarter IS NOT NULL
  UNION ALL SELECT DISTINCT 'state', state FROM mart_state
    WHERE calendar_quarter = (SELECT max(calendar_quarter) FROM mart_state) AND state IS NOT NULL
  UNION ALL SELECT DISTINCT 'quality_source', quality_source FROM mart_quality
    WHERE calendar_quarter = (SELECT max(calendar_quarter) FROM mart_quality) AND state IS NOT NULL
      AND quality_source IS NOT NULL
  UNION ALL SELECT DISTINCT 'measure_name', measure_name FROM mart_quality
    WHERE calendar_quarter = (SELECT max(calendar_quarter) FROM mart_quality) AND state IS NOT NULL
      AND measure_name IS NOT NULL
) v"""
    ),
    "overview_kpis": with_fixtures(
        r6_select(
            f"""SELECT max(calendar_quarter) AS calendar_quarter,
  CAST(sum(facility_count) AS BIGINT) AS total_facilities,
  avg(average_staffing_hprd) AS average_staffing_hprd, avg(average_rn_hprd) AS average_rn_hprd,
  avg(average_occupancy_percent) AS average_occupancy_percent,
  format('{{:,}}', CAST(sum(facility_count) AS BIGINT)) AS facilities_text,
  printf('%.2f', {rnd('avg(average_staffing_hprd)', 2)}) AS staffing_hprd_text,
  printf('%.2f', {rnd('avg(average_rn_hprd)', 2)}) AS rn_hprd_text,
  printf('%.1f%%', {rnd('avg(average_occupancy_percent)', 1)}) AS occupancy_text
FROM page_state HAVING count(*) > 0""",
            ["average_staffing_hprd", "average_rn_hprd", "average_occupancy_percent"],
        )
    ),
    "overview_bar": with_fixtures("SELECT state, average_staffing_hprd FROM page_state"),
    "overview_scatter": with_fixtures(
        "SELECT state, average_occupancy_percent, average_staffing_hprd, facility_count FROM page_state"
    ),
    "state_grouped_bar": with_fixtures(
        "SELECT state, 'average_staffing_hprd' AS metric, average_staffing_hprd AS value FROM page_state "
        "UNION ALL SELECT state, 'average_rn_hprd', average_rn_hprd FROM page_state"
    ),
    "contractor_bar": with_fixtures("SELECT state, average_contract_hour_percent FROM page_state"),
    "state_table": with_fixtures(
        "SELECT state, facility_count, average_daily_census, average_staffing_hprd, average_rn_hprd, "
        "average_occupancy_percent, average_contract_hour_percent FROM page_state"
    ),
    "watchlist_scatter": with_fixtures(
        r6_select(
            "SELECT facility_name, facility_ccn, state, average_daily_census, average_staffing_hprd, "
            "average_rn_hprd, average_occupancy_percent FROM page_low",
            ["average_daily_census", "average_staffing_hprd", "average_rn_hprd", "average_occupancy_percent"],
        )
    ),
    "watchlist_table": with_fixtures(
        r6_select(
            "SELECT staffing_rank, facility_name, facility_ccn, state, average_daily_census, "
            "average_staffing_hprd, average_rn_hprd, average_occupancy_percent, contract_hour_percentage, "
            "contract_hour_percentage * 100.0 AS contract_hour_percent FROM page_low",
            ["average_daily_census", "average_staffing_hprd", "average_rn_hprd", "average_occupancy_percent"],
        )
    ),
    "quality_scatter": with_fixtures(
        r6_select(
            "SELECT facility_name, facility_ccn, state, average_staffing_hprd, measure_score, "
            "average_rn_hprd, average_daily_census, measure_period FROM page_quality",
            ["average_staffing_hprd", "measure_score", "average_rn_hprd", "average_daily_census"],
        )
    ),
    "quality_detail": with_fixtures(
        r6_select(
            "SELECT facility_name, facility_ccn, state, average_staffing_hprd, average_rn_hprd, "
            "measure_name, measure_score, measure_period FROM page_quality",
            ["average_staffing_hprd", "average_rn_hprd", "measure_score"],
        )
    ),
    "state_table_selected": with_fixtures(
        "SELECT state, facility_count, average_daily_census, average_staffing_hprd, average_rn_hprd, "
        "average_occupancy_percent, average_contract_hour_percent FROM mart_state "
        "WHERE calendar_quarter = '1998Q3' AND state IN ('NATION_12', 'NATION_13', 'NATION_3', 'NATION_5', 'NATION_9')"
    ),
    "watchlist_table_selected": with_fixtures(
        r6_select(
            "SELECT staffing_rank, facility_name, facility_ccn, state, average_daily_census, "
            "average_staffing_hprd, average_rn_hprd, average_occupancy_rate * 100.0 AS average_occupancy_percent, "
            "contract_hour_percentage, contract_hour_percentage * 100.0 AS contract_hour_percent FROM mart_low "
            "WHERE calendar_quarter = '1998Q3' AND state IN ('NATION_12', 'NATION_13', 'NATION_3', 'NATION_5', 'NATION_9')",
            ["average_daily_census", "average_staffing_hprd", "average_rn_hprd", "average_occupancy_percent"],
        )
    ),
    "quality_detail_claims": with_fixtures(
        r6_select(
            """SELECT facility_name, facility_ccn, state, average_staffing_hprd, average_rn_hprd,
  measure_name, measure_score, measure_period
FROM page_quality_base q
WHERE quality_source = 'claims_quality_measure'
  AND measure_name = (SELECT min(measure_name) FROM page_quality_base
                      WHERE quality_source = 'claims_quality_measure')""",
            ["average_staffing_hprd", "average_rn_hprd", "measure_score"],
        )
    ),
    "state_table_display": with_fixtures(
        f"""SELECT state, CAST(CAST(facility_count AS BIGINT) AS VARCHAR) AS "Facilities",
  printf('%.1f', {rnd('average_daily_census', 1)}) AS "Average daily census",
  printf('%.2f', {rnd('average_staffing_hprd', 2)}) AS "Staffing HPRD",
  printf('%.2f', {rnd('average_rn_hprd', 2)}) AS "RN HPRD",
  printf('%.1f%%', {rnd('average_occupancy_percent', 1)}) AS "Occupancy proxy",
  printf('%.1f%%', {rnd('average_contract_hour_percent', 1)}) AS "Contractor hours"
FROM page_state"""
    ),
    "quality_detail_display": with_fixtures(
        f"""SELECT facility_name AS "Facility", facility_ccn AS "CMS CCN", state,
  printf('%.2f', {rnd('average_staffing_hprd', 2)}) AS "Staffing HPRD",
  printf('%.2f', {rnd('average_rn_hprd', 2)}) AS "RN HPRD",
  measure_name AS "Quality measure",
  printf('%.2f', {rnd('measure_score', 2)}) AS "Score",
  measure_period AS "Reporting period"
FROM page_quality"""
    ),
    "parquet_roundtrip_gold": with_fixtures(
        r6_select("SELECT * FROM fx_quarterly", _avg_cols(QUARTERLY_COLS))
    ),
    "csv_roundtrip_staffing": with_fixtures("SELECT * FROM clean_staffing"),
    "csv_roundtrip_supporting": with_fixtures(r6_select("SELECT * FROM fx_quality", ["measure_score"])),
    "silver_roundtrip_staffing": with_fixtures(
        "SELECT * FROM clean_staffing WHERE regexp_full_match(facility_ccn, '[0-9]{6}') "
        "AND work_date IS NOT NULL AND resident_census >= 0"
    ),
    "report_roundtrip_missing": PROFILE_SQL["profile_missing"],
    "catalog_roundtrip_state_summary": with_fixtures("SELECT * FROM mart_state"),
    "bronze_key": (
        "SELECT page_id, concat_ws('/', NULLIF(regexp_replace('/bronze/pages/', '^/+|/+$', '', 'g'), ''), "
        "string_split(url, '/')[-1]) AS bronze_key FROM pages"
    ),
}
