"""File-path tests: hand-made CSV files (ISO-8859-1) through every job, with
hand-computed marts. Rows cover the cases listed in FIXTURES.md A4."""

import csv
import hashlib
import os
import uuid

import pytest
from pyspark.sql import functions as F

from staffwise.operators.checks import DataCheckError
from staffwise.plans import jobs
from staffwise.sources import landing, readers
from staffwise.sources.schemas import SPLIT_STEMS, STAFF_CATEGORIES

DATABASE = f"staffwise_test_{uuid.uuid4().hex}"

PBJ_HEADER = (
    ["PROVNUM", "PROVNAME", "STATE", "CY_Qtr", "WorkDate", "MDScensus"]
    + [s for s, _ in STAFF_CATEGORIES]
    + [f"{s}_{k}" for s in SPLIT_STEMS for k in ("emp", "ctr")]
)


def pbj_row(ccn, date, qtr, census, name="N", state="TX", **hours):
    row = {c: "" for c in PBJ_HEADER}
    row.update(PROVNUM=ccn, PROVNAME=name, STATE=state, CY_Qtr=qtr, WorkDate=date, MDScensus=census)
    row.update(hours)
    return row


VALID = [
    # A: short key, accented name, 100 beds; zero-census day; two quarters
    pbj_row("15009", "20240401", "2024Q2", "50", "Résidence A", "TX", Hrs_RN="10", Hrs_LPN="20", Hrs_CNA="70",
            Hrs_RN_emp="90", Hrs_RN_ctr="10"),
    pbj_row("15009", "20240402", "2024Q2", "0", "Résidence A", "TX", Hrs_RN="5"),
    pbj_row("15009", "20240701", "2024Q3", "40", "Résidence A", "TX", Hrs_RN="N/A", Hrs_CNA="80.5"),
    # B: key with spaces, zero beds, census 12.7 -> 12, same HPRD as A, no emp/ctr hours
    pbj_row(" 15010 ", "20240401", "2024Q2", "12.7", "B Home", "TX", Hrs_RN="24"),
    # C: empty beds in provider file, no measures
    pbj_row("15011", "20240401", "2024Q2", "10", "C", "CA", Hrs_RN="30"),
    # D: state 01, missing from provider file
    pbj_row("15012", "20240401", "2024Q2", "20", "D", "01", Hrs_RN="20"),
    # E: over-long key cut to 6, empty state
    pbj_row("1234567", "20240401", "2024Q2", "10", "E", "", Hrs_RN="10"),
]
INVALID = [
    pbj_row("0A1234", "20240401", "2024Q2", "10"),  # alphanumeric key
    pbj_row("", "20240401", "2024Q2", "10"),  # empty key
    pbj_row("15009", "bad", "2024Q2", "10"),  # bad date
    pbj_row("15010", "20240231", "2024Q2", "10"),  # day out of range
    pbj_row("15011", "20240402", "2024Q2", ""),  # census empty
    pbj_row("15011", "20240403", "2024Q2", "-3"),  # census negative
]

PROVIDER_HEADER = ["CMS Certification Number (CCN)", "Provider Name", "State", "Number of Certified Beds",
                   "Average Number of Residents per Day", "Ownership Type", "Overall Rating", "Staffing Rating",
                   "Total nursing staff turnover", "Registered Nurse turnover"]
PROVIDER = [
    ["15009", "Résidence A", "TX", "100", "45.5", "For profit", "4", "3", "40.1", "35"],
    ["15010", "B Home", "TX", "0", "10", "Non profit", "2", "N/A", "", ""],
    ["15011", "C", "CA", "", "9", "Government", "5", "5", "1", "2"],
    ["123456", "E", "", "20", "8", "For profit", "1", "1", "3", "4"],
]
CLAIMS_HEADER = ["CMS Certification Number (CCN)", "State", "Measure Code", "Measure Description",
                 "Resident type", "Adjusted Score", "Measure Period"]
CLAIMS = [
    ["15009", "TX", "521", "Short-stay Rehospitalization Rate", "Short Stay", "20.5", "2023Q1-2023Q4"],
    ["15009", "TX", "551", "Hospitalizations per 1000 long-stay resident days", "Long Stay", "1.5", "2023"],
    ["15010", "TX", "521", "Short-stay Rehospitalization Rate", "Short Stay", "", "2023Q1-2023Q4"],
]
VBP_HEADER = ["CMS Certification Number (CCN)", "State", "Performance Period: FY 2022 Risk-Standardized Readmission Rate"]
VBP = [["15009", "TX", "0.21"], ["15012", "01", "0.19"]]
CITATIONS_HEADER = ["CMS Certification Number (CCN)", "State", "Survey Date", "Survey Type", "Deficiency Category",
                    "Deficiency Tag Number", "Scope Severity Code", "Complaint Deficiency"]
CITATIONS = [
    ["15009", "TX", "01/05/2024", "Health", "Infection Control", "0880", "D", "N"],
    ["15010", "TX", "1/5/2024", "Health", "Resident Rights", "0550", "E", "Y"],
]


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="latin-1") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow([r[c] for c in header] if isinstance(r, dict) else r)


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    bronze = os.path.join(root, "plain")
    os.makedirs(bronze)
    write_csv(f"{bronze}/PBJ_Daily_Nurse_Staffing_Q2_2024.csv", PBJ_HEADER, VALID + INVALID)
    write_csv(f"{bronze}/{readers.PROVIDER_FILE}", PROVIDER_HEADER, PROVIDER)
    write_csv(f"{bronze}/{readers.CLAIMS_FILE}", CLAIMS_HEADER, CLAIMS)
    write_csv(f"{bronze}/{readers.VBP_FILE}", VBP_HEADER, VBP)
    write_csv(f"{bronze}/{readers.CITATIONS_FILE}", CITATIONS_HEADER, CITATIONS)
    return root


@pytest.fixture(scope="module")
def run(spark, lake):
    return jobs.run_all(
        spark,
        f"{lake}/plain",
        f"{lake}/bronze",
        f"{lake}/silver",
        f"{lake}/gold",
        f"{lake}/marts",
        DATABASE,
    )


def test_staffing_job_counts(run):
    m = run[1].metrics
    assert (m["cleaned_rows"], m["written_rows"], m["rejected_rows"]) == (13, 7, 6)


def test_silver_reads_back_typed(spark, lake, run):
    s = readers.read_silver_staffing(spark, f"{lake}/silver/silver_daily_staffing/")
    rows = {(r.facility_ccn, str(r.work_date)): r for r in s.collect()}
    assert set(k for k, _ in rows) == {"015009", "015010", "015011", "015012", "123456"}
    assert rows[("015010", "2024-04-01")].resident_census == 12
    assert rows[("015012", "2024-04-01")].state == "01"  # not an int
    assert rows[("123456", "2024-04-01")].state is None  # empty state
    assert rows[("015009", "2024-04-01")].facility_name == "Résidence A"
    assert rows[("015009", "2024-07-01")].rn_hours == 0.0  # N/A -> 0
    c = readers.read_silver_citations(spark, f"{lake}/silver/silver_health_citations/")
    assert sorted((r.facility_ccn, str(r.survey_date)) for r in c.collect()) == [
        ("015009", "2024-01-05"), ("015010", "None")]


def test_gold_quarterly_values(spark, lake, run):
    q = {(r.facility_ccn, r.calendar_quarter): r
         for r in readers.read_gold_quarterly(spark, f"{lake}/gold/{jobs.GOLD_QUARTERLY}/").collect()}
    a = q[("015009", "2024Q2")]
    assert a.days_reported == 2 and a.average_daily_census == 25.0
    assert a.average_staffing_hprd == 2.0 and a.average_occupancy_rate == 0.25
    assert a.total_nursing_hours == 105.0 and a.contract_hour_percentage == pytest.approx(0.1)
    assert q[("015009", "2024Q3")].average_staffing_hprd == pytest.approx(80.5 / 40)
    b = q[("015010", "2024Q2")]
    assert b.average_occupancy_rate is None and b.contract_hour_percentage is None
    assert q[("015012", "2024Q2")].average_occupancy_rate is None  # not in provider file


def test_marts(spark, lake, run):
    st = {(r.state, r.calendar_quarter): r for r in spark.read.parquet(f"{lake}/marts/mart_state_staffing_summary").collect()}
    assert set(st) == {("TX", "2024Q2"), ("CA", "2024Q2"), ("01", "2024Q2"), ("TX", "2024Q3")}
    tx = st[("TX", "2024Q2")]
    assert (tx.facility_count, tx.average_staffing_hprd, tx.average_occupancy_percent,
            tx.average_contract_hour_percent) == (2, 2.0, 25.0, 10.0)
    low = spark.read.parquet(f"{lake}/marts/mart_low_staffing_facilities").where("calendar_quarter = '2024Q2'")
    ranks = [r.facility_ccn for r in low.orderBy("staffing_rank").collect()]
    assert ranks == ["015012", "123456", "015009", "015010", "015011"]
    qual = spark.read.parquet(f"{lake}/marts/mart_staffing_quality")
    got = sorted((r.facility_ccn, r.calendar_quarter, r.quality_source) for r in qual.collect())
    assert got == [
        ("015009", "2024Q2", "claims_quality_measure"), ("015009", "2024Q2", "vbp_readmission_rate"),
        ("015009", "2024Q3", "claims_quality_measure"), ("015009", "2024Q3", "vbp_readmission_rate"),
        ("015012", "2024Q2", "vbp_readmission_rate"),
    ]
    sq = readers.read_gold_staffing_quality(spark, f"{lake}/gold/{jobs.GOLD_STAFFING_QUALITY}/")
    assert sq.count() == 10  # sum over facility-quarters of max(1, measures)
    assert all(t["passed"] for t in run[4].metrics["tests"]) and len(run[4].metrics["tests"]) == 10


def test_duplicate_facility_day_fails(spark, lake):
    path = f"{lake}/dup.csv"
    write_csv(path, PBJ_HEADER, [VALID[0], VALID[0]])
    with pytest.raises(DataCheckError, match="facility-day keys are not unique: 1"):
        jobs.staffing_bronze_to_silver(spark, path, f"{lake}/silver_dup")


def sha256(path):
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def test_landing_folder(spark, lake, tmp_path):
    out = landing.land_folder(spark, f"{lake}/plain", str(tmp_path / "landed"), prefix="/raw/cms/")
    assert len(out) == 5 and all("/raw/cms/" in p for p in out)
    for path in out:
        assert sha256(path) == sha256(f"{lake}/plain/{os.path.basename(path)}")
    assert sorted(os.listdir(tmp_path / "landed")) == ["raw"]  # nothing staged is left
    keys = landing.landing_keys(spark, f"{lake}/plain", "raw/").collect()
    assert sorted(r.bronze_key for r in keys)[0].startswith("raw/")


AWKWARD = {
    "quotes.csv": b'a,b\n"q,""x"",y",""\n"two\r\nlines",z\r\nno end',
    "empty.csv": b"",
    "notes.pdf": b"%PDF-\x00\xff\xfe" * 5,
    "name with space %20 \u00e9.csv": b"a\n1\n",
    "large.bin": bytes(range(256)) * 9000 + b"tail",
}


def test_landing_keeps_every_byte(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "PIECE_BYTES", 1000)
    source = tmp_path / "in"
    os.makedirs(source)
    for name, data in AWKWARD.items():
        (source / name).write_bytes(data)
    ranges = landing.byte_ranges(landing.listing(spark, str(source)).selectExpr("*", "file_name target", "'file:/x' root"), 100_001)
    counts = {r.target: r["count"] for r in ranges.groupBy("target").count().collect()}
    assert counts["large.bin"] == 24 and counts["empty.csv"] == 1
    spark.sparkContext.setJobGroup("landing", "landing")
    out = landing.land_folder(spark, str(source), str(tmp_path / "out"), "raw", range_bytes=100_001)
    status = spark.sparkContext.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("landing") for s in status.getJobInfo(j).stageIds if status.getStageInfo(s)]
    spark.sparkContext.setJobGroup("", "")
    assert tasks.count(28) == 1  # every range of every file in one stage
    assert {os.path.basename(p): open(p, "rb").read() for p in out} == AWKWARD
    assert landing.land_file(spark, str(source / "quotes.csv"), str(tmp_path / "one"), "x/q.csv") == f"{tmp_path}/one/x/q.csv"
    assert sha256(tmp_path / "one/x/q.csv") == sha256(source / "quotes.csv")


def test_failed_landing_leaves_the_files_of_before(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    os.makedirs(source)
    (source / "a.csv").write_bytes(b"old")
    (source / "b.csv").write_bytes(b"old")
    landing.land_folder(spark, str(source), str(out))
    (source / "a.csv").write_bytes(b"new")
    files = landing.listing(spark, str(source)).withColumn("target", F.col("file_name"))
    short = files.withColumn("file_size", F.when(F.col("file_name") == "b.csv", F.lit(9).cast("long")).otherwise(F.col("file_size")))
    with pytest.raises(Exception, match="became shorter"):
        landing._land(spark, short, str(out), 2)
    assert sorted(os.listdir(out)) == ["a.csv", "b.csv"]
    assert (out / "a.csv").read_bytes() == b"old"


def test_landing_refuses(spark, lake, tmp_path):
    os.makedirs(tmp_path / "empty")
    with pytest.raises(DataCheckError, match="is empty"):
        landing.land_folder(spark, str(tmp_path / "empty"), str(tmp_path / "x"))
    with pytest.raises(DataCheckError, match="cannot hold 5 files"):
        landing.land_folder(spark, f"{lake}/plain", str(tmp_path / "x"), key="one.csv")
    assert not os.path.exists(tmp_path / "x")
    os.makedirs(tmp_path / "y" / readers.VBP_FILE)
    with pytest.raises(Exception, match="is a folder"):
        landing.land_folder(spark, f"{lake}/plain", str(tmp_path / "y"))
    assert os.listdir(tmp_path / "y") == [readers.VBP_FILE]


def test_landing_inventory_lists_files(spark, lake):
    rows = readers.landing_inventory(spark, f"{lake}/plain").collect()
    names = [r.file_name for r in rows]
    assert names == sorted(names) and readers.CLAIMS_FILE in names
    assert all(r.file_type == "csv" and r.file_size > 0 for r in rows)


def test_marts_need_a_place(spark, lake, run):
    with pytest.raises(ValueError, match="no place"):
        jobs.gold_to_marts(spark, f"{lake}/gold", save_tables=False)


def test_marts_as_tables_by_default(spark, lake, run):
    result = jobs.gold_to_marts(spark, f"{lake}/gold", database=DATABASE)
    assert result.outputs["mart_staffing_quality"] == f"{DATABASE}.mart_staffing_quality"
    assert readers.load_mart(spark, f"{DATABASE}.mart_state_staffing_summary").count() == 4
    assert readers.source(spark, "STAFFING_QUALITY_ANALYSIS", DATABASE).count() == 10


def test_profile_file_report(spark, lake, tmp_path):
    tables = jobs.profile_file(spark, f"{lake}/plain/PBJ_Daily_Nurse_Staffing_Q2_2024.csv", str(tmp_path / "report"))
    assert set(tables) == {"overview", "data_dictionary", "missing_values", "summary_statistics",
                           "data_quality", "sample_data"}
    overview = {r.metric: r.value for r in tables["overview"].collect()}
    assert overview["Total Rows"] == "13" and overview["Total Columns"] == str(len(PBJ_HEADER))
    assert float(overview["Input Size (MB)"]) >= 0
    types = {r.column_name: r.data_type for r in tables["data_dictionary"].collect()}
    assert types["PROVNUM"] == "object" and types["MDScensus"] == "float64" and types["Hrs_RN"] == "float64"
    assert tables["sample_data"].columns == PBJ_HEADER
    assert sorted(os.listdir(tmp_path / "report")) == sorted(tables)
    # the accented name survives the cp1252 read
    assert any(r.PROVNAME == "Résidence A" for r in tables["sample_data"].collect())


def test_cp1252_characters_survive(spark, tmp_path):
    path = tmp_path / "cp1252.csv"
    text = "name,price\nSaint Mary’s — East,€5\nPlain,7\n"
    path.write_bytes(text.encode("cp1252"))
    got = [r.name for r in readers.read_bronze_cp1252(spark, str(path)).collect()]
    assert got == ["Saint Mary’s — East", "Plain"]
    # read as ISO-8859-1 only, the same bytes come back as C1 control characters
    raw = [r.name for r in readers.read_bronze_csv(spark, str(path)).collect()]
    assert raw[0] != got[0] and "\x92" in raw[0]


def test_guard_runs_before_validity(spark, tmp_path):
    # two rows of the same alphanumeric key and day: both would be filtered
    # out as invalid, yet the duplicate guard (which runs first) fails the job
    path = str(tmp_path / "dup_invalid.csv")
    write_csv(path, PBJ_HEADER, [INVALID[0], INVALID[0]])
    with pytest.raises(DataCheckError, match="not unique"):
        jobs.staffing_bronze_to_silver(spark, path, str(tmp_path / "silver"))


def test_guard_reads_the_staged_files_only(spark, lake, tmp_path, monkeypatch):
    guarded = []
    check = jobs.checks.assert_unique
    monkeypatch.setattr(jobs.checks, "assert_unique", lambda df, *rest: (guarded.extend(df.inputFiles()), check(df, *rest)))
    out = str(tmp_path / "silver")
    result = jobs.staffing_bronze_to_silver(spark, f"{lake}/plain/{readers.STAFFING_FILE}", out)
    assert result.metrics == {"cleaned_rows": 13, "written_rows": 7, "rejected_rows": 6}
    assert guarded and all("silver__stage-" in f and f.endswith(".parquet") for f in guarded)
    assert any("staged_valid=false" in f for f in guarded)  # keys of rejected rows are checked too
    assert os.listdir(tmp_path) == ["silver"]  # staging is gone


def test_failed_guard_leaves_silver(spark, lake, tmp_path):
    out = str(tmp_path / "silver")
    jobs.staffing_bronze_to_silver(spark, f"{lake}/plain/{readers.STAFFING_FILE}", out)
    before = sorted((d, f) for d, _, files in os.walk(out) for f in files)
    path = str(tmp_path / "dup.csv")
    write_csv(path, PBJ_HEADER, [VALID[0], VALID[0]])
    with pytest.raises(DataCheckError, match="not unique"):
        jobs.staffing_bronze_to_silver(spark, path, out)
    assert sorted((d, f) for d, _, files in os.walk(out) for f in files) == before
    assert sorted(os.listdir(tmp_path)) == ["dup.csv", "silver"]


def test_silver_without_valid_rows_is_empty(spark, lake, tmp_path):
    path, out = str(tmp_path / "bad.csv"), str(tmp_path / "silver")
    jobs.staffing_bronze_to_silver(spark, f"{lake}/plain/{readers.STAFFING_FILE}", out)
    write_csv(path, PBJ_HEADER, INVALID)
    assert jobs.staffing_bronze_to_silver(spark, path, out).metrics["written_rows"] == 0
    assert readers.read_silver_staffing(spark, out).count() == 0


def test_csv_blanks_and_spaces(spark, tmp_path):
    path = tmp_path / "blanks.csv"
    path.write_text('a,b,c\n,"", x \n', encoding="latin-1")
    r = readers.read_bronze_csv(spark, str(path)).first()
    assert r.a is None and r.b is None and r.c == " x "


def test_static_and_dynamic_overwrite(spark, tmp_path):
    from staffwise.sources import writers

    path = str(tmp_path / "gold")
    cols = "facility_ccn string, calendar_quarter string, state string, v double"
    writers.write_gold(spark.createDataFrame([("1", "2024Q1", "TX", 1.0), ("2", "2024Q2", "TX", 2.0)], cols), path)
    writers.write_gold(spark.createDataFrame([("3", "2024Q2", "TX", 3.0)], cols), path, dynamic=True)
    got = sorted(r.facility_ccn for r in spark.read.parquet(path).collect())
    assert got == ["1", "3"]  # 2024Q1 kept, 2024Q2 replaced
    writers.write_gold(spark.createDataFrame([("4", "2024Q3", "TX", 4.0)], cols), path)
    assert [r.facility_ccn for r in spark.read.parquet(path).collect()] == ["4"]  # static: whole table
