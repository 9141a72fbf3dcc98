"""One small hand-made DataFrame per easy-to-get-wrong rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staffwise.functions import (
    bronze_key, ccn, contains_any_ci, hours, missing_severity, parse_date,
    round_half_up, safe_ratio, to_int,
)
from staffwise.operators import checks, gold, marts, pages, silver


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw,expected",
    [("15009", "015009"), ("  15009 ", "015009"), ("1234567", "123456"), ("", "000000"),
     ("   ", "000000"), (None, None), ("\t15", "000\t15")],
)
def test_ccn_normalisation(spark, raw, expected):
    assert one(spark, ccn("x"), raw) == expected


@pytest.mark.parametrize(
    "raw,expected", [("12.5", 12.5), ("", 0.0), ("N/A", 0.0), (None, 0.0), ("3", 3.0)]
)
def test_hours_default_zero(spark, raw, expected):
    assert one(spark, hours("x"), raw) == expected


@pytest.mark.parametrize(
    "raw,expected", [("12.7", 12), ("-1", -1), ("", None), ("N/A", None), ("9e12", None), ("0", 0)]
)
def test_int_parse_truncates(spark, raw, expected):
    assert one(spark, to_int("x"), raw) == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_independent_of_ansi(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([("bad", "x", 0), ("20240105", "5", 2)], "d string, h string, c int")
        rows = df.select(
            parse_date("d", "yyyyMMdd").alias("d"), to_int("h").alias("i"),
            safe_ratio(F.lit(10.0), "c").alias("r"),
        ).collect()
        assert rows[0].d is None and rows[0].i is None and rows[0].r is None
        assert rows[1].d == dt.date(2024, 1, 5) and rows[1].i == 5 and rows[1].r == 5.0
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_survey_date_needs_padding(spark):
    assert one(spark, parse_date("x", "MM/dd/yyyy"), "1/5/2024") is None
    assert one(spark, parse_date("x", "MM/dd/yyyy"), "01/05/2024") == dt.date(2024, 1, 5)


def test_validity_filter_and_reasons(spark):
    rows = [
        ("015009", dt.date(2024, 4, 1), 10),
        ("0000A5", dt.date(2024, 4, 1), 10),
        ("015010", None, 10),
        ("015011", dt.date(2024, 4, 1), -1),
        ("015012", dt.date(2024, 4, 1), None),
        ("015013", dt.date(2024, 4, 1), 0),
    ]
    df = spark.createDataFrame(rows, "facility_ccn string, work_date date, resident_census int")
    valid = {r.facility_ccn for r in silver.valid_staffing(df).collect()}
    assert valid == {"015009", "015013"}
    reasons = {r.reject_reason: r.rejected_rows for r in silver.rejected_reason_counts(df).collect()}
    assert reasons == {"invalid_ccn": 1, "missing_work_date": 1, "invalid_census": 2}
    assert silver.valid_staffing(df).count() + sum(reasons.values()) == df.count()


def test_duplicate_guard_groups_null_keys(spark):
    df = spark.createDataFrame([("1", None), ("1", None), ("2", "x")], "facility_ccn string, work_date string")
    assert checks.duplicate_key_count(df, ["facility_ccn", "work_date"]).first()[0] == 1
    with pytest.raises(checks.DataCheckError, match="not unique: 1"):
        checks.assert_unique(df, ["facility_ccn", "work_date"])


def _daily_input(spark):
    cols = ("facility_ccn string, work_date date, calendar_quarter string, facility_name string, state string, "
            "resident_census int, rn_hours double, lpn_hours double, cna_hours double, director_rn_hours double, "
            "rn_admin_hours double, lpn_admin_hours double, nurse_aide_training_hours double, "
            "medication_aide_hours double, employee_nursing_hours double, contract_nursing_hours double")
    d = dt.date(2024, 4, 1)
    rows = [
        ("000001", d, "2024Q2", "A", "TX", 10, 5.0, 5.0, 10.0, 1, 1, 1, 1, 1, 20.0, 5.0),
        ("000001", d + dt.timedelta(1), "2024Q2", "A", "TX", 0, 5.0, 5.0, 10.0, 0, 0, 0, 0, 0, 0.0, 0.0),
        ("000002", d, "2024Q2", "B", "TX", 20, 2.0, 2.0, 2.0, 0, 0, 0, 0, 0, 0.0, 0.0),
        ("000003", d, "2024Q2", "C", "CA", 5, 1.0, 1.0, 1.0, 0, 0, 0, 0, 0, 3.0, 1.0),
    ]
    staffing = spark.createDataFrame([tuple(float(x) if i >= 6 else x for i, x in enumerate(r)) for r in rows], cols)
    facility = spark.createDataFrame([("000001", 20), ("000002", 0), ("000001", 20)], "facility_ccn string, certified_beds int")
    return staffing, facility


def test_daily_metrics_and_fanout(spark):
    staffing, facility = _daily_input(spark)
    daily = gold.facility_daily(staffing, facility)
    # facility 000001 appears twice in the facility table -> its days double
    assert daily.count() == 6
    r = daily.where("facility_ccn = '000002'").first()
    assert r.total_nursing_hours == 6.0 and r.staffing_hours_per_resident_day == 0.3
    assert r.occupancy_rate_proxy is None  # zero beds
    r3 = daily.where("facility_ccn = '000003'").first()
    assert r3.certified_beds is None and r3.occupancy_rate_proxy is None  # no facility row
    zero = daily.where("resident_census = 0").first()
    assert zero.staffing_hours_per_resident_day is None


def test_quarterly_average_of_ratios_and_ratio_of_sums(spark):
    staffing, _ = _daily_input(spark)
    facility = spark.createDataFrame([("000001", 20)], "facility_ccn string, certified_beds int")
    q = gold.facility_quarterly(gold.facility_daily(staffing, facility)).where("facility_ccn='000001'").first()
    assert q.days_reported == 2
    assert q.average_staffing_hprd == pytest.approx(2.5)  # zero-census day skipped by avg
    assert q.average_daily_census == 5.0  # but counted in the census average
    assert q.contract_hour_percentage == pytest.approx(5.0 / 25.0)
    q3 = gold.facility_quarterly(gold.facility_daily(staffing, facility)).where("facility_ccn='000002'").first()
    assert q3.contract_hour_percentage is None  # no employee or contract hours


def test_staffing_quality_keeps_unmatched(spark):
    quarterly = spark.createDataFrame([("1", "x"), ("2", "y")], "facility_ccn string, calendar_quarter string")
    quality = spark.createDataFrame(
        [("1", "s", "c1", "m1", 1.0, "p"), ("1", "s", "c2", "m2", 2.0, "p")],
        "facility_ccn string, quality_source string, measure_code string, measure_name string, "
        "measure_score double, measure_period string",
    )
    out = gold.staffing_quality(quarterly, quality)
    assert out.count() == 3  # sum of max(1, measures)
    assert out.where("facility_ccn='2'").first().measure_code is None


def test_state_summary_rounding_and_units(spark):
    df = spark.createDataFrame(
        [("1", "TX", "2024Q2", 10.0, 3.125, 1.0, 0.5, 0.1), ("2", "TX", "2024Q2", 20.0, 3.13, 1.0, 0.25, None),
         ("3", None, "2024Q2", 1.0, 1.0, 1.0, 1.0, 1.0)],
        "facility_ccn string, state string, calendar_quarter string, average_daily_census double, "
        "average_staffing_hprd double, average_rn_hprd double, average_occupancy_rate double, "
        "contract_hour_percentage double",
    )
    rows = marts.state_summary(df).collect()
    assert len(rows) == 1  # NULL state dropped
    r = rows[0]
    assert r.facility_count == 2 and r.average_daily_census == 15.0
    assert r.average_staffing_hprd == 3.13  # 3.1275 half-up
    assert r.average_occupancy_percent == 37.5 and r.average_contract_hour_percent == 10.0


def test_low_staffing_global_rank_and_ties(spark):
    rows = [(f"{i:06d}", f"F{i}", "TX" if i % 2 else "CA", "2024Q2", 1.0, float(i // 2), 1.0, 1.0, 0.1) for i in range(14)]
    rows.append(("999999", "Z", "TX", "2024Q2", 1.0, None, 1.0, 1.0, 0.1))
    df = spark.createDataFrame(
        rows,
        "facility_ccn string, facility_name string, state string, calendar_quarter string, "
        "average_daily_census double, average_staffing_hprd double, average_rn_hprd double, "
        "average_occupancy_rate double, contract_hour_percentage double",
    )
    out = marts.low_staffing(df).orderBy("staffing_rank").collect()
    assert [r.staffing_rank for r in out] == list(range(1, 11))
    assert [r.facility_ccn for r in out[:2]] == ["000000", "000001"]  # tie broken by key
    # the state filter applies after the rank: fewer rows, not the state's own top 10
    assert pages.watchlist_table(marts.low_staffing(df), states=["TX"]).count() == 5


def test_readmission_filter(spark):
    df = spark.createDataFrame(
        [("1", "Short-stay REHOSPITALIZATION", 1.0), ("2", "FY readmission rate", 2.0),
         ("3", "Other", 3.0), ("4", "Readmission", None)],
        "facility_ccn string, measure_name string, measure_score double",
    )
    got = df.where(F.col("measure_score").isNotNull() & contains_any_ci("measure_name", marts.READMISSION_PATTERNS))
    assert sorted(r.facility_ccn for r in got.collect()) == ["1", "2"]


@pytest.mark.parametrize(
    "prefix,name,expected",
    [("/bronze/x/", "a/b/file.csv", "bronze/x/file.csv"), ("", "file.csv", "file.csv"),
     ("//", "dir/f", "f"), ("p", "f", "p/f")],
)
def test_bronze_key(spark, prefix, name, expected):
    from staffwise.sources.landing import bronze_target

    assert one(spark, bronze_key(prefix, F.col("x")), name) == expected
    assert bronze_target(prefix, name) == expected


def test_round_half_up_and_severity(spark):
    assert one(spark, round_half_up(F.col("x"), 2), 2.675, "x double") == 2.68
    assert [one(spark, missing_severity(F.col("x")), v, "x double") for v in (0.0, 0.05, 0.5)] == ["ok", "warn", "bad"]


def test_quarter_default_is_latest_text(spark):
    df = spark.createDataFrame([("2024Q1", "TX"), ("2024Q2", "TX"), ("2024Q2", None)], "calendar_quarter string, state string")
    out = pages.filter_states(pages.choose_quarter(df)).collect()
    assert [(r.calendar_quarter, r.state) for r in out] == [("2024Q2", "TX")]


def test_display_table_labels_and_formats(spark):
    df = spark.createDataFrame(
        [("TX", 3, 12.345, 2.675, 1.0, 87.25, None)],
        "state string, facility_count long, average_daily_census double, average_staffing_hprd double, "
        "average_rn_hprd double, average_occupancy_percent double, average_contract_hour_percent double",
    )
    r = pages.display_table(df, "state_table").first().asDict()
    assert r == {"state": "TX", "Facilities": "3", "Average daily census": "12.3", "Staffing HPRD": "2.68",
                 "RN HPRD": "1.00", "Occupancy proxy": "87.3%", "Contractor hours": None}
    raw = pages.display_table(df, "state_table", formatted=False)
    assert raw.columns[1] == "Facilities" and raw.first()["Staffing HPRD"] == 2.675


def test_whole_numbers_only_from_digits(spark):
    from staffwise.functions import round_half_up, to_int

    texts = {"12": 12, "12.7": 12, " 7 ": 7, "-3": -3, "12d": None, "12f": None, "1e2": None, "": None, "x": None, ".5": 0, "99999999999": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.n for r in df.select("t", to_int("t").alias("n")).collect()} == texts
    values = spark.createDataFrame([(2.675,), (1e22,), (float("inf"),), (None,)], "v double").select(round_half_up("v", 2).alias("r")).collect()
    assert [r.r for r in values] == [2.68, 1e22, float("inf"), None]


def test_empty_page_is_an_error(spark):
    df = spark.createDataFrame([("TX", 1)], "state string, n long")
    assert pages.shown(df, "overview") is df
    with pytest.raises(checks.DataCheckError, match="overview"):
        pages.shown(df.where("n > 1"), "overview")


def test_mart_lookup_errors_and_lower_case(spark):
    from staffwise.sources import readers

    with pytest.raises(checks.TableNotFoundError, match="could not be loaded"):
        readers.load_mart(spark, "no_such_mart_xyz")
    spark.createDataFrame([("TX", 1)], "STATE string, FACILITY_COUNT long").createOrReplaceTempView("mart_upper_test")
    df = readers.load_mart(spark, "mart_upper_test", cache=True)
    assert df.columns == ["state", "facility_count"] and df.count() == 1
    readers.load_mart(spark, "mart_upper_test", cache=True)
    assert spark.catalog.isCached("mart_upper_test")
    readers.release_mart(spark, "mart_upper_test")
    assert not spark.catalog.isCached("mart_upper_test")


def test_quality_page_defaults_and_selections(spark):
    df = spark.createDataFrame(
        [("1", "A", "TX", "2024Q2", "claims", "b-measure", 1.0, 1.0, 1.0, 1.0, "p"),
         ("2", "B", "TX", "2024Q2", "vbp", "a-measure", 2.0, 1.0, 1.0, 1.0, "p"),
         ("3", "C", None, "2024Q2", "claims", "0-null-state", 3.0, 1.0, 1.0, 1.0, "p"),
         ("4", "D", "CA", "2024Q1", "claims", "a-measure", 4.0, 1.0, 1.0, 1.0, "p")],
        "facility_ccn string, facility_name string, state string, calendar_quarter string, quality_source string, "
        "measure_name string, measure_score double, average_staffing_hprd double, average_rn_hprd double, "
        "average_daily_census double, measure_period string",
    )

    def ccns(**kw):
        return sorted(r.facility_ccn for r in pages.quality_detail(df, **kw).collect())

    assert ccns() == ["2"]  # latest quarter, NULL state dropped, first measure
    assert ccns(source="claims") == ["1"]
    assert ccns(quarter="2024Q1") == ["4"]
    assert ccns(measure="b-measure") == ["1"]
    assert ccns(quarter="2024Q1", measure="a-measure") == ["4"]
    assert ccns(states=["CA"]) == []  # latest quarter has no CA rows


def test_alphanumeric_keys_kept_outside_staffing(spark):
    provider = spark.createDataFrame(
        [(" A5", "N", "TX", "10", "1", "x", "1", "1", "1", "1")],
        "`CMS Certification Number (CCN)` string, `Provider Name` string, State string, "
        "`Number of Certified Beds` string, `Average Number of Residents per Day` string, `Ownership Type` string, "
        "`Overall Rating` string, `Staffing Rating` string, `Total nursing staff turnover` string, "
        "`Registered Nurse turnover` string",
    )
    assert silver.clean_facility(provider).first().facility_ccn == "0000A5"


def test_renamed_facility_gives_two_quarter_rows(spark):
    staffing, facility = _daily_input(spark)
    renamed = staffing.withColumn(
        "facility_name", F.when(F.col("resident_census") == 0, F.lit("A renamed")).otherwise(F.col("facility_name")))
    q = gold.facility_quarterly(gold.facility_daily(renamed, facility.dropDuplicates()))
    assert q.where("facility_ccn = '000001'").count() == 2


def test_not_null_failure_is_reported(spark):
    df = spark.createDataFrame([("1", None), (None, None)], "facility_ccn string, work_date date")
    res = checks.not_null_results({"t": (df, ["facility_ccn", "work_date"])})
    rows = {r.column_name: (r.failing_rows, r.passed) for r in res.collect()}
    assert rows == {"facility_ccn": (1, False), "work_date": (2, False)}
    with pytest.raises(checks.DataCheckError, match=r"t.facility_ccn=1, t.work_date=2"):
        checks.assert_passed(res)
