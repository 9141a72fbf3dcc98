"""Plan shape: what the optimizer must do for the operators to scale."""

from pyspark.sql import functions as F

from conftest import SF0001
from staffwise.operators import marts
from staffwise.plans import queries as Q
from staffwise.sources import readers, writers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def formatted(df) -> str:
    import io
    from contextlib import redirect_stdout

    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_top_k_uses_window_group_limit(spark):
    text = formatted(Q.q_low_staffing(spark, SF0001))
    assert "WindowGroupLimit" in text


def test_no_python_evaluation_in_any_query(spark):
    for name, fn in Q.QUERIES.items():
        text = formatted(fn(spark, SF0001))
        assert "EvalPython" not in text and "InPandas" not in text and "InArrow" not in text, name


def test_no_job_while_a_query_is_built(spark):
    """Round trips write while they are built and the statistics store their histogram; every
    other query is a plan until it is asked for rows."""
    for name, fn in Q.QUERIES.items():
        if "roundtrip" in name or name == "profile_statistics":
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        fn(spark, SF0001)
        status = spark.sparkContext.statusTracker()
        jobs = status.getJobIdsForGroup(f"build-{name}")
        # a Parquet footer read for the schema is a one-task job of each table
        stages = [s for j in jobs for s in status.getJobInfo(j).stageIds]
        assert len(stages) == len(jobs) and all(status.getStageInfo(s).numTasks == 1 for s in stages), name
    spark.sparkContext.setJobGroup("", "")


def test_fact_scan_is_cleaned_without_a_shuffle(spark):
    text = plan(Q.q_clean_staffing(spark, SF0001))
    assert "Exchange hashpartitioning" not in text and "RepartitionByExpression" not in text


def test_histogram_is_not_shuffled_by_column_name(spark):
    text = Q.q_profile_statistics(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "Exchange hashpartitioning(column_name" in line and ", v#" not in line and ", q#" not in line:
            assert "ENSURE_REQUIREMENTS" in line  # behind a partial aggregate: a row per column and task
    assert "SortMergeJoin" not in text


def test_scan_prunes_columns_and_pushes_filters(spark):
    text = formatted(Q.q_facility_daily(spark, SF0001))
    # every scan reads only the columns the bindings use
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert scans and all("l_extendedprice" not in s and "l_tax" not in s for s in scans)


def test_gold_quarter_filter_prunes_partitions(spark, workdir):
    from staffwise.sources import fixtures as fx

    path = f"{workdir}/gold_q"
    writers.write_gold(fx.fx_quarterly(spark, SF0001), path)
    df = readers.read_gold_quarterly(spark, path, quarter="1996Q1")
    text = formatted(df)
    assert "PartitionFilters: [isnotnull(s3_calendar_quarter" in text
    assert df.count() == df.where(F.col("calendar_quarter") == "1996Q1").count() > 0


def test_staging_filter_pushed_to_scan(spark, workdir):
    from staffwise.sources import fixtures as fx

    path = f"{workdir}/gold_q"
    writers.write_gold(fx.fx_quarterly(spark, SF0001), path)
    text = formatted(marts.state_summary(marts.stg_quarterly(readers.read_gold_quarterly(spark, path))))
    assert "PushedFilters: [IsNotNull(facility_ccn), IsNotNull(state)]" in text
