"""Jobs: operators chained with I/O, in the order the layers depend on.

* ``landing.land_folder``         plain CSV files -> Bronze
* ``staffing_bronze_to_silver``   raw daily staffing CSV -> Silver (JOB1)
* ``supporting_bronze_to_silver`` provider / measures / citations (JOB2)
* ``silver_to_gold``              daily, quarterly, staffing x quality (JOB3)
* ``gold_to_marts``               Gold -> RAW tables -> tests -> staging -> marts (JOB4)
* ``run_all``                     everything, stopping at the first failure (JOB5)

Each Gold table is written and then read back for the next step, so later
steps start from files instead of recomputing (and re-shuffling) the whole
lineage, and a lost executor only costs the step that was running.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Optional
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffwise.operators import checks, gold, marts, silver
from staffwise.sources import landing, readers, schemas, writers
from staffwise.sources.schemas import SHADOW_PARTITIONS

STAFFING_KEYS = ["facility_ccn", "work_date"]


@dataclass
class JobResult:
    name: str
    outputs: dict = field(default_factory=dict)
    metrics: dict = field(default_factory=dict)


def _silver(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}/"


# ------------------------------------------------------------------- JOB1


def stage_staffing(spark: SparkSession, bronze_path: str, stage_path: str) -> tuple[int, int]:
    """The one pass over the staffing CSV: valid rows in full, by state, and of rejected rows the
    keys, in two folders by ``staged_valid``. Returns (cleaned rows, valid rows), counted on the way."""
    staffing = silver.clean_staffing(readers.read_bronze_csv(spark, bronze_path))
    valid = F.coalesce(silver.is_valid_staffing_row(), F.lit(False))
    kept = [F.col(c) if c in STAFFING_KEYS else F.when(valid, F.col(c)).alias(c) for c in staffing.columns]
    seen = Observation("staged")
    rows = staffing.observe(seen, F.count(F.lit(1)).alias("cleaned"), F.count_if(valid).alias("valid"))
    writers.write_parquet(rows.select(*kept, valid.alias("staged_valid")), stage_path, ["staged_valid", "state"])
    return seen.get["cleaned"], seen.get["valid"]


def staffing_bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str) -> JobResult:
    """Clean the daily staffing file, fail on duplicate facility-days, keep
    valid rows, write Silver partitioned by state.

    Stage, verify, publish: the CSV is parsed once, into a staging folder beside Silver. The guard
    reads the two key columns of the staged files, those of rejected rows
    included. Only then the valid rows take Silver's place, by renaming; a failure
    before leaves the Silver of the last run as it was and removes the staging folder.
    """
    stage = f"{silver_path.rstrip('/')}__stage-{uuid4().hex}"
    try:
        cleaned, written = stage_staffing(spark, bronze_path, stage)
        keys = T.StructType([f for f in schemas.SILVER_DAILY_STAFFING.fields if f.name in STAFFING_KEYS])
        checks.assert_unique(spark.read.schema(keys).parquet(stage), STAFFING_KEYS, "facility-day")
        writers.publish(spark, f"{stage}/staged_valid=true", silver_path)
    finally:
        writers.remove_folder(spark, stage)
    return JobResult(
        "staffing_bronze_to_silver",
        {"silver_daily_staffing": silver_path},
        {"cleaned_rows": cleaned, "written_rows": written, "rejected_rows": cleaned - written},
    )


# ------------------------------------------------------------------- JOB2


def supporting_bronze_to_silver(spark: SparkSession, bronze_folder: str, silver_folder: str) -> JobResult:
    """Provider -> Silver facility (unpartitioned); claims + VBP measures ->
    Silver quality measures and citations -> Silver citations (by state)."""
    src = readers.read_supporting(spark, bronze_folder)
    out = {
        "silver_facility": _silver(silver_folder, "silver_facility"),
        "silver_quality_measures": _silver(silver_folder, "silver_quality_measures"),
        "silver_health_citations": _silver(silver_folder, "silver_health_citations"),
    }
    writers.write_silver(silver.clean_facility(src["provider"]), out["silver_facility"], partition_by_state=False)
    writers.write_silver(silver.quality_measures(src["claims"], src["vbp"]), out["silver_quality_measures"])
    writers.write_silver(silver.clean_citations(src["citations"]), out["silver_health_citations"])
    return JobResult("supporting_bronze_to_silver", out)


# ------------------------------------------------------------------- JOB3

GOLD_DAILY = "gold_facility_daily_staffing"
GOLD_QUARTERLY = "gold_facility_quarterly_summary"
GOLD_STAFFING_QUALITY = "gold_staffing_quality_analysis"


def _data_columns(df: DataFrame) -> DataFrame:
    shadows = {s for _, s in SHADOW_PARTITIONS}
    return df.select(*[c for c in df.columns if c not in shadows])


def silver_to_gold(spark: SparkSession, silver_folder: str, gold_folder: str) -> JobResult:
    staffing = readers.read_silver_staffing(spark, _silver(silver_folder, "silver_daily_staffing"))
    facility = readers.read_silver_facility(spark, _silver(silver_folder, "silver_facility"))
    quality = readers.read_silver_quality(spark, _silver(silver_folder, "silver_quality_measures"))
    g = gold_folder.rstrip("/")
    paths = {name: f"{g}/{name}/" for name in (GOLD_DAILY, GOLD_QUARTERLY, GOLD_STAFFING_QUALITY)}

    daily = gold.facility_daily(staffing, facility)
    writers.write_gold(daily, paths[GOLD_DAILY])
    daily_back = _data_columns(readers.read_gold_daily(spark, paths[GOLD_DAILY]))

    quarterly = gold.facility_quarterly(daily_back)
    writers.write_gold(quarterly, paths[GOLD_QUARTERLY])
    quarterly_back = _data_columns(readers.read_gold_quarterly(spark, paths[GOLD_QUARTERLY]))

    writers.write_gold(gold.staffing_quality(quarterly_back, quality), paths[GOLD_STAFFING_QUALITY])
    return JobResult("silver_to_gold", paths)


# ------------------------------------------------------------------- JOB4

# Logical source name -> (Gold table folder, reader).
SOURCES = {
    "FACILITY_DAILY_STAFFING": (GOLD_DAILY, readers.read_gold_daily),
    "FACILITY_QUARTERLY_SUMMARY": (GOLD_QUARTERLY, readers.read_gold_quarterly),
    "STAFFING_QUALITY_ANALYSIS": (GOLD_STAFFING_QUALITY, readers.read_gold_staffing_quality),
}


def load_sources(spark: SparkSession, gold_folder: str, database: Optional[str] = None) -> dict[str, str]:
    """Gold folders -> the declared RAW tables of the catalog: {logical name: table}."""
    g = gold_folder.rstrip("/")
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = {}
    for name, (folder, reader) in SOURCES.items():
        out[name] = readers.source_table(name, database)
        writers.save_table(_data_columns(reader(spark, f"{g}/{folder}/")), out[name])
    return out


def gold_to_marts(spark: SparkSession, gold_folder: str, mart_folder: Optional[str] = None,
                  save_tables: bool = True, database: Optional[str] = None) -> JobResult:
    """RAW tables -> source tests -> staging views -> model tests -> marts ->
    mart tests, each step only after the tests of its inputs passed. Marts are
    catalog tables (by default) and/or Parquet folders."""
    if not (save_tables or mart_folder):
        raise ValueError("no place for the marts: give mart_folder or leave save_tables on")
    load_sources(spark, gold_folder, database)
    raw = {name: readers.source(spark, name, database) for name in SOURCES}
    results = []

    def test(tests):
        rows = checks.not_null_results(tests).collect()  # one row per tested column
        checks.raise_failed(rows)
        results.extend(rows)

    test({name: (df, ["facility_ccn"]) for name, df in raw.items()})
    stg = {
        "stg_facility_daily_staffing": marts.stg_daily(raw["FACILITY_DAILY_STAFFING"]),
        "stg_facility_quarterly_summary": marts.stg_quarterly(raw["FACILITY_QUARTERLY_SUMMARY"]),
        "stg_staffing_quality_analysis": marts.stg_quality(raw["STAFFING_QUALITY_ANALYSIS"]),
    }
    for name, df in stg.items():
        writers.create_view(df, name)
    test(
        {
            "stg_facility_daily_staffing": (stg["stg_facility_daily_staffing"], ["facility_ccn", "work_date"]),
            "stg_facility_quarterly_summary": (stg["stg_facility_quarterly_summary"], ["facility_ccn"]),
            "stg_staffing_quality_analysis": (stg["stg_staffing_quality_analysis"], ["facility_ccn"]),
        }
    )
    built = {
        "mart_state_staffing_summary": marts.state_summary(stg["stg_facility_quarterly_summary"]),
        "mart_low_staffing_facilities": marts.low_staffing(stg["stg_facility_quarterly_summary"]),
        "mart_staffing_quality": marts.readmission_quality(stg["stg_staffing_quality_analysis"]),
    }
    out = {}
    for name, df in built.items():
        if mart_folder:
            out[name] = f"{mart_folder.rstrip('/')}/{name}/"
            writers.write_parquet(df, out[name])
            df = spark.read.schema(df.schema).parquet(out[name])
        if save_tables:
            table = f"{database}.{name}" if database else name
            writers.save_table(df, table)
            out.setdefault(name, table)
    reread = {name: (spark.read.parquet(at) if mart_folder else spark.table(at)) for name, at in out.items()}
    test(
        {
            "mart_state_staffing_summary": (reread["mart_state_staffing_summary"], ["state"]),
            "mart_low_staffing_facilities": (reread["mart_low_staffing_facilities"], ["facility_ccn"]),
            "mart_staffing_quality": (reread["mart_staffing_quality"], ["facility_ccn"]),
        }
    )
    return JobResult("gold_to_marts", out, {"tests": [r.asDict() for r in results]})


# ------------------------------------------------------------------- JOB5


def run_all(spark: SparkSession, landing_folder: str, bronze_folder: str, silver_folder: str, gold_folder: str,
            mart_folder: Optional[str] = None, database: Optional[str] = None) -> list[JobResult]:
    """Whole run in dependency order: landing, then both Silver jobs side by
    side, then Gold, then the marts. The first failing job raises and the
    later ones do not start."""
    landed = landing.land_folder(spark, landing_folder, bronze_folder)
    staffing = readers.bronze_file(bronze_folder, readers.STAFFING_FILE)
    with ThreadPoolExecutor(2) as both:
        silver_jobs = [
            both.submit(staffing_bronze_to_silver, spark, staffing, _silver(silver_folder, "silver_daily_staffing")),
            both.submit(supporting_bronze_to_silver, spark, bronze_folder, silver_folder),
        ]
        done = [job.result() for job in silver_jobs]
    done.append(silver_to_gold(spark, silver_folder, gold_folder))
    done.append(gold_to_marts(spark, gold_folder, mart_folder, database=database))
    return [JobResult("landing", {path.rsplit("/", 1)[-1]: path for path in landed}), *done]


# -------------------------------------------------------------- profiling


def profile_file(spark: SparkSession, csv_path: str, report_folder: Optional[str] = None,
                 dataset_name: Optional[str] = None, method: str = "exact") -> dict:
    """Profile a raw CSV file (Windows-1252) into the six report tables;
    write them as one folder each when ``report_folder`` is given.

    The report tables are small (one row per column or per metric, 20
    sample rows); the data itself is read by Spark and never collected.
    """
    from staffwise.operators import profiling

    raw = readers.read_bronze_cp1252(spark, csv_path)
    name = dataset_name or csv_path.rstrip("/").split("/")[-1]
    size = profiling.input_size_bytes(spark, csv_path)
    # the two passes over the data, stored once for the six tables
    hist, duplicates = (
        writers.stored(df, f"{readers.shared_dir(spark)}/profile-{uuid4().hex}") for df in profiling.report_inputs(raw)
    )
    tables = {
        "overview": profiling.profile_overview(raw, name, size, hist, duplicates),
        "data_dictionary": profiling.profile_dictionary(raw, hist),
        "missing_values": profiling.profile_missing(raw, hist),
        "summary_statistics": profiling.profile_statistics(raw, method, hist=hist),
        "data_quality": profiling.profile_quality(raw, hist, duplicates),
        "sample_data": profiling.profile_sample(raw),
    }
    if report_folder:
        writers.write_report(tables, report_folder)
    return tables
