"""Readers: Bronze CSV, Silver / Gold Parquet, catalog tables, landing list.

Bronze files are read as all-string CSV (no schema inference, which would
need an extra pass over the data). Silver and Gold are read with explicit
schemas, so partition folders are never type-inferred.
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffwise.sources import schemas

# The charset of the CMS extracts, and the cp1252 characters
# of the 27 assigned code points 0x80..0x9F (ISO-8859-1 decodes them as C1
# control characters).
BRONZE_CHARSET = "ISO-8859-1"
C1_CODE_POINTS = [
    0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E,
    0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F,
]
CP1252_FROM = "".join(chr(c) for c in C1_CODE_POINTS)
CP1252_TO = bytes(C1_CODE_POINTS).decode("cp1252")

# File names of the daily staffing file and the four supporting CMS extracts.
STAFFING_FILE = "PBJ_Daily_Nurse_Staffing_Q2_2024.csv"
PROVIDER_FILE = "NH_ProviderInfo_Oct2024.csv"
CLAIMS_FILE = "NH_QualityMsr_Claims_Oct2024.csv"
VBP_FILE = "FY_2024_SNF_VBP_Facility_Performance.csv"
CITATIONS_FILE = "NH_HealthCitations_Oct2024.csv"


def read_bronze_csv(spark: SparkSession, path: str, charset: str = BRONZE_CHARSET) -> DataFrame:
    """Header CSV, every column a string. Quoted and unquoted blanks are
    NULL; surrounding spaces are kept."""
    return spark.read.option("header", True).option("encoding", charset).csv(path)


def read_bronze_cp1252(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV written in Windows-1252, as pandas reads it: a doubled quote
    inside a quoted field is one quote, and a quoted field may hold line
    breaks. The bytes are read as ISO-8859-1 (the same outside 0x80..0x9F) and
    the C1 code points mapped to their cp1252 characters.

    Where a record may start can only be told from the start of its file, so a
    file is one task. ``multi_line=False`` splits files, for
    extracts known to have no line break inside a field.
    """
    reader = spark.read.option("header", True).option("encoding", BRONZE_CHARSET).option("escape", '"')
    raw = reader.option("multiLine", multi_line).csv(path)
    names = [c.translate(str.maketrans(CP1252_FROM, CP1252_TO)) for c in raw.columns]
    return raw.select(
        *[F.translate(raw[f"`{c}`"], CP1252_FROM, CP1252_TO).alias(name) for c, name in zip(raw.columns, names)]
    )


def bronze_file(folder: str, file_name: str) -> str:
    """Folder + file name, with the folder's trailing slashes removed."""
    return folder.rstrip("/") + "/" + file_name


def read_supporting(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "provider": read_bronze_csv(spark, bronze_file(folder, PROVIDER_FILE)),
        "claims": read_bronze_csv(spark, bronze_file(folder, CLAIMS_FILE)),
        "vbp": read_bronze_csv(spark, bronze_file(folder, VBP_FILE)),
        "citations": read_bronze_csv(spark, bronze_file(folder, CITATIONS_FILE)),
    }


def _read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_silver_staffing(spark: SparkSession, path: str) -> DataFrame:
    """Silver staffing is partitioned by ``state``: it comes back last, and
    an empty state is read as NULL."""
    schema = schemas.with_partitions(schemas.without(schemas.SILVER_DAILY_STAFFING, ["state"]), ["state"])
    return _read_parquet(spark, path, schema)


def read_silver_facility(spark: SparkSession, path: str) -> DataFrame:
    return _read_parquet(spark, path, schemas.SILVER_FACILITY)


def read_silver_quality(spark: SparkSession, path: str) -> DataFrame:
    schema = schemas.with_partitions(schemas.without(schemas.SILVER_QUALITY_MEASURES, ["state"]), ["state"])
    return _read_parquet(spark, path, schema)


def read_silver_citations(spark: SparkSession, path: str) -> DataFrame:
    schema = schemas.with_partitions(schemas.without(schemas.SILVER_HEALTH_CITATIONS, ["state"]), ["state"])
    return _read_parquet(spark, path, schema)


GOLD_SHADOWS = [s for _, s in schemas.SHADOW_PARTITIONS]


def read_gold(spark: SparkSession, path: str, schema: T.StructType, quarter: Optional[str] = None) -> DataFrame:
    """Gold table with its two shadow partition columns. A quarter filter is
    put on the data column AND its shadow copy, so the scan prunes
    partition folders."""
    df = _read_parquet(spark, path, schemas.with_partitions(schema, GOLD_SHADOWS))
    if quarter is not None:
        df = df.where((F.col("s3_calendar_quarter") == quarter) & (F.col("calendar_quarter") == quarter))
    return df


def read_gold_daily(spark, path, quarter=None):
    return read_gold(spark, path, schemas.GOLD_DAILY, quarter)


def read_gold_quarterly(spark, path, quarter=None):
    return read_gold(spark, path, schemas.GOLD_QUARTERLY, quarter)


def read_gold_staffing_quality(spark, path, quarter=None):
    return read_gold(spark, path, schemas.GOLD_STAFFING_QUALITY, quarter)


# ----------------------------------------------------------- catalog side

# Logical source names of the warehouse RAW tables -> catalog table names.
SOURCE_TABLES = {
    "FACILITY_DAILY_STAFFING": "raw_facility_daily_staffing",
    "FACILITY_QUARTERLY_SUMMARY": "raw_facility_quarterly_summary",
    "STAFFING_QUALITY_ANALYSIS": "raw_staffing_quality_analysis",
}
MARTS = {
    "state_summary": "mart_state_staffing_summary",
    "low_staffing": "mart_low_staffing_facilities",
    "staffing_quality": "mart_staffing_quality",
}


def source_table(logical_name: str, database: Optional[str] = None) -> str:
    """Catalog name of a declared RAW source table."""
    table = SOURCE_TABLES[logical_name]
    return f"{database}.{table}" if database else table


def source(spark: SparkSession, logical_name: str, database: Optional[str] = None) -> DataFrame:
    """Declared RAW source table by its logical name."""
    from staffwise.operators.checks import require_table

    return require_table(spark, source_table(logical_name, database))


def load_mart(spark: SparkSession, key: str, cache: bool = False) -> DataFrame:
    """Whole mart by page key, with lower-case column names. ``cache=True``
    caches the table once in the session, however often it is loaded;
    ``release_mart`` frees it."""
    from staffwise.operators.checks import require_table

    name = MARTS.get(key, key)
    df = require_table(spark, name)
    if cache and not spark.catalog.isCached(name):
        spark.catalog.cacheTable(name)
    return df.toDF(*[c.lower() for c in df.columns])


def release_mart(spark: SparkSession, key: str) -> None:
    """Free a mart that ``load_mart(cache=True)`` cached."""
    spark.catalog.uncacheTable(MARTS.get(key, key))


# ----------------------------------------------------------------- landing


def landing_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Files directly inside ``folder`` (not in sub-folders), by name, with
    name, type (extension) and size. File contents are never read: only
    the ``binaryFile`` source's metadata columns are selected."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length", "modificationTime")
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return files.select(
        name.alias("file_name"),
        F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("file_type"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
    ).orderBy("file_name")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables: ``spark.checkpoint.dir``,
    else the context's checkpoint folder, else the warehouse folder."""
    base = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.sql.warehouse.dir", None)
    )
    if not base:
        raise RuntimeError("no shared folder: set spark.checkpoint.dir or spark.sql.warehouse.dir")
    return base.rstrip("/")
