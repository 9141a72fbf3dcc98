"""Data-quality checks: not-null tests, unique-key guard, empty guards.

Each check is one aggregation job whose result is a small DataFrame; the
raising guards collect only that single aggregated row.
"""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class DataCheckError(ValueError):
    """A data test failed."""


class TableNotFoundError(LookupError):
    """A mart or table asked for by name does not exist."""


def null_counts(df: DataFrame, tests: Sequence[tuple]) -> DataFrame:
    """(table_name, column_name, failing_rows, passed) of all the tests on one
    lineage from a single aggregation. A test is (table name, column) or (table
    name, column, condition): the table then has the rows of ``df`` that meet it."""
    checked = [(t[0], t[1], t[2] if len(t) > 2 and t[2] is not None else F.lit(True)) for t in tests]
    counts = df.agg(*[F.count_if(F.col(c).isNull() & rows).alias(f"c{i}") for i, (_, c, rows) in enumerate(checked)])
    found = [
        F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"c{i}").alias("failing_rows"))
        for i, (t, c, _) in enumerate(checked)
    ]
    return counts.select(F.inline(F.array(*found))).withColumn("passed", F.col("failing_rows") == 0)


def not_null_results(tests: Mapping[str, tuple]) -> DataFrame:
    """The not-null tests of several tables: {name: (df, columns)} or {name:
    (df, columns, condition)}. Tables given by the same ``df`` share one pass."""
    lineages: dict[int, tuple[DataFrame, list]] = {}
    for name, (df, columns, *condition) in tests.items():
        lineages.setdefault(id(df), (df, []))[1].extend((name, c, *condition) for c in columns)
    return reduce(DataFrame.unionByName, [null_counts(df, own) for df, own in lineages.values()])


def raise_failed(rows) -> None:
    """Raise when any collected test row failed."""
    failed = [r for r in rows if not r.passed]
    if failed:
        desc = ", ".join(f"{r.table_name}.{r.column_name}={r.failing_rows}" for r in failed)
        raise DataCheckError(f"not_null tests failed: {desc}")


def assert_passed(results: DataFrame) -> None:
    """Raise when any test row failed (collects only failing rows, at most
    one per tested column)."""
    raise_failed(results.where(~F.col("passed")).collect())


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: number of key values that occur more than once.

    Group + count has partial aggregation, so a key holding a third of the
    rows is pre-counted per task. NULL keys group together.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .agg(F.count(F.lit(1)).alias("duplicate_keys"))
    )


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "facility-day") -> None:
    """Fail with the number of duplicate keys (one aggregated row)."""
    n = duplicate_key_count(df, keys).first()["duplicate_keys"]
    if n:
        raise DataCheckError(f"{what} keys are not unique: {n} of them occur more than once.")


def assert_not_empty(df: DataFrame, what: str) -> None:
    """Empty-input guard (reads at most one row)."""
    if df.isEmpty():
        raise DataCheckError(f"No rows found in {what}.")


def require_table(spark: SparkSession, name: str) -> DataFrame:
    """Table by name, with a readable error instead of an analysis error."""
    if not spark.catalog.tableExists(name):
        raise TableNotFoundError(f"Table {name!r} could not be loaded; check that it was built.")
    return spark.table(name)

