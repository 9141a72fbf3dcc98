"""Writers: Silver / Gold Parquet, catalog tables, report folders.

Partitioned writes first cluster rows by the partition columns with a
``rebalance`` hint, so each task writes few partition folders and the
number of files stays near one per partition value instead of tasks x
values. Unlike ``repartition(cols)``, AQE may split a partition value that
holds a large share of the rows over several tasks (and merge small ones),
so a hot state does not end up in one task.
"""

from __future__ import annotations

from typing import Mapping, Optional, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staffwise.sources.schemas import SHADOW_PARTITIONS


def write_parquet(df: DataFrame, path: str, partition_by: Optional[Sequence[str]] = None,
                  mode: str = "overwrite", dynamic: bool = False) -> None:
    """Overwrite (static by default: the whole table is replaced) a Parquet
    table, optionally partitioned. ``dynamic=True`` replaces only the
    partitions present in ``df``."""
    w = df
    if partition_by:
        w = df.hint("rebalance", *partition_by)
    writer = w.write.mode(mode)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def _folder(spark: SparkSession, path: str):
    """A path and its file system, as Spark itself resolves them."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a staging folder, if there is one."""
    folder, system = _folder(spark, path)
    system.delete(folder, True)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put a staged folder in the place of ``target`` by renaming: no row is
    written again. The folder of before is set aside first, put
    back if the renaming fails, and deleted at the end. Without a staged folder
    (no rows were staged) the target is an empty folder.

    A reader sees the old folder, for the moment between the two renames none, then
    the new one. Not for object stores, where renaming a folder is a copy file by file."""
    new, system = _folder(spark, staged)
    old, _ = _folder(spark, target)
    aside, _ = _folder(spark, f"{target.rstrip('/')}__before-{uuid4().hex}")
    if not system.exists(new):
        system.mkdirs(new)
    system.mkdirs(old.getParent())
    had = system.exists(old)
    if had and not system.rename(old, aside):
        raise OSError(f"{target} could not be set aside.")
    if not system.rename(new, old):
        if had:
            system.rename(aside, old)
        raise OSError(f"{staged} could not take the place of {target}.")
    if had:
        system.delete(aside, True)


def write_silver(df: DataFrame, path: str, partition_by_state: bool = True, dynamic: bool = False,
                 mode: str = "overwrite") -> None:
    write_parquet(df, path, ["state"] if partition_by_state else None, mode=mode, dynamic=dynamic)


def with_shadow_partitions(df: DataFrame) -> DataFrame:
    """Copies of quarter and state used only as partition folders, so the
    data columns stay inside the files."""
    return df.withColumns({shadow: F.col(col) for col, shadow in SHADOW_PARTITIONS})


def write_gold(df: DataFrame, path: str, dynamic: bool = False) -> None:
    write_parquet(with_shadow_partitions(df), path, [s for _, s in SHADOW_PARTITIONS], dynamic=dynamic)


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Materialise as a catalog table (RAW tables and marts)."""
    df.write.mode(mode).saveAsTable(name)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back, so that later plans start from files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_view(df: DataFrame, name: str) -> None:
    """Materialise a staging model as a view."""
    df.createOrReplaceTempView(name)


def write_report(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One folder per report table (each is small; one file per table)."""
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").format(fmt).save(f"{folder.rstrip('/')}/{name}")
