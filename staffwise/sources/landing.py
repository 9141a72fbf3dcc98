"""Landing of source files into Bronze, byte for byte.

The source files arrive in a folder. ``land_folder`` lists the files
directly in it (SRC8), fails when there are none, and copies each one
unchanged to ``prefix/<base name>`` (or one explicit key) below the Bronze
folder, whatever its type.

All files land in one Spark job. A file is cut into byte ranges, one row each
(paths, offset, length; never the bytes), and a Python Data Source writes
them: every task copies its ranges in small pieces from the source into a
staged file at the same offset, so a file larger than one task is copied by
many, and a repeated or speculative task writes the same bytes to the same
place. Only when all tasks are done and every staged file has its full length
are the files moved to their keys; a failed job removes what it staged and
leaves the files landed before as they were.

Local and mounted folders (``file:``) take ranges. Other file systems, reached
through ``pyarrow.fs``, cannot write into the middle of a file: there a file
is one range and is streamed, in the same small pieces, by one task.
"""

from __future__ import annotations

import os
from typing import Iterator, Optional
from uuid import uuid4

from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, WriterCommitMessage

from staffwise.functions import bronze_key
from staffwise.operators.checks import DataCheckError
from staffwise.sources.readers import landing_inventory

RANGE_BYTES = 64 << 20  # bytes per row and, for large files, per task
PIECE_BYTES = 1 << 20  # bytes a task holds at a time
MAX_TASKS = 10_000
LANDING_FORMAT = "staffwise_landing"
LISTING_SCHEMA = "file_name string, source string, file_size long"
RANGE_SCHEMA = "source string, target string, file_size long, start long, bytes long"


# ------------------------------------------------------------ file systems


def local_path(path: str) -> Optional[str]:
    """The path of a local or mounted file, None for any other file system."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    return None if "://" in path or path.startswith("hdfs:") else path


def _remote(path: str):
    return arrow_fs.FileSystem.from_uri(path)


def _open_at(path: str, start: int):
    local = local_path(path)
    if local is not None:
        stream = open(local, "rb")
        stream.seek(start)
        return stream
    system, name = _remote(path)
    return system.open_input_stream(name)  # ranges of remote files start at 0


def _size(path: str) -> int:
    """Length of a file, -1 when there is none."""
    local = local_path(path)
    if local is not None:
        return os.path.getsize(local) if os.path.isfile(local) else -1
    system, name = _remote(path)
    info = system.get_file_info(name)
    return info.size if info.type == arrow_fs.FileType.File else -1


def _move(source: str, target: str) -> None:
    local = local_path(target)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        os.replace(local_path(source), local)
        return
    system, name = _remote(target)
    system.create_dir(name.rsplit("/", 1)[0], recursive=True)
    system.move(_remote(source)[1], name)


def _remove_folder(path: str) -> None:
    system, name = (arrow_fs.LocalFileSystem(), local_path(path)) if local_path(path) is not None else _remote(path)
    if system.get_file_info(name).type == arrow_fs.FileType.Directory:
        system.delete_dir(name)


def copy_range(source: str, target: str, start: int, length: int) -> int:
    """Copy ``length`` bytes from ``start`` to the same place of ``target``,
    holding ``PIECE_BYTES`` at a time. Returns the bytes copied."""
    local, left = local_path(target), length
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        out = os.fdopen(os.open(local, os.O_CREAT | os.O_WRONLY, 0o644), "wb")
        out.seek(start)
    else:
        system, name = _remote(target)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        out = system.open_output_stream(name)
    with _open_at(source, start) as data, out:
        while left:
            piece = data.read(min(left, PIECE_BYTES))
            if not piece:
                break
            out.write(piece)
            left -= len(piece)
    return length - left


# ------------------------------------------------------------- data source


class LandedFiles(WriterCommitMessage):
    """The files a task wrote ranges of: {key: full length}."""

    def __init__(self, files: dict):
        self.files = files


class LandingWriter(DataSourceWriter):
    """Copies byte ranges into a staging folder; all files move to their
    targets at the end, or none does."""

    def __init__(self, staging: str):
        self.staging = staging

    def write(self, iterator: Iterator) -> LandedFiles:
        files = {}
        for row in iterator:
            staged = f"{self.staging}/{row.target}"
            copied = copy_range(row.source, staged, row.start, row.bytes)
            if copied != row.bytes:
                raise OSError(f"{row.source} became shorter while it was landed: {copied} of {row.bytes} bytes at {row.start}.")
            files[row.target] = row.file_size
        return LandedFiles(files)

    def commit(self, messages) -> None:
        sizes = {}
        for message in messages:
            sizes.update(message.files if message is not None else {})
        root = self.staging.rsplit("/", 1)[0]
        for key, size in sorted(sizes.items()):
            found = _size(f"{self.staging}/{key}")
            if found != size:
                raise OSError(f"{key} was staged with {found} of {size} bytes; nothing was landed.")
            target = local_path(f"{root}/{key}")
            if target is not None and os.path.isdir(target):
                raise IsADirectoryError(f"{root}/{key} is a folder; nothing was landed.")
        for key in sorted(sizes):
            _move(f"{self.staging}/{key}", f"{root}/{key}")
        _remove_folder(self.staging)

    def abort(self, messages) -> None:
        _remove_folder(self.staging)


class ListingReader(DataSourceReader):
    """One row per file directly inside a folder, or for one file: empty files
    too, which Spark's own file sources leave out."""

    def __init__(self, path: str):
        self.path = path

    def read(self, partition):
        local = local_path(self.path)
        system, name = (arrow_fs.LocalFileSystem(), local) if local is not None else _remote(self.path)
        parent = self.path[: len(self.path) - len(name)] + name.rstrip("/") if local is None else "file:" + local.rstrip("/")
        info = system.get_file_info(name)
        if info.type == arrow_fs.FileType.Directory:
            inside = system.get_file_info(arrow_fs.FileSelector(name))
            files = [(f"{parent}/{f.base_name}", f) for f in inside if f.type == arrow_fs.FileType.File]
        elif info.type == arrow_fs.FileType.File:
            files = [(parent, info)]
        else:
            raise FileNotFoundError(f"{self.path} does not exist.")
        for path, f in sorted(files, key=lambda one: one[1].base_name):
            if f.base_name[0] not in "._":
                yield f.base_name, path, f.size


class LandingSource(DataSource):
    """Read: the files of a folder (``LISTING_SCHEMA``). Write, with the option
    ``staging``: the byte ranges that rows of ``RANGE_SCHEMA`` name are copied;
    targets are keys below the staging folder's parent."""

    @classmethod
    def name(cls) -> str:
        return LANDING_FORMAT

    def schema(self) -> str:
        return LISTING_SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> LandingWriter:
        return LandingWriter(self.options["staging"])


# ----------------------------------------------------------------- landing


def bronze_target(prefix: str, file_name: str) -> str:
    """prefix/base-name, computed with the same column rule as ``bronze_key``
    (outer slashes of the prefix dropped, no slash for an empty prefix)."""
    clean = prefix.strip("/")
    base = file_name.split("/")[-1]
    return f"{clean}/{base}" if clean else base


def byte_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Rows (source, target, file_size) -> one row per byte range
    (``RANGE_SCHEMA``). An empty file has one range of no bytes; a remote file is one range."""
    whole = F.col("source").rlike("^(?!file:)[A-Za-z0-9+.-]+:") | F.col("root").rlike("^(?!file:)[A-Za-z0-9+.-]+:")
    step = F.when(whole, F.greatest(F.col("file_size"), F.lit(1))).otherwise(F.lit(range_bytes)).cast("long")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("file_size") - 1, F.lit(0)), step))
    cut = files.withColumn("step", step).withColumn("start", starts)
    return cut.select("source", "target", "file_size", "start", F.least(F.col("step"), F.col("file_size") - F.col("start")).alias("bytes"))


def _qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme on the session's default file system, as Spark resolves it."""
    path = path.rstrip("/")
    if ":" in path.split("/", 1)[0]:
        return path
    return spark.conf.get("spark.hadoop.fs.defaultFS", "file://").rstrip("/") + os.path.abspath(path)


def _land(spark: SparkSession, files: DataFrame, bronze_root: str, range_bytes: int) -> None:
    """Copy the listed files (source, target, file_size) in one job."""
    root = _qualified(spark, bronze_root)
    ranges = byte_ranges(files.withColumn("root", F.lit(root)), range_bytes)
    tasks = min(ranges.count(), MAX_TASKS)
    spread = ranges.repartition(tasks)  # a few bytes a row; by number, so AQE leaves the tasks alone
    staging = f"{root}/_landing-{uuid4().hex}"
    spread.write.format(LANDING_FORMAT).option("staging", staging).mode("append").save()


def listing(spark: SparkSession, path: str) -> DataFrame:
    """Files directly inside a folder, or one file, by name: (file_name,
    source, file_size). Names starting with ``.`` or ``_``, which Spark's readers do not see, are left out."""
    spark.dataSource.register(LandingSource)
    return spark.read.format(LANDING_FORMAT).load(_qualified(spark, path))


def land_file(spark: SparkSession, source_path: str, bronze_root: str, key: str, range_bytes: int = RANGE_BYTES) -> str:
    """One file, unchanged, as ``bronze_root/key``."""
    files = listing(spark, source_path).withColumn("target", F.lit(key.strip("/")))
    _land(spark, files, bronze_root, range_bytes)
    return f"{bronze_root.rstrip('/')}/{key.strip('/')}"


def land_folder(spark: SparkSession, source_folder: str, bronze_root: str, prefix: str = "",
                key: Optional[str] = None, range_bytes: int = RANGE_BYTES) -> list[str]:
    """Land every file directly inside ``source_folder``, all in one job that
    lands each of them or none. What comes to the driver is the file list
    (a name per file), bounded by the number of files, not by their size."""
    files = listing(spark, source_folder)
    names = [r.file_name for r in files.select("file_name").collect()]
    if not names:
        raise DataCheckError(f"The landing folder {source_folder} is empty.")
    if key is not None and len(names) > 1:
        raise DataCheckError(f"One key ({key}) cannot hold {len(names)} files: each would overwrite the one before.")
    target = F.lit(key.strip("/")) if key is not None else bronze_key(prefix, F.col("file_name"))
    _land(spark, files.withColumn("target", target), bronze_root, range_bytes)
    return [f"{bronze_root.rstrip('/')}/{key.strip('/') if key is not None else bronze_target(prefix, n)}" for n in names]


def landing_keys(spark: SparkSession, source_folder: str, prefix: str):
    """The Bronze keys the files of a folder would be landed under, as a
    DataFrame (file_name, bronze_key)."""
    inv = landing_inventory(spark, source_folder)
    return inv.select("file_name", bronze_key(prefix, F.col("file_name")).alias("bronze_key"))
