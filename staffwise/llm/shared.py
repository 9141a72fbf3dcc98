"""Helpers shared by the operators: the shared folder, and whole texts as byte blocks.

Intermediate tables go below ``spark.checkpoint.dir`` (read from the session),
so every executor sees them and a lost executor costs no lineage. Without that
setting the checkpoint directory of the context is used, and a local session
(tests) falls back to its warehouse directory.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Text bytes that one numpy pass works on; a single longer text is a block of its own.
BLOCK_BYTES = 4 << 20

#: Bytes of input after which a task hands freed memory back to the system.
RELEASE_BYTES = 16 << 20

#: Remainder of crc32(doc_id as text) mod 4 whose rows are held out of training.
HELD_OUT_REMAINDER = 2


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder that the driver and all executors share."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a shared folder")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder (with the writer's ``options``) and read back: later steps start from files."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's as a DataFrame. They go out as Arrow data, which needs no Python workers (a daemon
    and a worker per core) on the executors; nested tuples are structs."""
    kind = StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(kind)
    arrow = to_arrow_schema(kind)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), kind)


def release_memory() -> None:
    """Hands freed memory back to the system; the allocators of Arrow and of the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, with freed memory handed back between large batches and at the end: the worker process lives on beside later stages."""

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            seen += batch.nbytes
            yield batch
            if seen >= RELEASE_BYTES:
                release_memory()
                seen = 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(freed(batches))
        release_memory()  # what ``run`` held is gone

    return task


def numbered(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """``docs`` with its columns named c0, c1, ... so that none clashes with added ones, and the columns under their own names."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), [F.col(n).alias(c) for n, c in zip(names, docs.columns)]


def in_sample(key: Column, part: float) -> Column:
    """Whether a row with this 64-bit hash is in a sample of the share ``part``, at a resolution of 2^-52."""
    return F.pmod(key, F.lit(1 << 52)) < F.lit(part * (1 << 52))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column back to back, and the n + 1 offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def row_blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes each; a longer row stands alone."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return edge[::2], edge[1::2]


def string_array(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow binary array over ``raw``; its rows lie back to back."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
    )
