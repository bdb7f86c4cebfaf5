"""Helpers of the corpus operators: names, checked broadcasts, slices of text for Python tasks."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import fleetlens
from fleetlens.session import configure

#: Rows up to which the driver lets a side be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 100_000
#: Stands for a null id inside numpy arrays.
NULL_ID = -(1 << 63)
#: Bytes of text that a Python task works on at once.
SLICE_BYTES = 1 << 21
#: Rows and bytes that travel to and from Python at once: of one operator, and of several in one session (lean).
BATCH, LEAN_BATCH = (2000, 32 << 20), (1024, 4 << 20)
#: Python workers of a lean session give freed memory back instead of keeping it for their next task.
LEAN_WORKERS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(2 << 20)}


def prepare(spark: SparkSession, lean: bool = False) -> SparkSession:
    """Session settings of these operators; executors started elsewhere find the package.

    ``lean`` is for several operators one after the other, whose leftovers in
    executors and Python workers would add up: smaller batches, and memory that
    workers give back.  Results are the same; what the session's environment
    says of allocators already holds.
    """
    configure(spark)
    rows, size = LEAN_BATCH if lean else BATCH
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    # a union that keeps its sides' partitioning fails where adaptive execution has merged partitions of one side only
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    root = os.path.dirname(os.path.dirname(os.path.abspath(fleetlens.__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if lean:
        spark.sparkContext.environment.update({k: v for k, v in LEAN_WORKERS.items() if k not in spark.sparkContext.environment})
    return spark


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names like ``names`` that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` long and ``text`` without nulls, whatever other columns there are."""
    return docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))


def held_out(id_col: str | Column = "doc_id") -> Column:
    """True for the fifth of the documents that models never learn from."""
    value = col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(value.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def few(df: DataFrame, limit: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """``df`` marked for broadcast if it holds at most ``limit`` rows, or ``weight`` in sum."""
    if weight is None:
        return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
    return F.broadcast(df) if (df.agg(F.sum(weight)).first()[0] or 0) <= limit else df


def buckets_for(docs: DataFrame, text_col: str = "text", bytes_each: int = 16 << 20) -> int:
    """How many groups keep each near ``bytes_each`` bytes of text; grows with the table."""
    total = docs.agg(F.sum(F.octet_length(col(text_col).cast("string")))).first()[0] or 0
    return max(16, -(-total // bytes_each))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text or binary column and where each row starts; a null text counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column) or places is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(ids, bytes, starts)`` of whole rows, about ``limit`` bytes each; a longer row comes alone."""
    for batch in batches:
        ids = np.asarray(batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False), np.int64)
        raw, at = buffers(batch.column(1))
        first = 0
        while first < len(ids):
            last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
            last = min(last, len(ids))
            yield ids[first:last], raw[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def ids_column(ids: np.ndarray) -> pa.Array:
    """Ids as a column, null where they came as null."""
    return pa.array(ids, pa.int64(), mask=ids == NULL_ID)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a public finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
