"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.session import settle

Arrow = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
SLICE_BYTES = 4 << 20
try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # another system's C library has no such call
    _libc = None


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a whole table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of about ``SLICE_BYTES``: Spark's have a number of rows, whatever their size."""
    for batch in batches:
        rows = max(1, SLICE_BYTES * batch.num_rows // max(batch.nbytes, 1))
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def give_back() -> None:
    """Returns free memory to the system. Python workers serve one task after another and would keep what the largest took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def tidied(run: Arrow, *forget: Callable[[], None]) -> Arrow:
    """For ``mapInArrow``: batches in slices, and a task's memory given back when it ends; ``forget`` drops what modules keep."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(in_slices(batches))
        finally:
            for drop in forget:
                drop()
            give_back()
    return whole


def per_batch(fn: Callable[[pa.RecordBatch], dict]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: one dictionary of columns out for each batch in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(fn(batch))
    return run


def without_nulls(column: str, name: str | None = None):
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit("")).alias(name or column)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared work folder and read back; shuffle files that nothing refers to any more are freed."""
    kept = settle(df)
    df.sparkSession.sparkContext._jvm.System.gc()  # Spark's cleaner follows the driver's garbage collection
    return kept
