"""Helpers shared by the training-data operators.

All intermediate tables go below the shared folder that the cluster names in
``spark.checkpoint.dir`` (``sifter.session.scratch_path``), written by Spark and
read back, so that a lost executor costs a re-read and never a re-computation
of random state.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.session import scratch_path

#: Text handled at once inside a task.
SLICE_BYTES = 4 << 20
#: Settings that hold while an intermediate table is written.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold for what is run inside."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store(df: DataFrame, name: str, partition_by: list[str] | None = None, batch_bytes: int = SLICE_BYTES) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and return it reread.

    What was shuffled for it goes from the executors' disks once it is written.
    Tasks in Python get rows of about ``batch_bytes`` at a time, so that neither they
    nor the JVM hold a whole split of the table as one Arrow batch.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with settings(df.sparkSession, WRITING | {BATCH_BYTES: str(batch_bytes)}):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lean(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow; what its task has freed goes back to the system.

    Spark keeps a Python worker for the next task and through stages without
    Python, and with it all that its allocators hold.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        libc = ctypes.CDLL(None)
        if hasattr(libc, "malloc_trim"):  # glibc
            libc.malloc_trim(0)

    return task


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch so that each piece holds about ``limit`` bytes of text."""
    if batch.num_rows == 0:
        return
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    piece = np.cumsum(lengths, dtype=np.int64) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(lo, hi - lo)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch; null counts as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def utf8_of(values: pa.Array) -> list[bytes]:
    """Strings without line ends, as UTF-8; many times faster than ``to_pylist``."""
    if not len(values):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
    return pc.binary_join(whole, "\n")[0].as_buffer().to_pybytes().split(b"\n")


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``values[s:s+n]`` for every (s, n)."""
    total = int(lengths.sum())
    if total == 0:
        return values[:0]
    ends = np.cumsum(lengths)
    index = np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
    return values[index]


def who(doc_id: str = "doc_id") -> Column:
    """doc_id as a join key that null can match."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _keyed(docs: DataFrame, keys: dict[str, Column], rows: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """``docs`` with key columns whose names it lacks, the distinct keys of ``rows`` under these names, and the names."""
    names = {k: free_name(docs, k) for k in keys}
    return (docs.withColumns({names[k]: c for k, c in keys.items()}),
            rows.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct(), list(names.values()))


def keep_rows(docs: DataFrame, keys: dict[str, Column], chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose keys are in ``chosen``, one for each key; all columns as they were.

    ``keys`` gives the internal key columns that ``chosen`` has; the window uses
    the partitioning and order of the join.
    """
    keyed, wanted, names = _keyed(docs, keys, chosen)
    found = keyed.join(wanted, names)
    place = free_name(found, "__place")
    first = F.row_number().over(Window.partitionBy(*names).orderBy(*names))
    return found.withColumn(place, first).filter(F.col(place) == 1).select(*docs.columns)


def drop_rows(docs: DataFrame, keys: dict[str, Column], found: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose keys are not in ``found``."""
    keyed, gone, names = _keyed(docs, keys, found)
    return keyed.join(gone, names, "left_anti").select(*docs.columns)
