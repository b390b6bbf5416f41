"""Structured Streaming ingest of the dump directory.

``readStream.format("text")`` with ``wholetext`` turns each new dump file into
one row; the file source's checkpoint log tells a stream what it has read (R23)
and ``cleanSource`` can delete or archive consumed files as the reference
does.  Each micro-batch runs ``refresh_index`` in ``foreachBatch``.  The index
keeps a ledger of the files it has consumed, published with the version that
holds their pages, so each file is indexed exactly once whatever becomes of the
stream: a batch that is run again, a lost checkpoint, or several streams into
one index.  A path counts as one file: new content needs a new name, as
``write_raw_dump`` gives it.  The reference
polls hourly and only refreshes when at least two files wait; ``run_scheduled``
counts the files not yet consumed before starting an ``availableNow`` run.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.plans import build as bx
from sifter.plans.refresh import refresh_index
from sifter.session import scratch_path
from sifter.sources import fs
from sifter.sources.dump import SKIP_MARK, parse_dump

# ---------------------------------------------------------------------------
# The reference's polling schedule.
#   refresh interval: 60 minutes;  minimum waiting files: 2
# ---------------------------------------------------------------------------
REFRESH_INTERVAL = "60 minutes"
MIN_FILES = 2
STREAM_CHECKPOINT = "_stream_checkpoint"
#: Files of a micro-batch: the driver holds the paths and splits of one batch at a time.
MAX_FILES = 25_000
#: Dump files are small: by Spark's defaults, 4 MB for opening a file, a task would read 32 of them, and up to 10,000 tasks
#: would look up the files of a batch one by one.
LISTING = {"spark.sql.files.openCostInBytes": str(64 << 10), "spark.sql.sources.ignoreDataLocality": "true",
           "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64"}


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """Settings for reading many small files, while they are planned."""
    before = {k: spark.conf.get(k, None) for k in LISTING}
    try:
        for k, v in LISTING.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def waiting_files(spark: SparkSession, raw_dir: str, root: str | None = None) -> DataFrame:
    """Paths of dump files that no published version of ``root`` has consumed (.gitkeep and hidden files ignored).

    Only file metadata is read; the listing is distributed by Spark's file source.
    """
    schema = "path string"
    if not fs.exists(spark, raw_dir):
        return spark.createDataFrame([], schema)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_dir)
             .select(F.col("_metadata.file_path").alias("path")).filter(~F.col("path").contains(SKIP_MARK)))
    return files if root is None else files.join(bx.consumed(spark, root), "path", "left_anti")


def batch_threshold(spark: SparkSession, raw_dir: str, min_files: int = MIN_FILES, root: str | None = None) -> bool:
    """True when enough files wait for a refresh."""
    with many_files(spark):
        return waiting_files(spark, raw_dir, root).limit(min_files).count() >= min_files


def dump_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = MAX_FILES,
                clean_source: str | None = None) -> DataFrame:
    """The waiting files, oldest first, ``max_files_per_trigger`` to a micro-batch (None: all in one)."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
    raw = reader.load(raw_dir).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("mtime"),
        F.col("value").alias("content"))
    return raw.filter(~F.col("path").contains(SKIP_MARK))


def _index_batch(root: str, idf: str, buckets: int | None, mode: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pages = parse_dump(batch).select(
            "path", "url", F.col("content").alias("html"),
            F.struct(F.lit(batch_id).alias("b"), "mtime", "path").alias("seq"))
        # a refresh goes over its pages several times: the small files are opened once
        stored = scratch_path(spark, "stream-batch")
        pages.write.parquet(stored)
        # the ledger of the index decides what is new: not the batch's number, which another stream, a lost
        # checkpoint or a batch that is run again can repeat
        refresh_index(spark.read.schema(pages.schema).parquet(stored), root, idf, buckets, mode, tag=f"batch={batch_id}", source="path")
        fs.delete(spark, stored)
    return run


def stream_ingest(spark: SparkSession, raw_dir: str, root: str, checkpoint: str | None = None,
                  trigger: str = "availableNow", idf: str = "smoothed", buckets: int | None = None,
                  mode: str = "replace", clean_source: str | None = None,
                  max_files_per_trigger: int | None = MAX_FILES):
    """Watch ``raw_dir`` and publish a new index version per micro-batch of bounded size.

    ``trigger="availableNow"`` processes what is waiting and stops (the
    scheduled-run form); ``trigger="processing"`` polls every 60 minutes.
    Pages are indexed from the whole file content, as the reference parses it.
    The stream's checkpoint (its log of consumed files, R23) defaults to a
    fixed folder inside ``root`` so every run of the same index resumes it.
    """
    checkpoint = checkpoint or f"{root.rstrip('/')}/{STREAM_CHECKPOINT}"
    writer = (dump_stream(spark, raw_dir, max_files_per_trigger, clean_source).writeStream
              .foreachBatch(_index_batch(root, idf, buckets, mode))
              .option("checkpointLocation", checkpoint))
    if trigger == "availableNow":
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=REFRESH_INTERVAL)
    with many_files(spark):  # the query's own session starts with them
        query = writer.start()
        if trigger == "availableNow":
            query.awaitTermination()
    return query


def run_scheduled(spark: SparkSession, raw_dir: str, root: str, checkpoint: str | None = None,
                  min_files: int = MIN_FILES, **kwargs) -> bool:
    """One scheduled refresh: skip unless ``min_files`` wait (R57), else ingest all."""
    if not batch_threshold(spark, raw_dir, min_files, root):
        return False
    stream_ingest(spark, raw_dir, root, checkpoint, trigger="availableNow", **kwargs)
    return True
