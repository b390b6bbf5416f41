"""Exact dedup by an extendible-hash index on shared files (operator 4).

1. Equal texts of a task's input collapse into one entry (key, text, largest
   doc_id, rows), so a text that fills a third of the corpus reaches its owner
   as a few rows.
2. The directory starts as one bucket for all keys.  While a bucket holds more
   bytes than its capacity it splits by the next bit of the key, and when its
   depth exceeds the directory's the directory doubles.  This works on sums of
   bytes per cell of the finest directory allowed, at most ``2**MAX_DEPTH``
   rows, in which a key counts once; a bucket that is still overfull there stays
   one long bucket.
3. Buckets are key ranges.  An owner task reads its ranges in key order,
   chains the entries that share a key and compares their bytes, and writes the
   index leaves to the shared folder, in files of a good size: one per distinct
   text with keep_id and group size.
4. Every document looks its leaf up by key and digest.

Texts are equal when identical after lower-casing A-Z only.  Defined results:
null counts as empty, and all null or empty texts are one group; of equal
texts the row with the largest doc_id stays; a null doc_id is smaller than any
other; of rows repeated with the same doc_id and text one stays; an empty table
gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.common import keep_rows, lean, slices, store, who

#: Bits of the finest directory.
MAX_DEPTH = 16
#: Bytes of text after which a bucket splits.
BUCKET_BYTES = 8 << 20
#: Bytes of distinct texts that a task collapses at a time.
COMBINE_BYTES = 24 << 20
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LEAF = "bucket int, key long, chain int, text_sha256 string, keep_id {kind}, group_size long"


def normalised(text: str = "text"):
    """Text with A-Z lower-cased; null as empty."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _UPPER.lower())


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id with the key and digest of its normalised text."""
    return docs.select("doc_id", F.xxhash64(normalised()).alias("key"), F.sha2(normalised(), 256).alias("text_sha256"))


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, key and normalised text."""
    return docs.select("doc_id", F.xxhash64(normalised()).alias("key"), normalised().alias("text"))


def _larger(a, b):
    return b if a is None else a if b is None or a >= b else b


def entries(docs: DataFrame) -> DataFrame:
    """Key, text, largest doc_id and number of rows of the equal texts of each task's input."""
    base = prepared(docs)
    kind = dict(base.dtypes)["doc_id"]

    def combine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_type, held, size = None, {}, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in held], pa.int64()), pa.array([t for _, t in held], pa.string()),
                 pa.array([v[0] for v in held.values()], doc_type), pa.array([v[1] for v in held.values()], pa.int64())],
                names=["key", "text", "max_id", "rows"])

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for part in slices(batch, "text"):
                rows = zip(*(part.column(c).to_pylist() for c in ("doc_id", "key", "text")), strict=True)
                for doc_id, key, text in rows:
                    seen = held.get((key, text))
                    if seen is None:
                        held[key, text] = [doc_id, 1]
                        size += len(text) + 200
                    else:
                        seen[0] = _larger(seen[0], doc_id)
                        seen[1] += 1
                if size > COMBINE_BYTES:
                    yield from slices(flush(), "text")
                    held, size = {}, 0
        if held:
            yield from slices(flush(), "text")

    return base.mapInArrow(lean(combine), f"key long, text string, max_id {kind}, rows long")


def cell(depth: int = MAX_DEPTH):
    """The first ``depth`` bits of the key."""
    return F.shiftrightunsigned("key", 64 - depth).cast("int") if depth else F.lit(0)


def split_directory(cell_bytes: dict[int, int], capacity: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH) -> tuple[np.ndarray, int, list[tuple[int, int]]]:
    """Directory (bucket of every prefix of global-depth bits), that depth, and (prefix, depth) of the buckets."""
    sums = np.zeros(2**max_depth + 1, dtype=np.int64)
    sums[np.fromiter(cell_bytes, dtype=np.int64, count=len(cell_bytes)) + 1] = list(cell_bytes.values())
    sums = np.cumsum(sums)
    buckets, depth_of_directory = [], 0
    waiting = [(0, 0)]
    while waiting:
        prefix, depth = waiting.pop()
        width = max_depth - depth
        held = sums[(prefix + 1) << width] - sums[prefix << width]
        if held <= capacity or depth == max_depth:
            buckets.append((prefix, depth))
            continue
        depth_of_directory = max(depth_of_directory, depth + 1)  # doubles when a bucket outgrows it
        waiting += [(2 * prefix + 1, depth + 1), (2 * prefix, depth + 1)]
    directory = np.repeat(np.arange(len(buckets)), [1 << (depth_of_directory - d) for _, d in buckets])
    return directory, depth_of_directory, buckets


def build_index(entry: DataFrame, capacity: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH, texts: DataFrame | None = None) -> DataFrame:
    """Index leaves from entries, written to the shared folder; ``texts`` has the keys and texts where that is cheaper than the entries."""
    spark = entry.sparkSession
    each = (entry if texts is None else texts).groupBy("key").agg((F.max(F.octet_length("text")) + 64).alias("bytes"))
    # at most 2**max_depth rows
    sums = each.groupBy(cell(max_depth).alias("cell")).agg(F.sum("bytes").alias("bytes")).collect()
    directory, depth, buckets = split_directory({r["cell"]: r["bytes"] for r in sums}, capacity, max_depth)
    kind = dict(entry.dtypes)["max_id"]
    # a row per cell of the finest directory: at most 2**max_depth
    cells = spark.createDataFrame(pd.DataFrame({
        "cell": np.arange(2**max_depth, dtype=np.int32),
        "bucket": np.repeat(directory, 2 ** (max_depth - depth)).astype(np.int32)}))

    def own(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chain, leaves = None, [], []  # (bucket, key) in hand; its distinct texts; finished leaves

        def close() -> None:
            leaves.extend((*at, n, hashlib.sha256(text).hexdigest(), top, rows) for n, (text, top, rows) in enumerate(chain))

        def page(doc_type: pa.DataType) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.string(), doc_type, pa.int64()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*leaves, strict=True), kinds, strict=True)]
            leaves.clear()
            return pa.RecordBatch.from_arrays(columns, names=["bucket", "key", "chain", "text_sha256", "keep_id", "group_size"])

        for batch in batches:
            doc_type = batch.schema.field("max_id").type
            for part in slices(batch, "text"):
                rows = zip(*(part.column(c).to_pylist() for c in ("bucket", "key", "max_id", "rows")),
                           part.column("text").cast(pa.binary()).to_pylist(), strict=True)
                for bucket, key, top, n, text in rows:
                    if (bucket, key) != at:
                        close()
                        at, chain = (bucket, key), []
                    for link in chain:
                        if link[0] == text:  # the bytes decide, not the key
                            link[1], link[2] = _larger(link[1], top), link[2] + n
                            break
                    else:
                        chain.append([text, top, n])
                if leaves:
                    yield page(doc_type)
        close()
        if leaves:
            yield page(doc_type)

    placed = entry.withColumn("cell", cell(max_depth)).join(F.broadcast(cells), "cell").drop("cell")
    owned = placed.repartition("bucket").sortWithinPartitions("bucket", "key")  # an owner takes whole key ranges
    # leaves are small beside the texts: not a file for each owner
    return store(owned.mapInArrow(lean(own), _LEAF.format(kind=kind)).hint("rebalance"), "exact-index")


def exact_dedup(docs: DataFrame, capacity: int = BUCKET_BYTES, max_depth: int = MAX_DEPTH) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row."""
    index = build_index(entries(docs), capacity, max_depth, prepared(docs))
    # documents of a frequent text make a skewed side, which the join splits
    found = keyed(docs).join(index.drop("bucket", "chain"), ["key", "text_sha256"])
    # dealt by digest and doc_id, not by the join's keys, so that a frequent text stays spread
    same_row = Window.partitionBy("text_sha256", "doc_id").orderBy("doc_id")
    first = F.row_number().over(same_row) == 1
    return found.select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & first).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents' columns of the one row that stays of equal texts."""
    index = build_index(entries(docs), texts=prepared(docs))
    keys = {"__key": F.xxhash64(normalised()), "__sha": F.sha2(normalised(), 256), "__who": who()}
    return keep_rows(docs, keys, index.select(F.col("key").alias("__key"), F.col("text_sha256").alias("__sha"), who("keep_id").alias("__who")))
