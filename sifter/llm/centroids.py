"""Centroid clustering over subvector dictionaries (operator 12).

Vectors are cut into blocks of dimensions.  A chunk of vectors stores, for each
block, the dictionary of its distinct subvectors and one code per vector, which
loses nothing.  In a round a chunk computes the squared distance of every
dictionary entry to every centroid once, adds up the entries' distances by code
and so assigns its vectors; the sums for the new centroids come from counting
codes per cluster.  Only one row per cluster and chunk leaves a task.  Chunks
are stored in the shared folder before the first round, a round is one job over
them, and the centroids (a number of integers that does not grow with the data)
are the only state between rounds.

All arithmetic is in integers and exact.  Defined results: vectors with another
number of components, or with a null or non-finite one, are left out; repeated
vec_ids are separate vectors (the hash order of the first centroids then goes on
by the components), a null vec_id is hashed as empty text; with fewer vectors
than centroids there are as many centroids as vectors; an empty table gives an
empty result; other columns are ignored.  A component beyond ``LARGEST`` in size
raises an error, as its squared distances would not fit a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import store

DIMENSIONS, CLUSTERS, ROUNDS, SEED = 64, 8, 10, 3
SCALE = 1024
#: Dimensions in a block, and vectors in a chunk.
BLOCK, CHUNK = 8, 16_384
#: 64 squares of differences of such integers fit a long.
LARGEST = 1 << 17


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id and q, the integers floor(1024 * x) of every vector that counts."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    large = F.exists("x", lambda v: F.abs(v) > LARGEST)
    return (vectors.select("vec_id", x.alias("x"))
            .filter((F.size("x") == dimensions) & F.forall("x", finite))
            .select("vec_id", F.when(large, F.raise_error(F.lit(f"vector component beyond {LARGEST}")))
                    .otherwise(F.transform("x", lambda v: F.floor(v * SCALE).cast("int"))).alias("q")))


def first_centroids(points: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The k vectors with the least hashes of seed and vec_id."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(order.alias("h"), "q").orderBy("h", "q").limit(k).collect()  # k rows
    return np.array([r["q"] for r in rows], dtype=np.int64)


# -- chunks ----------------------------------------------------------------------


def encode_chunk(q: np.ndarray, block: int = BLOCK) -> tuple[list[int], bytes, bytes]:
    """Sizes of the dictionaries, their subvectors, and the codes of every block behind one another."""
    sizes, entries, codes = [], [], []
    for lo in range(0, q.shape[1], block):
        part = np.ascontiguousarray(q[:, lo:lo + block], dtype="<i4")
        whole = part.view(np.dtype((np.void, part.shape[1] * 4)))[:, 0]
        found, code = np.unique(whole, return_inverse=True)
        sizes.append(len(found))
        entries.append(found.tobytes())
        codes.append(code.astype("<u2" if len(found) <= 1 << 16 else "<u4").tobytes())
    return sizes, b"".join(entries), b"".join(codes)


class Chunk:
    """The dictionaries and codes of some vectors."""

    def __init__(self, n: int, sizes: list[int], entries: bytes, codes: bytes, dimensions: int, block: int = BLOCK):
        self.n, self.dimensions, self.blocks = n, dimensions, []
        at_entry = at_code = 0
        for lo, m in zip(range(0, dimensions, block), sizes, strict=True):
            width = min(block, dimensions - lo)
            kind = np.dtype("<u2" if m <= 1 << 16 else "<u4")
            book = np.frombuffer(entries, "<i4", m * width, at_entry).reshape(m, width).astype(np.int64)
            code = np.frombuffer(codes, kind, n, at_code)
            at_entry += m * width * 4
            at_code += n * kind.itemsize
            self.blocks.append((lo, book, code))

    def vectors(self) -> np.ndarray:
        return np.hstack([book[code] for _, book, code in self.blocks])

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (of equals the first) and squared distance of every vector."""
        total = np.zeros((self.n, len(centroids)), dtype=np.int64)
        for lo, book, code in self.blocks:
            table = np.zeros((len(book), len(centroids)), dtype=np.int64)
            for j in range(book.shape[1]):
                table += (book[:, j, None] - centroids[None, :, lo + j]) ** 2
            total += table[code]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(self.n), cluster]

    def sums(self, cluster: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors in every cluster, and the sums of their components."""
        parts = []
        for _, book, code in self.blocks:
            uses = np.bincount(cluster * len(book) + code, minlength=k * len(book)).reshape(k, len(book))
            parts.append(uses @ book)
        return np.bincount(cluster, minlength=k), np.hstack(parts)


def write_chunks(points: DataFrame, dimensions: int = DIMENSIONS, name: str = "centroid-chunks") -> DataFrame:
    """Stored chunks of dictionary-encoded vectors."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column("vec_id") for b in held])
            q = np.concatenate([np.asarray(b.column("q").flatten()) for b in held]).reshape(len(ids), dimensions)
            sizes, entries, codes = encode_chunk(q)
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([sizes], pa.list_(pa.int32())),
                 pa.array([entries], pa.binary()), pa.array([codes], pa.binary())], names=["vec_ids", "sizes", "entries", "codes"])

        count = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, CHUNK):
                part = batch.slice(lo, CHUNK)
                if count + part.num_rows > CHUNK and held:
                    yield chunk()
                    held, count = [], 0
                held.append(part)
                count += part.num_rows
        if count:
            yield chunk()

    kind = dict(points.dtypes)["vec_id"]
    return store(points.mapInArrow(encode, f"vec_ids array<{kind}>, sizes array<int>, entries binary, codes binary"), name)


def _chunks(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[pa.Array, Chunk]]:
    ids = batch.column("vec_ids")
    for i in range(batch.num_rows):
        one = ids[i].values
        yield one, Chunk(len(one), *(batch.column(c)[i].as_py() for c in ("sizes", "entries", "codes")), dimensions)


# -- rounds ----------------------------------------------------------------------


def next_centroids(chunks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: assign all vectors, then floor of the mean of every cluster that has any."""
    k, dimensions = centroids.shape

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, chunk in _chunks(batch, dimensions):
                n, sums = chunk.sums(chunk.assign(centroids)[0], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(k), pa.int32()), pa.array(n, pa.int64()), pa.array(list(sums), pa.list_(pa.int64()))],
                    names=["cluster", "n", "sums"])

    found = chunks.select("vec_ids", "sizes", "entries", "codes").mapInArrow(partial, "cluster int, n long, sums array<long>")
    rows = (found.groupBy("cluster")
            .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dimensions)]).alias("sums"))
            .collect())  # one row per cluster
    moved = centroids.copy()
    for row in rows:
        if row["n"]:
            moved[row["cluster"]] = [int(s) // int(row["n"]) for s in row["sums"]]
    return moved


def assignments(chunks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance of every vector."""
    dimensions = centroids.shape[1]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, chunk in _chunks(batch, dimensions):
                cluster, distance = chunk.assign(centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    kind = dict(chunks.dtypes)["vec_ids"][len("array<"):-1]
    return chunks.select("vec_ids", "sizes", "entries", "codes").mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED,
                    dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that counts."""
    spark = vectors.sparkSession
    points = quantised(vectors, dimensions)
    chunks = write_chunks(points, dimensions)
    centroids = first_centroids(points, k, seed)
    if not len(centroids):
        kind = dict(vectors.dtypes)["vec_id"]
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        moved = next_centroids(chunks, centroids)
        if np.array_equal(moved, centroids):
            break  # further rounds change nothing
        centroids = moved
    found = store(assignments(chunks, centroids), "centroid-assignments")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    total = sum(inertia.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per_cluster = spark.createDataFrame([(c, s, total, digest[c]) for c, s in inertia.items()],
                                        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(per_cluster), "cluster")  # k rows
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
