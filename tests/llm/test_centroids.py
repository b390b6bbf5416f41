"""Centroid clustering: dictionaries, and the whole job against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sifter.llm import centroids
from sifter.llm.common import read_table

from .messy import SMALL

KIND = "vec_id long, embedding array<float>, cluster string, q string"


def brute(vectors, k=8, rounds=10, dimensions=64):
    """vec_id, cluster, distance, cluster inertia, inertia, digest, with Python's integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in vectors
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    center = [q for _, _, q in sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), n, q)
                                      for n, (i, q) in enumerate(sorted(kept, key=lambda p: p[1])))[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(center))

    for _ in range(rounds):
        groups = {}
        for _, q in kept:
            groups.setdefault(nearest(q)[1], []).append(q)
        for n, members in groups.items():
            center[n] = [sum(col) // len(members) for col in zip(*members, strict=True)]
    found = [(i, *nearest(q)[::-1]) for i, q in kept]
    each = {c: sum(d for _, x, d in found if x == c) for _, c, _ in found}
    return sorted(((i, c, d, each[c], sum(each.values()), hashlib.sha256(",".join(map(str, center[c])).encode()).hexdigest())
                   for i, c, d in found), key=repr)


def rows(n=90, seed=7):
    rng = random.Random(seed)
    common = [float(np.float32(rng.uniform(-1, 1))) for _ in range(64)]
    made = [(i, common if i % 3 == 0 else [float(np.float32(rng.choice([-0.5, 0.25, rng.gauss(0, 1)]))) for _ in range(64)]) for i in range(n)]
    made += [(1, common), (1, made[1][1]), (None, common), (None, made[2][1]), (500, None), (501, []), (502, common[:63]),
             (503, [None, *common[1:]]), (504, [float("nan"), *common[1:]]), (505, [float("inf"), *common[1:]])]
    return made


def table(spark, made):
    return spark.createDataFrame([(i, v, "mine", "mine") for i, v in made], KIND)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(2)
    q = rng.integers(-3, 3, (500, 20)) * np.array([1] * 19 + [70_000])
    sizes, entries, codes = centroids.encode_chunk(q)
    chunk = centroids.Chunk(500, sizes, entries, codes, 20)
    assert (chunk.vectors() == q).all() and len(sizes) == 3 and sizes[2] < 500
    center = rng.integers(-9, 9, (4, 20))
    cluster, distance = chunk.assign(center)
    every = ((q[:, None] - center[None]) ** 2).sum(-1)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    n, sums = chunk.sums(cluster, 4)
    for c in range(4):
        assert n[c] == (cluster == c).sum() and (sums[c] == q[cluster == c].sum(0)).all()


def test_equals_plain_integers(spark, monkeypatch):
    monkeypatch.setattr(centroids, "CHUNK", 17)
    made = rows()
    assert collected(centroids.cluster_vectors(table(spark, made).repartition(3))) == brute(made)


def test_sf_table_equals_plain_integers(spark):
    vectors = read_table(spark, SMALL, "embeddings").limit(120)
    made = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert collected(centroids.cluster_vectors(table(spark, made))) == brute(made)


def test_few_or_no_vectors(spark):
    few = rows()[:5]
    assert collected(centroids.cluster_vectors(table(spark, few))) == brute(few)
    none = centroids.cluster_vectors(table(spark, rows()).limit(0))
    assert none.count() == 0 and none.columns == centroids.cluster_vectors(table(spark, few)).columns


def test_ties_go_to_the_first_centroid(spark):
    same = [(i, [0.5] * 64) for i in range(20)]
    found = collected(centroids.cluster_vectors(table(spark, same)))
    assert {r[1] for r in found} == {0} and found == brute(same)


def test_components_too_large_are_refused(spark):
    with pytest.raises(Exception, match="vector component beyond"):
        centroids.cluster_vectors(table(spark, [*rows(), (9, [3e38] * 64)])).select(F.sum("distance")).collect()
