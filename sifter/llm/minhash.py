"""Near-duplicate detection by consistent weighted sampling (operator 1).

A text is the weighted set of its five-word shingles (lower-cased, split at
white space).  A shingle weighs its count in the text times its inverse
document frequency, the mean of those of its words,

    idf(w) = 1 + ln(N / df(w)) / ln(N)          between 1 and 2,

with df counted over all documents in ``DF_BUCKETS`` hash buckets (so the table
that tasks need has a fixed size).  Word frequencies are used since a shingle's
own frequency would make the shared text of a large group of copies weightless
against every single edit, and the members of large groups unlike each other.

Improved consistent weighted sampling draws ``BANDS * ROWS`` samples of each
set; two texts agree in a sample with the probability of their weighted Jaccard
similarity.  Texts that agree in all samples of a band meet in a bucket.  In a
bucket every text is compared with a few leaders, not with every other text, so
the pairs grow with the texts; what the leaders leave in different classes is
then compared by its samples (``residual_pairs``), and what is still in different
classes of a large bucket is compared in tiles, every pair (``remaining_links``).
Pairs whose samples do not rule out the threshold are verified by their exact
weighted Jaccard similarity, and the links of at least ``SIMILARITY`` make the
classes (connected components, by label propagation over stored tables).

Defined results: texts equal up to case and white space are one node, so
copies make no pairs; null, empty and blank texts are one class; a text of
fewer than five words is one shingle; rows repeated are members like others;
the class id is the least non-null doc_id of the class (null if it has none);
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import keep_rows, lean, slices, store, texts_of, utf8_of, who

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 3
#: Bytes of text that are split into words and hashed at a time.
TEXT_BYTES = 1 << 20
#: Share of agreeing samples below which a pair cannot reach the threshold
#: (4.3 standard deviations of 48 samples under 0.8).
LEAST_AGREEMENT = 0.55
#: Elements that may lie below this, over the weight of their set, are drawn first.
LIKELY = 6.0
#: Elements times samples that are drawn at a time.
SAMPLED = 1 << 15
DF_BUCKETS = 1 << 18
#: Nodes of a bucket up to which all those of different classes are paired.
SMALL = 64
#: In a larger bucket, partners of each node outside the leaders' classes.
NEAREST = 2
#: Such nodes that are compared at a time.
BLOCK = 2048
#: Nodes and bytes of text on a side of a tile of a large bucket.
TILE, TILE_BYTES = 1024, 8 << 20


class Words:
    """Hashes and document-frequency buckets of the words looked up last."""

    def look_up(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the words of each text; until the next call ``hashes`` and ``buckets`` hold what they stand for."""
        numbers, lengths = self.number([" ".join(t) for t in texts])
        return np.split(numbers, np.cumsum(lengths)[:-1])[:len(texts)]

    def number(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words joined by single spaces: the numbers of all texts in a row, and how many each text has."""
        import xxhash

        cut = pc.split_pattern(pa.array([t or None for t in texts], pa.string()), " ")
        coded = cut.flatten().dictionary_encode()
        distinct = utf8_of(coded.dictionary)  # few next to the words
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct], dtype=np.uint64)
        self.buckets = np.array([zlib.crc32(w) for w in distinct], dtype=np.int64) % DF_BUCKETS
        return np.asarray(coded.indices), np.asarray(pc.fill_null(pc.list_value_length(cut), 0))


def words_of(text: str) -> list[str]:
    return text.lower().split()


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(32))


def _shingles(hashes: np.ndarray, idf: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and summed idf of the ``n`` words from each place."""
    m = len(hashes) - n + 1
    shingle, weight = np.zeros(m, np.uint64), np.zeros(m)
    with np.errstate(over="ignore"):
        for i in range(n):
            shingle = _mix(shingle * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + m])
            weight += idf[i:i + m]
    return shingle, weight


def _distinct(shingle: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(shingle, kind="stable")
    shingle, weight = shingle[order], weight[order]
    new = np.ones(len(shingle), dtype=bool)
    np.not_equal(shingle[1:], shingle[:-1], out=new[1:])
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(shingle))
    return shingle[first], weight[first] / n * count


def weighted_shingles(hashes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text, ascending, and their weights."""
    n = min(SHINGLE, len(hashes))
    if n == 0:
        return hashes, np.zeros(0, np.float64)
    return _distinct(*_shingles(hashes, idf, n), n)


def weighted_sets(hashes: np.ndarray, idf: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``weighted_shingles`` of texts whose words lie in a row, hashed together."""
    shingle, weight = _shingles(hashes, idf, SHINGLE) if len(hashes) >= SHINGLE else (None, None)
    at = 0
    for n in lengths.tolist():
        if n < SHINGLE:
            yield weighted_shingles(hashes[at:at + n], idf[at:at + n])
        else:
            yield _distinct(shingle[at:at + n - SHINGLE + 1], weight[at:at + n - SHINGLE + 1], SHINGLE)
        at += n


def icws(shingles: np.ndarray, weights: np.ndarray, samples: int = BANDS * ROWS) -> np.ndarray:
    """Improved consistent weighted samples of a weighted set, one int per sample."""
    return icws_of([(shingles, weights)], samples)[0]


def icws_of(sets: list[tuple[np.ndarray, np.ndarray]], samples: int = BANDS * ROWS) -> np.ndarray:
    """Improved consistent weighted samples of weighted sets, a line each.

    For every element and sample, r and c are Gamma(2, 1) and beta uniform, drawn
    from a hash of both; the element with the least ln c - r (t - beta) - r,
    t = floor(ln S / r + beta), is the sample, together with its t.

    exp of that value is exponential with rate S, so the least over the set
    lies below ``LIKELY`` / (sum of the weights) but for one sample in 400.
    Elements that cannot lie below are left out; samples without an element
    below are drawn again from all.
    """
    seeds = _mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    most = np.array([LIKELY / w.sum() if len(w) else np.inf for _, w in sets])
    out, best = _least(sets, seeds, most)
    again = best > np.log(most)[:, None]
    for i in np.flatnonzero(again.any(axis=1)):
        out[i, again[i]] = _least([sets[i]], seeds[again[i]], np.array([np.inf]))[0]
    return out


def _least(sets: list[tuple[np.ndarray, np.ndarray]], seeds: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The samples of each set among the elements whose exp(value) may be at most ``most``, and their values.

    With e^-r = u0 u1 and c = -ln(u2 u3) exp of the value lies above u0 u1 c / S,
    which takes one logarithm instead of three.
    """
    n = len(seeds)
    best, out = np.full(len(sets) * n, np.inf, np.float32), np.zeros(len(sets) * n, np.int32)
    step = max(1, SAMPLED // n)  # bounded work arrays for long texts
    room = [np.empty(n * step, np.uint64), np.empty(n * step, np.uint64), np.empty(4 * n * step, np.float32), np.empty(n * step, np.float32)]
    held, count = [], 0
    for i, (shingles, weights) in enumerate(sets):
        # a hundredth more, for what 32-bit floats round
        limit = (weights * (-1.01 * 2.0**32 * most[i])).astype(np.float32)
        for lo in range(0, len(shingles), step):
            s = shingles[lo:lo + step]
            m = len(s)
            h, other, bound = (x[:n * m].reshape(n, m) for x in (room[0], room[1], room[3]))
            parts = room[2][:4 * n * m].reshape(n, m, 4)
            np.multiply(seeds[:, None], s, out=h)
            h ^= np.right_shift(h, np.uint64(32), out=other)
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= np.right_shift(h, np.uint64(29), out=other)
            np.add(h.view(np.uint16).reshape(n, m, 4), np.float32(0.5), out=parts)
            np.multiply(parts[:, :, 2], parts[:, :, 3], out=bound)
            bound *= np.float32(2.0**-32)
            np.log(bound, out=bound)
            bound *= parts[:, :, 0]
            bound *= parts[:, :, 1]
            at = np.flatnonzero(bound >= limit[lo:lo + step])
            sample = at // m
            place = at - sample * m + lo
            held.append((sample + i * n, h.reshape(-1)[at], shingles[place], weights[place]))
            count += len(at)
            if count >= SAMPLED:
                _settle(held, best, out)
                held, count = [], 0
    _settle(held, best, out)
    return out.reshape(len(sets), n), best.reshape(len(sets), n)


def _settle(held: list[tuple], best: np.ndarray, out: np.ndarray) -> None:
    """Put the least of the held elements of every sample into ``best`` and ``out`` where it is less."""
    if not held:
        return
    sample, h, shingle, weight = (np.concatenate(x) for x in zip(*held, strict=True))
    if not len(sample):
        return
    if (sample[1:] < sample[:-1]).any():  # a set in several steps
        order = np.argsort(sample, kind="stable")
        sample, h, shingle, weight = (x[order] for x in (sample, h, shingle, weight))
    parts = (h.view(np.uint16).astype(np.float32).reshape(len(h), 4) + np.float32(0.5)) * np.float32(1 / 65536)
    r = -np.log(parts[:, 0] * parts[:, 1])
    c = -np.log(parts[:, 2] * parts[:, 3])
    extra = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    beta = extra.astype(np.float32) * np.float32(2.0**-24)
    t = np.floor(np.log(weight).astype(np.float32) / r + beta)
    a = np.log(c) - r * (t - beta + np.float32(1))
    first = np.flatnonzero(np.r_[True, sample[1:] != sample[:-1]])
    least = np.minimum.reduceat(a, first)
    hit = np.flatnonzero(a == np.repeat(least, np.diff(first, append=len(a))))
    chosen, sample = hit[np.searchsorted(hit, first)], sample[first]
    value = _mix(shingle[chosen] + t[chosen].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    better = least < best[sample]
    best[sample[better]] = least[better]
    out[sample[better]] = (value >> np.uint64(32)).astype(np.uint32).view(np.int32)[better]


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][i], b[1][j]).sum()
    return float(shared / (a[1].sum() + b[1].sum() - shared))


# -- document frequencies ------------------------------------------------------


def idf_table(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of every hash bucket of words, counted over all documents."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, df, n = Words(), np.zeros(DF_BUCKETS + 1, np.int64), 0
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                for use in words.look_up([words_of(t) for t in texts_of(part)]):
                    df[words.buckets[use]] += 1  # one more for a bucket, however often it is named
                n += part.num_rows
        df[DF_BUCKETS] = n  # the last row counts documents
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], names=["bucket", "n"])

    # at most DF_BUCKETS + 1 rows
    counted = docs.select("text").mapInArrow(lean(count), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    df = np.ones(DF_BUCKETS + 1)
    df[counted["bucket"]] = counted["n"]
    total = max(2.0, df[DF_BUCKETS])
    return (1 + np.log(total / np.minimum(df[:DF_BUCKETS], total)) / np.log(total)).astype(np.float64)


# -- sketches --------------------------------------------------------------------


def sketches(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """Stored: doc_id, node (digest of the words) and the samples of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # DF_BUCKETS numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        words = Words()
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                texts = [" ".join(words_of(t)) for t in texts_of(part)]
                use, lengths = words.number(texts)
                samples = icws_of(list(weighted_sets(words.hashes[use], shared.value[words.buckets][use], lengths)))
                nodes = [xxhash.xxh3_128_digest(t.encode("utf-8", "surrogatepass")) for t in texts]
                places = pa.array(np.arange(len(samples) + 1, dtype=np.int32) * samples.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(nodes, pa.binary()),
                     pa.ListArray.from_arrays(places, pa.array(samples.reshape(-1)))], names=["doc_id", "text_hash", "node", "samples"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = dict(docs.dtypes)["doc_id"]
    return store(rows.mapInArrow(lean(run), f"doc_id {kind}, text_hash long, node binary, samples array<int>"), "minhash-sketches")


def bands() -> Column:
    """The bucket of each band of the samples."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.slice("samples", b * ROWS + 1, ROWS)))


def buckets(nodes: DataFrame) -> DataFrame:
    """Stored: bucket and node, of buckets with two nodes at least."""
    rows = nodes.select("node", F.explode(bands()).alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    return store(rows.join(shared, "bucket").select("bucket", "node"), "minhash-buckets")


def leaders(rows: DataFrame) -> DataFrame:
    """bucket and its leaders: the least and the largest node, and the first of two other orders."""
    return rows.groupBy("bucket").agg(F.array_distinct(F.array(
        F.min("node"), F.max("node"), *(F.min_by("node", F.xxhash64("node", F.lit(i))) for i in (1, 2)))).alias("leaders"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def leader_pairs(rows: DataFrame) -> DataFrame:
    return _ordered(rows.join(leaders(rows), "bucket").select(F.col("node").alias("a"), F.explode("leaders").alias("b")))


def agreeing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose samples do not rule the threshold out."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("samples").alias(f"samples_{c}"))
    same = F.size(F.filter(F.zip_with("samples_a", "samples_b", lambda x, y: x == y), lambda e: e))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(same >= int(np.ceil(LEAST_AGREEMENT * BANDS * ROWS))).select("a", "b"))


def verify(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """Stored: the pairs of nodes whose exact weighted Jaccard similarity reaches the threshold."""
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for part in slices(batch, "text_a", TEXT_BYTES):
                sets = []
                for column in ("text_a", "text_b"):
                    use, lengths = words.number([" ".join(words_of(t)) for t in texts_of(part, column)])
                    sets.append(weighted_sets(words.hashes[use], shared.value[words.buckets][use], lengths))
                score = np.array([weighted_jaccard(x, y) for x, y in zip(*sets, strict=True)])
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(score)], names=["a", "b", "score"])

    side = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return store(both.mapInArrow(lean(run), "a binary, b binary, score double").filter(F.col("score") >= similarity), "minhash-links")


def components(links: DataFrame) -> DataFrame:
    """Stored: node and label (least node of its component) of all linked nodes."""
    both = store(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "minhash-edges")
    labels = store(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("label")), "minhash-labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        told = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        moved = store(told.join(jump, "label").select("node", "old", F.least("label", "further").alias("label")), "minhash-labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def residual_pairs(rows: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs of different classes in a bucket, other than those with leaders, that their samples do not rule out.

    In a bucket of up to SMALL nodes all nodes of different classes are paired.
    In a larger one each node that shares no class with the leaders is paired
    with the NEAREST such nodes that agree with it in most samples, so the pairs
    grow with the nodes; when there are more than BLOCK of them they are split by a
    second band (texts alike to 0.8 agree in two bands of 16 but for 2 in 10,000).
    """
    label = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_leaders = (leaders(rows).select("bucket", F.explode("leaders").alias("node")).join(labels, "node", "left")
                  .groupBy("bucket").agg(F.collect_set(F.coalesce("label", "node")).alias("led")))
    marked = label.join(of_leaders, "bucket").withColumn("outside", ~F.array_contains("led", F.col("label"))).drop("led")
    sizes = (marked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_if("outside").alias("n_outside"),
                                          (F.min("label") < F.max("label")).alias("mixed"))
             .filter(F.col("mixed") & ((F.col("n") <= SMALL) | (F.col("n_outside") > 1))).drop("mixed"))
    rest = marked.join(sizes, "bucket").filter((F.col("n") <= SMALL) | F.col("outside")).join(nodes.select("node", "samples"), "node")
    rest = store(rest.select("bucket", "node", "label", "samples", (F.col("n") > SMALL).alias("large"),
                             ((F.col("n") > SMALL) & (F.col("n_outside") > BLOCK)).alias("split")), "minhash-rest")
    second = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64("bucket", b, F.slice("samples", b * ROWS + 1, ROWS)))
    split = rest.filter("split").select(F.explode(second).alias("bucket"), "node", "label", "samples", "large")
    dealt = rest.filter("NOT split").drop("split").unionByName(split).repartition("bucket").sortWithinPartitions("bucket", "node")
    least = int(np.ceil(LEAST_AGREEMENT * BANDS * ROWS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def compare(block: list[tuple]) -> Iterator[pa.RecordBatch]:
            """Pairs of different classes that agree enough; of a large bucket the nearest of each node."""
            samples, names = np.array([h[2] for h in block], dtype=np.int32), {}
            label = np.array([names.setdefault(h[1], len(names)) for h in block])
            for i, mine in enumerate(samples):
                agree = (samples == mine).sum(axis=1)
                near = np.flatnonzero((agree >= least) & (label != label[i]))
                if block[i][3]:
                    near = near[np.argsort(-agree[near], kind="stable")[:NEAREST]]
                else:
                    near = near[near < i]
                if len(near):
                    yield pa.RecordBatch.from_arrays([pa.array([block[i][0]] * len(near), pa.binary()), pa.array([block[j][0] for j in near.tolist()], pa.binary())],
                                                     names=["a", "b"])

        for batch in batches:
            for key, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "node", "label", "samples", "large")), strict=True):
                if key != bucket or len(held) == BLOCK:
                    yield from compare(held)
                    bucket, held = key, []
                held.append(tuple(row))
        yield from compare(held)

    return _ordered(dealt.mapInArrow(lean(run), "a binary, b binary"))


def unsettled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored: bucket, node and label of the buckets of more than SMALL nodes that hold several classes."""
    label = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = (label.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("least"), F.max("label").alias("most"))
             .filter((F.col("n") > SMALL) & (F.col("least") < F.col("most"))).select("bucket"))
    return store(label.join(mixed, "bucket").select("bucket", "node", "label"), "minhash-unsettled")


def remaining_links(rest: DataFrame, nodes: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """Stored: links that join every two classes of a bucket with a pair that reaches the threshold.

    Of two classes of a bucket one at least is not its largest: the nodes
    outside the largest class, in groups of about TILE, are compared with all nodes
    of the bucket, in such groups too, one tile of two groups after the other in
    tasks.  A pair is compared in the first bucket that it shares, and only while its
    classes are not linked yet; a tile returns fewer links than it has nodes.
    """
    shared = texts.sparkSession.sparkContext.broadcast(idf)
    sized = store(rest.join(texts, "node").join(nodes, "node")
                  .select("bucket", "node", "label", "samples", "text", F.array_position(bands(), F.col("bucket")).alias("band"),
                          F.octet_length("text").alias("size")), "minhash-unsettled-texts")
    largest = (sized.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
               .groupBy("bucket").agg(F.max(F.struct("n", "label", "size")).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("all_size")))
    groups = lambda n, size: F.greatest(F.lit(1), F.ceil(n / TILE), F.ceil(size / TILE_BYTES)).cast("int")
    dealt = (sized.join(largest.select("bucket", F.col("main.label").alias("main"), groups(F.col("n"), F.col("all_size")).alias("columns"),
                                       groups(F.col("n") - F.col("main.n"), F.col("all_size") - F.col("main.size")).alias("lines")), "bucket")
             .withColumn("outside", F.col("label") != F.col("main")))
    mine = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["bucket", "line", "column", "first", "outside", "node", "label", "samples", "band", "text"]
    one = dealt.filter("outside").withColumns({"line": mine("lines", 1), "first": F.lit(True)}).withColumn("column", every("columns"))
    two = dealt.withColumns({"column": mine("columns", 2), "first": F.lit(False)}).withColumn("line", every("lines"))
    tiles = (one.select(kept).unionByName(two.select(kept)).repartition("bucket", "line", "column")
             .sortWithinPartitions("bucket", "line", "column"))
    least = int(np.ceil(LEAST_AGREEMENT * BANDS * ROWS))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tile, held = Words(), None, []

        def compare(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            left, right = [r for r in rows if r[0]], [r for r in rows if not r[0]]
            if not left or not right:
                return
            names, sets, found = {}, {}, []
            number = lambda side: np.array([names.setdefault(r[3], len(names)) for r in side])
            mine, label = number(left), number(right)
            outside, samples, band = np.array([r[1] for r in right]), np.array([r[4] for r in right], dtype=np.int32), left[0][5] - 1

            def set_of(row: tuple) -> tuple[np.ndarray, np.ndarray]:
                if row[2] not in sets:
                    use, = words.look_up([words_of(row[6] or "")])
                    sets[row[2]] = weighted_shingles(words.hashes[use], shared.value[words.buckets[use]])
                return sets[row[2]]

            for i, row in enumerate(left):
                same = samples == np.array(row[4], dtype=np.int32)
                near = np.flatnonzero((same.sum(axis=1) >= least) & (label != mine[i]))
                if band >= 0 and len(near):
                    met = same[near].reshape(len(near), BANDS, ROWS).all(axis=2)
                    near = near[met.argmax(axis=1) == band]
                for j in near.tolist():
                    other = right[j]
                    if label[j] == mine[i] or (outside[j] and other[2] < row[2]):
                        continue
                    score = weighted_jaccard(set_of(row), set_of(other))
                    if score >= similarity:
                        found.append((*sorted((row[2], other[2])), score))
                        old, new = label[j], mine[i]
                        mine[mine == old], label[label == old] = new, new
            if found:
                a, b, score = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(score, pa.float64())], names=["a", "b", "score"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in kept), strict=True):
                if row[:3] != tile:
                    yield from compare(held)
                    tile, held = row[:3], []
                held.append(row[3:])
        yield from compare(held)

    return store(tiles.mapInArrow(lean(run), "a binary, b binary, score double"), "minhash-links")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, class_size and kept of every row; of each class one row is kept, of the least doc_id (null last)."""
    rows, labels, _ = link(docs, similarity)
    return classes(rows, labels)


def link(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored rows with their nodes, labels of the linked nodes, and the links."""
    idf = idf_table(docs)
    rows = sketches(docs, idf)
    nodes = store(rows.groupBy("node").agg(F.first("samples").alias("samples")), "minhash-nodes")
    met = buckets(nodes)
    pairs = store(agreeing(leader_pairs(met), nodes), "minhash-pairs")
    links = verify(pairs, _texts(docs, rows, pairs), idf, similarity)
    labels = components(links)
    more = store(residual_pairs(met, labels, nodes).join(pairs, ["a", "b"], "left_anti"), "minhash-pairs")
    if not more.isEmpty():
        links = links.unionByName(verify(more, _texts(docs, rows, more), idf, similarity))
        labels = components(links)
    rest = unsettled(met, labels)
    if not rest.isEmpty():
        texts = _texts(docs, rows, rest.select(F.col("node").alias("a"), F.col("node").alias("b")))
        # two tiles may have found one link
        links = links.unionByName(remaining_links(rest, nodes, texts, idf, similarity)).dropDuplicates(["a", "b"])
        labels = components(links)
    return rows, labels, links


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents' columns of one row of each class, the one with the least doc_id."""
    rows, labels, _ = link(docs, similarity)
    label = rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = label.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")).select("first.*")
    keys = {"__who": who(), "__text_hash": F.xxhash64("text")}
    return keep_rows(docs, keys, first.select(who().alias("__who"), F.col("text_hash").alias("__text_hash")))


def _texts(docs: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """Stored: node and text of the nodes in pairs, each from one of its rows."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    chosen = (rows.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("row")).join(wanted, "node")
              .select("node", who("row.doc_id").alias("__who"), F.col("row.text_hash").alias("__text_hash")))
    keys = {"__who": who(), "__text_hash": F.xxhash64("text")}
    found = docs.select("doc_id", "text").withColumns(keys).join(chosen, list(keys)).select("node", "text")
    return store(found.dropDuplicates(["node"]), "minhash-texts")


def classes(rows: DataFrame, labels: DataFrame) -> DataFrame:
    member = (rows.select("doc_id", "text_hash", "node").join(labels, "node", "left")
              .select("doc_id", F.coalesce("label", "node").alias("label"),
                      F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", F.monotonically_increasing_id().alias("row")).alias("place")))
    member = store(member, "minhash-members")  # the numbers of the rows are fixed once written
    sizes = member.groupBy("label").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("class_size"))
    return (member.join(sizes, "label")
            .select("doc_id", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("place.row") == F.col("first.row")).alias("kept")))
