"""Phrase collocations counted in quotient filters (operator 13).

1. A chunk of documents of one language (its text is bounded) numbers its own
   words and is stored as these words, their counts and the stream of numbers.
2. Words that occur often enough get ids by their language and spelling, and
   each chunk the list of the ids of its words.
3. A chunk packs the ids of every two and three neighbouring words into one
   integer.  A permutation of the integers of that width, which can be undone,
   spreads them evenly; its upper bits name the shard and the quotient, the rest
   is the full remainder, so nothing is lost and equal phrases meet at one place.
   Counted, sorted and stored as run lengths, remainders and counts these are
   the chunk's filters, one per shard.
4. The filters of a shard are merged in their order, adding up counts; phrases
   that are frequent enough are unpacked by undoing the permutation.

Counts are exact at every step.  A frequent word or phrase is one entry per
chunk wherever it goes; ids wider than ``MAX_ID_BITS`` are refused.

Defined results: a null text counts as empty, a null lang as ``und``; rows with
the same doc_id are separate texts; documents without words add nothing; an
empty table gives an empty result; other columns are ignored.  Ties in the
score are ordered by count and then by the phrase's UTF-8 bytes.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.common import store
from sifter.operators.index import assign_ids

LEAST_COUNT, MAX_WORDS, TOP, COVERED_PERCENT = 10, 3, 2000, 50
#: Text after which a chunk is closed.
CHUNK_BYTES = 8 << 20
#: Entries that the filters of a shard hold at most on average.
SHARD_ENTRIES = 1 << 21
MAX_ID_BITS = 31
#: Words of a stream whose phrases are packed at a time.
STEP = 1 << 16
#: Copies of a lookup table, so that a frequent key is spread over as many tasks.
SALT = 8
#: Parts of a language that are ranked by themselves first.
PARTS = 16
_HEAD = "<4sI5B"
# What ends a piece (beside the ends of the text), and what ends a word
_BREAKS, _BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_TABLE = bytes(0x0A if b in _BREAKS else 0x20 if b in _BLANKS else b + 32 if 65 <= b <= 90 else b for b in range(256))


def _large(table: DataFrame) -> DataFrame:
    """A side of a join that grows with the corpus: merged, never broadcast.

    Spark takes a stored table for as large as its compressed files, also after an
    explode, and would hold many times that on the driver.
    """
    return table.hint("merge")


# -- chunks of numbered words -----------------------------------------------------


class _Numbers(dict):
    """Numbers keys from 1 in the order in which they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        return number


def number_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Distinct words, the first of them at 1, and the texts as numbers; 0 stands between pieces."""
    known = _Numbers({b"\n": 0})
    number = known.__getitem__
    streams = [[number(w) for w in t.translate(_TABLE).replace(b"\n", b" \n ").split(b" ") if w] + [0] for t in texts]
    flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(s, dtype=np.uint32) for s in streams)])
    return list(known)[1:], flat


def write_chunks(docs: DataFrame, name: str = "collocation-chunks") -> DataFrame:
    """Stored chunks: chunk, lang, words, counts, stream."""

    def number(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def chunk(lang: str) -> pa.RecordBatch:
            words, stream = number_words(held.pop(lang))
            size.pop(lang)
            counts = np.bincount(stream, minlength=len(words) + 1)[1:]
            return pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([words], pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([stream.astype("<u4").tobytes()], pa.binary())],
                names=["lang", "words", "counts", "stream"])

        for batch in batches:
            texts = pc.fill_null(batch.column("text").cast(pa.binary()), b"")
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                raw = text.as_py()
                held.setdefault(lang, []).append(raw)
                size[lang] = size.get(lang, 0) + len(raw)
                if size[lang] >= CHUNK_BYTES:
                    yield chunk(lang)
                elif sum(size.values()) >= 2 * CHUNK_BYTES:  # many languages: the largest goes first
                    yield chunk(max(size, key=size.get))
        for lang in list(held):
            yield chunk(lang)

    base = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    found = base.mapInArrow(number, "lang string, words array<string>, counts array<long>, stream binary")
    return store(found.withColumn("chunk", F.monotonically_increasing_id()), name)


def frequent_words(chunks: DataFrame, least: int) -> DataFrame:
    """id, lang, word, f of the words that occur ``least`` times in their language; ids from 1."""
    counts = (chunks.select("lang", F.inline(F.arrays_zip("words", "counts")))
              .groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")).filter(F.col("f") >= least))
    key = F.concat("lang", F.lit("\t"), "word")  # no word holds a tab
    found = store(counts.withColumn("key", key), "collocation-words")
    return store(found.join(_large(assign_ids(found, "key")), "key").select("id", "lang", "word", "f"), "collocation-ids")


# -- packed phrases ---------------------------------------------------------------


class Packing:
    """Phrases of up to three ids as integers of 3 * bits, permuted, in two lanes.

    Phrases of two words have 0 as their third id.  The upper lane holds the
    first ``high`` bits.
    """

    def __init__(self, bits: int):
        if bits > MAX_ID_BITS:
            raise ValueError(f"more than 2^{MAX_ID_BITS} distinct words")
        self.bits, self.low = bits, (3 * bits + 1) // 2
        self.high = 3 * bits - self.low

    def pack(self, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        b, low = np.uint64(self.bits), np.uint64(self.low)
        yz = y.astype(np.uint64) << b | z.astype(np.uint64)
        upper = x.astype(np.uint64) << np.uint64(2 * self.bits - self.low) | yz >> low
        return self._permute(upper, yz & _mask(self.low))

    def unpack(self, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        upper, lower = self._permute(upper, lower, back=True)
        rest = np.uint64(2 * self.bits - self.low)
        yz = (upper & _mask(int(rest))) << np.uint64(self.low) | lower
        return tuple(v.astype(np.int64) for v in (upper >> rest, yz >> np.uint64(self.bits), yz & _mask(self.bits)))

    def _permute(self, upper: np.ndarray, lower: np.ndarray, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Four rounds, each of which adds a mix of one lane to the other; backwards they undo themselves."""
        for r in (3, 2, 1, 0) if back else (0, 1, 2, 3):
            if r % 2:
                lower = lower ^ (_mix(upper, r) & _mask(self.low))
            else:
                upper = upper ^ (_mix(lower, r) & _mask(self.high))
        return upper, lower

    def order(self, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
        if 3 * self.bits <= 64:
            return np.argsort(upper << np.uint64(self.low) | lower, kind="stable")
        return np.lexsort((lower, upper))


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _mix(v: np.ndarray, r: int) -> np.ndarray:
    v = (v + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
    v = (v ^ v >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return v ^ v >> np.uint64(32)


def count_sorted(packing: Packing, upper: np.ndarray, lower: np.ndarray, counts: np.ndarray | None = None):
    """Distinct phrases in order with their counts."""
    order = packing.order(upper, lower)
    upper, lower = upper[order], lower[order]
    first = np.flatnonzero(np.r_[True, (upper[1:] != upper[:-1]) | (lower[1:] != lower[:-1])]) if len(upper) else order
    if counts is None:
        total = np.diff(np.r_[first, len(upper)])
    else:
        total = np.add.reduceat(counts[order], first) if len(first) else counts
    return upper[first], lower[first], total


# -- filters ----------------------------------------------------------------------


def _narrow(values: np.ndarray) -> np.ndarray:
    """In the narrowest unsigned type that holds them."""
    most = int(values.max()) if len(values) else 0
    return values.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most < 1 << 8 * int(t[2])))


def _columns(values: np.ndarray, bits: int) -> bytes:
    """The low bytes of 64-bit integers, as many as ``bits`` need."""
    return values.astype("<u8").view(np.uint8).reshape(len(values), 8)[:, :-(-bits // 8)].tobytes()


def _from_columns(data: bytes, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = -(-bits // 8)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    return out.view("<u8")[:, 0].astype(np.uint64), at + n * width


def write_filter(packing: Packing, shard_bits: int, upper: np.ndarray, lower: np.ndarray, counts: np.ndarray) -> bytes:
    """A filter from the sorted entries of one shard.

    Run lengths (the entries of every quotient), then the remainders (what the upper
    lane has below the quotient, and the lower lane), then the counts.
    """
    room = packing.high - shard_bits
    q = min(room, max(0, len(upper).bit_length() - 1))
    quotient = (upper & _mask(room)) >> np.uint64(room - q)
    runs = _narrow(np.bincount(quotient.astype(np.int64), minlength=1 << q))
    times = _narrow(counts)
    return b"".join([struct.pack(_HEAD, b"CQF1", len(upper), packing.bits, shard_bits, q, runs.itemsize, times.itemsize),
                     runs.tobytes(), _columns(upper & _mask(room - q), room - q), _columns(lower, packing.low), times.tobytes()])


def read_filter(data: bytes, shard: int) -> tuple[Packing, np.ndarray, np.ndarray, np.ndarray]:
    magic, n, bits, shard_bits, q, run_width, count_width = struct.unpack_from(_HEAD, data)
    if magic != b"CQF1":
        raise ValueError("not a quotient filter")
    packing, at = Packing(bits), struct.calcsize(_HEAD)
    room = packing.high - shard_bits
    runs = np.frombuffer(data, f"<u{run_width}", 1 << q, at)
    at += runs.nbytes
    rest, at = _from_columns(data, at, n, room - q)
    lower, at = _from_columns(data, at, n, packing.low)
    quotient = np.repeat(np.arange(1 << q, dtype=np.uint64), runs)
    upper = np.uint64(shard) << np.uint64(room) | quotient << np.uint64(room - q) | rest
    return packing, upper, lower, np.frombuffer(data, f"<u{count_width}", n, at).astype(np.int64)


def phrases(stream: np.ndarray, ids: np.ndarray, packing: Packing) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All neighbouring words of a stream that have ids, packed, two and three at a time; ``STEP`` words after the other."""
    for lo in range(0, len(stream), STEP):
        s = ids[stream[lo:lo + STEP + 2]]
        two = np.flatnonzero((s[:-1] > 0) & (s[1:] > 0))
        three = two[:-1][np.diff(two) == 1]
        two, three = two[two < STEP], three[three < STEP]  # the next step has the others
        yield packing.pack(s[two], s[two + 1], np.zeros(len(two), dtype=np.int64))
        yield packing.pack(s[three], s[three + 1], s[three + 2])


def count_phrases(stream: np.ndarray, ids: np.ndarray, packing: Packing) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``count_sorted`` of the phrases of a stream; where both lanes fit into 64 bits, sorted in place."""
    packed = phrases(stream, ids, packing)
    if 3 * packing.bits > 64:
        lanes = list(zip(*packed, strict=True)) or [[np.zeros(0, np.uint64)]] * 2
        return count_sorted(packing, *map(np.concatenate, lanes))
    low = np.uint64(packing.low)
    keys = np.concatenate([np.zeros(0, np.uint64), *(u << low | v for u, v in packed)])
    keys.sort()
    new = np.ones(len(keys), dtype=bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    counts = np.diff(np.flatnonzero(new), append=len(keys))
    keys = keys[new]
    return keys >> low, keys & _mask(packing.low), counts


def chunk_filters(chunks: DataFrame, vocabulary: DataFrame, packing: Packing, shard_bits: int) -> DataFrame:
    """shard, filter: for every chunk one filter per shard that it has phrases of."""
    words = chunks.select("chunk", "lang", F.posexplode("words").alias("place", "word"))
    known = (words.join(_large(vocabulary.select("lang", "word", "id")), ["lang", "word"])
             .groupBy("chunk")  # a chunk's words: bounded; place and id in one long
             .agg(F.collect_list(F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("id"))).alias("known")))

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for stream, known in zip(batch.column("stream"), batch.column("known"), strict=True):
                numbers = np.frombuffer(stream.as_py(), "<u4")
                known = np.asarray(known.values)
                place = known >> 32
                table = np.zeros(max(int(numbers.max(initial=0)), int(place.max(initial=-1)) + 1) + 1, dtype=np.int64)
                table[place + 1] = known & (2**32 - 1)
                upper, lower, counts = count_phrases(numbers, table, packing)
                cuts = np.searchsorted(upper, np.arange((1 << shard_bits) + 1, dtype=np.uint64) << np.uint64(packing.high - shard_bits))
                found = [(shard, write_filter(packing, shard_bits, upper[lo:hi], lower[lo:hi], counts[lo:hi]))
                         for shard, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if lo < hi]
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int64()), pa.array([f for _, f in found], pa.binary())],
                                                 names=["shard", "filter"])

    return chunks.select("chunk", "stream").join(_large(known), "chunk").select("stream", "known").mapInArrow(count, "shard long, filter binary")


def merged_counts(filters: DataFrame, least: int) -> DataFrame:
    """x, y, z, a of all phrases that occur ``least`` times; z is 0 for two words."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        packing, lanes = None, []
        for data in table.column("filter"):
            packing, *found = read_filter(data.as_py(), shard)
            lanes.append(found)
        lanes = list(zip(*lanes, strict=True))
        u, v, c = count_sorted(packing, *(np.concatenate(lanes.pop(0)) for _ in range(3)))
        x, y, z = packing.unpack(u[c >= least], v[c >= least])
        return pa.table({"x": x, "y": y, "z": z, "a": c[c >= least].astype(np.int64)})

    return filters.groupBy("shard").applyInArrow(merge, "x long, y long, z long, a long")


# -- scores -----------------------------------------------------------------------


def _salted(table: DataFrame, keys: dict[str, str], values: dict[str, str]) -> DataFrame:
    """A lookup table under other names, ``SALT`` times."""
    return _large(table.select(*[F.col(k).alias(n) for k, n in keys.items()], *[F.col(v).alias(n) for v, n in values.items()],
                               F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")))


def _score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """floor(1000000 * a * a / (l * r)) in decimals of 38 digits; ``div`` keeps the whole part only."""
    wide = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", (wide(a) * wide(a)).cast("decimal(31,0)") * F.lit(1000000).cast("decimal(7,0)"),
                           (wide(l) * wide(r)).cast("decimal(38,0)")).cast("long")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases."""
    chunks = write_chunks(docs)
    sizes = chunks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c)).alias("n"))
    sizes = store(sizes, "collocation-sizes")
    vocabulary = frequent_words(chunks, least)
    bits = max(1, int(vocabulary.agg(F.max("id")).first()[0] or 0).bit_length())
    entries = 2 * int(sizes.agg(F.sum("n")).first()[0] or 0)
    packing = Packing(bits)
    shard_bits = min(packing.high, max(0, (entries // SHARD_ENTRIES).bit_length()))
    filters = chunk_filters(chunks, vocabulary, packing, shard_bits)
    counts = store(merged_counts(filters, least), "collocation-counts", batch_bytes=CHUNK_BYTES)

    salt = F.pmod(F.xxhash64("x", "y", "z"), F.lit(SALT)).cast("int").alias("salt")
    found = counts.select("*", salt)
    for i, v in enumerate(("x", "y")):
        found = found.join(_salted(vocabulary, {"id": v}, {"f": f"f{v}", "word": f"w{v}"} | ({"lang": "lang"} if i == 0 else {})), [v, "salt"])
    two, three = found.filter("z = 0"), found.filter("z > 0")
    pairs = counts.filter("z = 0")

    # of two words those stay that no phrase of three holds half as often
    held = counts.filter("z > 0")
    covering = (held.select("x", "y", "a").unionByName(held.select(F.col("y").alias("x"), F.col("z").alias("y"), "a"))
                .groupBy("x", "y").agg(F.max("a").alias("longer")))
    two = (two.join(_large(covering), ["x", "y"], "left")
           .filter(F.col("longer").isNull() | (100 * F.col("longer") < COVERED_PERCENT * F.col("a")))
           .select("lang", F.concat_ws(" ", "wx", "wy").alias("phrase"), "a", F.col("fx").alias("l"), F.col("fy").alias("r"),
                   _score(F.col("a"), F.col("fx"), F.col("fy")).alias("score")))

    three = (three.join(_salted(vocabulary, {"id": "z"}, {"f": "fz", "word": "wz"}), ["z", "salt"])
             .join(_salted(pairs, {"x": "x", "y": "y"}, {"a": "fxy"}), ["x", "y", "salt"])
             .join(_salted(pairs, {"x": "y", "y": "z"}, {"a": "fyz"}), ["y", "z", "salt"]))
    cuts = [F.struct(_score(F.col("a"), F.col(l), F.col(r)).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
            for k, l, r in ((1, "fx", "fyz"), (2, "fxy", "fz"))]  # noqa: E741
    three = (three.select("lang", F.concat_ws(" ", "wx", "wy", "wz").alias("phrase"), "a", F.least(*cuts).alias("cut"))
             .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))

    # the first of a language are among the first of its parts, so no task sees more than the parts' first
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    part = two.unionByName(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    ranked = part.withColumn("first", first).filter(F.col("first") <= top).withColumn("rank", ranked).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
