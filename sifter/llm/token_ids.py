"""Token ids as binary files with Re-Pair grammar compression (operator 5).

Documents are range-partitioned by doc_id and sorted, so a partition is a
shard and the shards follow one another in ascending doc_id.  A shard is cut
into blocks of whole documents.  In a block the most frequent pairs of
neighbouring symbols are replaced by new nonterminals again and again; a block
stores its rules, how many ids each rule expands to, where each document begins
and the remaining sequence, so a document, or a stretch of it, is decoded
without expanding what lies before.  Blocks are the binary column of a Parquet
table that Spark writes to the shared folder; a lost task is simply rerun.

Layout of a block, little-endian: ``RPID``, then uint32 version, documents D,
rules R, sequence length S, first nonterminal F, bytes per symbol W; uint32[R]
left symbols, uint32[R] right symbols, uint32[R] expansion lengths, uint32[D]
ids per document, uint32[D+1] first symbol per document; S symbols of W bytes.

Defined results: a null or empty text has only the end id; rows with a null
doc_id come first; rows that repeat a doc_id are ordered by text hash and text;
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.bpe_codec import byte_symbols
from sifter.llm.common import ragged, slices, store

END_ID = 2
#: Ids after which a block is closed (a longer document has a block of its own).
BLOCK_IDS = 1 << 20
#: Rules made in one round, in all, and the least count of a pair worth a rule.
ROUND_RULES, MAX_RULES, LEAST_COUNT = 2048, 14_000, 12
MAX_ROUNDS = 16
#: Distinct pieces a Python worker remembers before it forgets those that it met in one slice only.
CACHE_PIECES = 500_000
# The rules that belong to the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: Letters of scripts without marks, as they are in NFC and with one lower case each; signs that no contraction or special token begins with.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏΑ-ΡΤ-Ωα-ωЀ-ҁҊ-ԯ"
_SIGNS = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
_STEM = f"^[{LETTERS}]+"
_SIMPLE = f"{_STEM}[{regex.escape(_SIGNS, special_only=False)}]*$"
_HEAD = "<4s6I"
_CELL_BITS = 18
#: Shards whose sizes one window adds up.
SHARD_GROUP = 4096


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


def _lined(words: pa.Array) -> str:
    """Words with line ends between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "\n")[0].as_py()


def check_rules(path: str) -> None:
    """Refuse a tokenizer file with other rules than those that ``WordEncoder`` follows."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["normalizer"] != NORMALIZER or spec["pre_tokenizer"] != PRE_TOKENIZER:
        raise ValueError("the tokenizer file has other rules than this encoder")


class WordEncoder:
    """Ids of whole texts by the tokenizer file, from its library's model.

    The tokenizer normalises (NFC, lower case), drops white space and cuts words
    from digits and signs.  No rule of it reads across a space or a line end, so
    a text is cut there; the distinct words of a slice are cut into pieces in one
    go, and a piece is given to the library's BPE model once.  Letters with signs
    behind them are two pieces without a search for them.  A word that holds
    a special token's string or is not its own NFC form goes through the library
    whole.  ``check_rules`` tells whether a file has these rules.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if not all("<" in s for s in self.special):
            raise ValueError("special tokens are expected to hold a <")
        self.byte_chars = str.maketrans(dict(enumerate(byte_symbols())))
        self.pattern = regex.compile(PATTERN + r"|\n")  # and line ends between words
        self._forget()

    def _forget(self) -> None:
        self.known, self.pieces = _Numbers({"\n": 0}), _Ragged()
        self.pieces.add([[]])
        self.met = np.zeros(1, np.int64)  # slices that each piece was met in

    def _forget_rare(self) -> None:
        often = np.flatnonzero(self.met > 1)
        names, pieces = list(self.known), self.pieces
        self._forget()
        often = often[often > 0] if len(often) <= CACHE_PIECES // 2 else often[:0]
        self.known.update(zip((names[i] for i in often.tolist()), range(1, len(often) + 1), strict=True))
        self.pieces.extend(pieces.take(often), pieces.sizes[often])
        self.met = np.ones(len(self.known), np.int64)

    def _whole(self, text: str) -> bool:
        """Whether the library must see a word whole."""
        return ("<" in text and any(s in text for s in self.special)) or not text.isascii() and (
            "Σ" in text or not unicodedata.is_normalized("NFC", text))

    def _encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, and where those of each word begin and how many they are."""
        simple = pc.match_substring_regex(words, _SIMPLE)
        plain, joined = words.filter(simple), _lined(words.filter(pc.invert(simple)))
        stems = pc.utf8_rtrim(plain, _SIGNS)
        tailed = np.asarray(pc.less(pc.binary_length(stems), pc.binary_length(plain)))
        tails = pc.replace_substring_regex(plain.filter(pa.array(tailed)), _STEM, "").dictionary_encode()
        names = _lined(stems).lower().split()
        names += tails.dictionary.to_pylist()
        odd: dict[int, list[int]] = {}
        if self._whole(joined):
            each = joined.split("\n")
            odd = {i: self.tokenizer.encode(w, add_special_tokens=False).ids for i, w in enumerate(each) if self._whole(w)}
            joined = "\n".join("" if i in odd else w for i, w in enumerate(each))
        found = self.pattern.findall(joined.lower())
        if len(self.known) > CACHE_PIECES:
            self._forget_rare()
        number, before = self.known.__getitem__, len(self.known)
        use = np.fromiter(map(number, chain(names, found)), dtype=np.int64, count=len(names) + len(found))
        tokenize = self.tokenizer.model.tokenize
        self.pieces.add([[t.id for t in tokenize(self._spelled(p))] for p in islice(self.known, before, None)])
        self.met = np.r_[self.met, np.zeros(len(self.known) - before, np.int64)] + (np.bincount(use, minlength=len(self.known)) > 0)
        # the pieces of simple words before those of the others, and the number of the word that each is in
        n, counts, others = len(plain), 1 + tailed, use[len(names):]
        first = np.cumsum(counts) - counts
        pieces = np.empty(int(counts.sum()), dtype=np.int64)
        pieces[first] = use[:n]
        pieces[first[tailed] + 1] = use[n:len(names)][np.asarray(tails.indices)]
        word = np.r_[np.repeat(np.arange(n), counts), n + np.cumsum(others == 0)]
        use = np.r_[pieces, others]
        held = np.bincount(word, weights=self.pieces.sizes[use], minlength=len(words)).astype(np.int64)
        flat, starts = self.pieces.take(use), np.cumsum(held) - held
        if odd:
            at = n + np.array(list(odd))
            held[at] = [len(i) for i in odd.values()]
            starts[at] = len(flat) + np.cumsum(held[at]) - held[at]
            flat = np.r_[flat, np.fromiter(chain.from_iterable(odd.values()), np.uint32)]
        place = np.argsort(np.argsort(~np.asarray(simple), kind="stable"), kind="stable")
        return flat, starts[place], held[place]

    def _spelled(self, piece: str) -> str:
        return piece if piece.isascii() and piece.isalpha() else piece.encode("utf-8").decode("latin-1").translate(self.byte_chars)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) behind one another, and the number of ids of each text."""
        words = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        flat, starts, sizes = self._encode(coded.dictionary)
        used = np.asarray(coded.indices)
        upto = np.r_[0, np.cumsum(sizes[used])]
        ends = np.r_[0, np.cumsum(np.asarray(pc.list_value_length(words)), dtype=np.int64)]
        return ragged(flat, starts[used], sizes[used]), np.diff(upto[ends])


@lru_cache(1)
def shared_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, which keeps from task to task what it has encoded."""
    return WordEncoder(path)


class _Ragged:
    """Lists of ids behind one another."""

    def __init__(self) -> None:
        self.flat, self.at, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, lists: list[list[int]]) -> None:
        self.extend(np.fromiter(chain.from_iterable(lists), dtype=np.uint32), np.fromiter(map(len, lists), dtype=np.int64, count=len(lists)))

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.at = np.r_[self.at, len(self.flat) + np.cumsum(sizes) - sizes]
        self.flat, self.sizes = np.r_[self.flat, flat], np.r_[self.sizes, sizes]

    def take(self, numbers: np.ndarray) -> np.ndarray:
        return ragged(self.flat, self.at[numbers], self.sizes[numbers])


# -- grammar -----------------------------------------------------------------


def compress(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """A block from the ids of its documents; pairs never reach across documents."""
    seq = ids.astype(np.int32)
    doc_end = np.zeros(len(seq), dtype=bool)
    doc_end[np.cumsum(sizes)[sizes > 0] - 1] = True
    first_rule = int(seq.max()) + 1 if len(seq) else 0
    left: list[int] = []
    right: list[int] = []
    for _ in range(MAX_ROUNDS):
        pairs, counts, places = _frequent_pairs(seq, doc_end)
        chosen = _compatible(pairs, counts, MAX_RULES - len(left))
        if not len(chosen):
            break
        new = np.full(len(pairs), -1, dtype=np.int32)
        new[chosen] = first_rule + len(left) + np.arange(len(chosen))
        left += (pairs[chosen] >> 32).tolist()
        right += (pairs[chosen] & 0xFFFFFFFF).tolist()
        before = len(seq)
        seq, doc_end = _replace(seq, doc_end, *places, new)
        if len(seq) > 0.98 * before:
            break
    lengths = np.ones(first_rule + len(left), dtype=np.int64)
    for i, (x, y) in enumerate(zip(left, right, strict=True), first_rule):
        lengths[i] = lengths[x] + lengths[y]
    ends = np.flatnonzero(doc_end) + 1
    starts = np.zeros(len(sizes) + 1, dtype=np.int64)
    starts[1:][sizes > 0] = ends
    starts = np.maximum.accumulate(starts)
    width = 2 if first_rule + len(left) <= 65536 else 4
    parts = [np.array(left), np.array(right), lengths[first_rule:], sizes, starts]
    return b"".join([struct.pack(_HEAD, b"RPID", 1, len(sizes), len(left), len(seq), first_rule, width),
                     *(p.astype("<u4").tobytes() for p in parts), seq.astype(f"<u{width}").tobytes()])


def _frequent_pairs(seq: np.ndarray, doc_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """Frequent pairs and their counts; and where they are: places, and the pair's number at each.

    Pairs fall into cells by a hash, and the fullest cells count.  In each of them the
    pair at its last place stands for the cell and is counted exactly; another pair of
    the cell has its turn when that one is replaced.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(seq) < 2:
        return none, none, (none, none)
    code = seq.astype(np.uint32)
    cell = (code[:-1] * np.uint32(0x9E3779B1) + code[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(32 - _CELL_BITS)
    cell[doc_end[:-1]] = 1 << _CELL_BITS
    held = np.bincount(cell, minlength=(1 << _CELL_BITS) + 1)[:-1]
    least = max(LEAST_COUNT, int(np.partition(held, -2 * ROUND_RULES)[-2 * ROUND_RULES]))
    fullest = np.flatnonzero(held >= least)
    number = np.full((1 << _CELL_BITS) + 1, -1, dtype=np.int32)
    number[fullest] = np.arange(len(fullest))
    of = number[cell]
    at = np.flatnonzero(of >= 0)
    of = of[at]
    last = np.zeros(len(fullest), dtype=np.int64)
    last[of] = at
    a, b = seq[last], seq[last + 1]
    same = (seq[at] == a[of]) & (seq[at + 1] == b[of])
    at, of = at[same], of[same]
    return a.astype(np.int64) << 32 | b, np.bincount(of, minlength=len(fullest)), (at, of)


def _compatible(pairs: np.ndarray, counts: np.ndarray, room: int) -> np.ndarray:
    """Numbers of the most frequent of these pairs whose places cannot overlap."""
    order = np.lexsort((pairs, -counts))[:2 * ROUND_RULES]
    order = order[counts[order] >= LEAST_COUNT]
    starts, ends, chosen = set(), set(), []
    for n, p in zip(order.tolist(), pairs[order].tolist(), strict=True):
        a, b = p >> 32, p & 0xFFFFFFFF
        if len(chosen) < min(ROUND_RULES, room) and a not in ends and b not in starts and (a != b or a not in starts):
            chosen.append(n)
            starts.add(a)
            ends.add(b)
    return np.array(chosen, dtype=np.int64)


def _replace(seq: np.ndarray, doc_end: np.ndarray, at: np.ndarray, of: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sequence with the pairs at these places replaced by their new symbols (-1: not replaced)."""
    symbol = new[of]
    place, symbol = at[symbol >= 0], symbol[symbol >= 0]
    # only a pair of equal symbols can follow itself at once: every second place
    run = np.r_[True, place[1:] != place[:-1] + 1]
    number = np.arange(len(place))
    even = (number - np.maximum.accumulate(np.where(run, number, 0))) % 2 == 0
    place, symbol = place[even], symbol[even]
    seq = seq.copy()
    seq[place] = symbol
    doc_end = doc_end.copy()
    doc_end[place] = doc_end[place + 1]
    keep = np.ones(len(seq), dtype=bool)
    keep[place + 1] = False
    return seq[keep], doc_end[keep]


class Block:
    """A stored block, decoded whole or in parts."""

    def __init__(self, data: bytes):
        magic, version, docs, rules, symbols, self.first_rule, width = struct.unpack_from(_HEAD, data)
        if magic != b"RPID" or version != 1:
            raise ValueError("not a block of token ids")
        take = np.frombuffer(data, "<u4", 3 * rules + 2 * docs + 1, struct.calcsize(_HEAD)).astype(np.int64)
        self.left, self.right, self.lengths, self.sizes, self.starts = np.split(take, [rules, 2 * rules, 3 * rules, 3 * rules + docs])
        self.seq = np.frombuffer(data, f"<u{width}", symbols, struct.calcsize(_HEAD) + 4 * len(take)).astype(np.int64)

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All rules expanded behind one another, after every plain id as itself; and where each begins."""
        size = np.r_[np.ones(self.first_rule, dtype=np.int64), self.lengths]
        at = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), dtype=np.uint32)
        out[:self.first_rule] = np.arange(self.first_rule)
        for i, (x, y) in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True), self.first_rule):
            lo, cut = at[i], at[i] + size[x]
            out[lo:cut] = out[at[x]:at[x] + size[x]]
            out[cut:lo + size[i]] = out[at[y]:at[y] + size[y]]
        return out, at

    def all_ids(self) -> np.ndarray:
        flat, at = self._expansions()
        size = np.r_[np.ones(self.first_rule, dtype=np.int64), self.lengths]
        return ragged(flat, at[self.seq], size[self.seq])

    def ids(self, doc: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids ``lo`` to ``hi`` of a document; the expansion lengths lead to them."""
        hi = int(self.sizes[doc]) if hi is None else min(hi, int(self.sizes[doc]))
        symbols = self.seq[self.starts[doc]:self.starts[doc + 1]]
        size = np.where(symbols < self.first_rule, 1, self.lengths[np.maximum(symbols - self.first_rule, 0)] if len(self.lengths) else 1)
        ends = np.cumsum(size)
        first = int(np.searchsorted(ends, lo, side="right"))
        at = int(ends[first - 1]) if first else 0
        out: list[int] = []
        stack: list[int] = []
        while at < hi and (stack or first < len(symbols)):
            if stack:
                s = stack.pop()
            else:
                s, first = int(symbols[first]), first + 1
            if s < self.first_rule:
                if at >= lo:
                    out.append(s)
                at += 1
            elif at + self.lengths[s - self.first_rule] <= lo:
                at += int(self.lengths[s - self.first_rule])  # skipped whole
            else:
                stack += [int(self.right[s - self.first_rule]), int(self.left[s - self.first_rule])]
        return np.array(out, dtype=np.uint32)


# -- files ---------------------------------------------------------------------


def write_shards(docs: DataFrame, tokenizer_path: str, name: str = "token-ids", end_id: int = END_ID) -> DataFrame:
    """Encode all documents into stored shards: shard, block, doc_ids, n_ids, data."""
    check_rules(tokenizer_path)
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = dict(base.dtypes)["doc_id"]
    ordered = base.repartitionByRange("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "text")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, number = shared_encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        held, doc_ids, sizes, count = [], [], [], 0
        doc_type = pa.int64()

        def block() -> pa.RecordBatch:
            data = compress(np.concatenate(held), np.array(sizes, dtype=np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([doc_ids], pa.list_(doc_type)),
                 pa.array([count], pa.int64()), pa.array([data], pa.binary())], names=["shard", "block", "doc_ids", "n_ids", "data"])

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for part in slices(batch, "text"):
                flat, lengths = encoder.ids(part.column("text"))
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), np.split(flat, np.cumsum(lengths)[:-1]), strict=True):
                    held += [ids, np.array([end_id], dtype=np.uint32)]
                    doc_ids.append(doc_id)
                    sizes.append(len(ids) + 1)
                    count += len(ids) + 1
                    if count >= BLOCK_IDS:
                        yield block()
                        number, count = number + 1, 0
                        held, doc_ids, sizes = [], [], []
        if sizes:
            yield block()

    return store(ordered.mapInArrow(encode, f"shard int, block int, doc_ids array<{kind}>, n_ids long, data binary"), name)


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document, from the stored blocks: doc_id, start, n_tokens, ids_crc32."""
    kind = dict(shards.dtypes)["doc_ids"][len("array<"):-1]

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, doc_ids, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "doc_ids", "data")), strict=True):
                stored = Block(data)
                ids = np.split(stored.all_ids().astype("<u4"), np.cumsum(stored.sizes)[:-1])
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, batch.schema.field("doc_ids").type.value_type), pa.array([shard] * n, pa.int32()),
                     pa.array([number] * n, pa.int32()), pa.array(np.cumsum(stored.sizes) - stored.sizes, pa.int64()),
                     pa.array(stored.sizes, pa.int64()), pa.array([zlib.crc32(i.tobytes()) for i in ids], pa.int64())],
                    names=["doc_id", "shard", "block", "inside", "n_tokens", "ids_crc32"])

    found = shards.select("shard", "block", "doc_ids", "data").mapInArrow(
        decode, f"doc_id {kind}, shard int, block int, inside long, n_tokens long, ids_crc32 long")
    return (found.join(block_starts(shards), ["shard", "block"])
            .select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "shard", "block"))


def block_starts(shards: DataFrame) -> DataFrame:
    """Ids before each block: blocks in their shard, shards in their group, groups; no window sees more than that."""
    before = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    group = (F.col("shard") / SHARD_GROUP).cast("int").alias("group")
    sizes = shards.select("shard", "block", "n_ids")
    blocks = sizes.withColumn("in_shard", before(Window.partitionBy("shard").orderBy("block")))
    shard_sizes = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).withColumn("group", group)
    in_group = shard_sizes.withColumn("in_group", before(Window.partitionBy("group").orderBy("shard")))
    groups = (sizes.groupBy(group).agg(F.sum("n_ids").alias("n_ids"))
              .withColumn("one", F.lit(1)).withColumn("base", before(Window.partitionBy("one").orderBy("group"))))
    return (blocks.join(in_group.select("shard", "group", "in_group"), "shard").join(groups.select("group", "base"), "group")
            .select("shard", "block", (F.col("base") + F.col("in_group") + F.col("in_shard")).alias("first")))


def token_ids(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    return read_documents(write_shards(docs, tokenizer_path))
