"""BPE encoding and decoding through a pair occurrence index (operator 6).

A task collects the pre-tokens that it has not met before and encodes them
together.  An index maps every adjacent pair of symbols to all its positions;
a heap gives the active ranks in ascending order; the pair of the lowest rank
is merged at all its positions at once, and the lists of the pairs that
appear beside the merged places are extended.  Entries of pairs that a merge
destroyed are dropped when their list is read.

Defined results: a null or empty text has no ids and decodes to the empty
text; repeated rows give repeated rows; a null doc_id stays null; an empty
table gives an empty result.  Whole texts of any length are encoded.  The
string of the special token inside a text is that token, as in the library.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from sifter.llm.common import lean, ragged, slices, texts_of

#: Distinct chunks a task remembers before it starts anew.
CACHE_CHUNKS = 600_000
#: Chunks whose ids are put together at a time.
GATHERED = 1 << 16
#: Fixed value: the pre-token pattern that belongs to the byte-level vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_NO_RANK = np.int64(2**40)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class ByteBpe:
    """Vocabulary and merges of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        byte_char = byte_symbols()
        char_byte = {c: b for b, c in enumerate(byte_char)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.id_of_byte = np.array([vocab[c] for c in byte_char], dtype=np.int32)
        size = max([*vocab.values(), *self.special.values()]) + 1
        spelled = [b""] * size
        for token, i in [*vocab.items(), *self.special.items()]:
            spelled[i] = bytes(char_byte[c] for c in token)
        self.spelled_len = np.array([len(s) for s in spelled], dtype=np.int64)
        self.spelled_at = np.cumsum(self.spelled_len) - self.spelled_len
        self.spelled = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        self.left = (key >> 32).astype(np.int32)
        self.right = (key & 0xFFFFFFFF).astype(np.int32)
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]
        self.pattern = regex.compile(PRE_TOKEN)
        self.special_cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.blanks = [c for c in map(chr, range(0x3001)) if c != " " and regex.fullmatch(r"\s", c)]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], _NO_RANK)

    # -- encoding -----------------------------------------------------------

    def chunks(self, text: str) -> list[str]:
        """Cut a text where a pre-token surely begins, so that the chunks encode on their own.

        A single space between two other characters begins a pre-token; where
        white space stands next to a space the pattern cuts the text itself.
        A chunk is named by its characters after a space, or, where it begins
        with a space and a non-space, by the rest alone (see ``chars_of``).
        """
        if not text:
            return []
        if self.special_cut and any(s in text for s in self.special):
            return [c for piece in self.special_cut.split(text) if piece
                    for c in ([" " + piece] if piece in self.special else self._plain_chunks(piece))]
        return self._plain_chunks(text)

    def _plain_chunks(self, text: str) -> list[str]:
        beside = "  " in text or text[0] == " " or text[-1] == " "
        if beside or any(c in text and (c + " " in text or " " + c in text) for c in self.blanks):
            return [" " + p for p in self.pattern.findall(text)]
        found = text.split(" ")
        found[0] = " " + found[0]
        return found

    @staticmethod
    def chars_of(chunk: str) -> str:
        return chunk[1:] if chunk[0] == " " else " " + chunk

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks behind one another, and the number of ids of each chunk."""
        words: dict[str, int] = {}
        use: list[int] = []
        per_chunk = np.zeros(len(chunks), dtype=np.int64)
        for i, chunk in enumerate(map(self.chars_of, chunks)):
            parts = [chunk] if chunk in self.special else self.pattern.findall(chunk)
            per_chunk[i] = len(parts)
            use.extend([words.setdefault(p, len(words)) for p in parts])
        ids, sizes = self._merge_all(list(words))
        at = np.cumsum(sizes) - sizes
        used = np.array(use, dtype=np.int64)
        flat = ragged(ids, at[used], sizes[used])
        upto = np.r_[0, np.cumsum(sizes[used])]
        last = np.cumsum(per_chunk)
        return flat, upto[last] - upto[last - per_chunk]

    def _merge_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words behind one another, and the number of ids of each."""
        raw = [b"\0" if w in self.special else w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        sym = self.id_of_byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        n = len(sym)
        word = np.repeat(np.arange(len(raw)), sizes)
        first = np.cumsum(sizes) - sizes
        for i, w in enumerate(words):
            if w in self.special:
                sym[first[i]] = self.special[w]
        # linked list over the positions; n is the end, with a word of its own
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        before[0] = n
        word, sym = np.r_[word, -1], np.r_[sym, -1]
        alive = np.ones(n + 1, dtype=bool)
        occurs: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def extend(positions: np.ndarray) -> None:
            """Enter the pairs that start at these positions."""
            right = after[positions]
            positions, right = (x[word[positions] == word[right]] for x in (positions, right))
            rank = self.ranks(sym[positions], sym[right])
            positions, rank = positions[rank < _NO_RANK], rank[rank < _NO_RANK]
            by_rank = np.argsort(rank, kind="stable")
            positions, rank = positions[by_rank], rank[by_rank]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, group in zip(rank[np.r_[0, cuts]].tolist() if len(rank) else [], np.split(positions, cuts), strict=False):
                if r not in occurs:
                    occurs[r] = []
                    heapq.heappush(active, r)
                occurs[r].append(group)

        after[n] = n
        extend(np.arange(n))
        while active:
            r = heapq.heappop(active)
            lists = occurs.pop(r)
            at = lists[0] if len(lists) == 1 else _distinct(np.concatenate(lists))
            nxt = after[at]
            valid = alive[at] & (sym[at] == self.left[r]) & (sym[nxt] == self.right[r]) & (word[at] == word[nxt])
            at, nxt = at[valid], nxt[valid]
            if self.left[r] == self.right[r] and len(at) > 1:  # a a a: from the left, every second place
                run = np.r_[True, at[1:] != nxt[:-1]]
                place = np.arange(len(at))
                even = (place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0
                at, nxt = at[even], nxt[even]
            if not len(at):
                continue
            sym[at] = self.merged[r]
            alive[nxt] = False
            beyond = after[nxt]
            after[at] = beyond
            before[beyond] = at
            prev = before[at]
            extend(_distinct(np.concatenate([prev[prev < n], at])))
        alive[n] = False
        return sym[alive], np.bincount(word[alive], minlength=len(words))

    # -- decoding -----------------------------------------------------------

    def decode(self, ids: np.ndarray) -> str:
        data = ragged(self.spelled, self.spelled_at[ids], self.spelled_len[ids])
        return data.tobytes().decode("utf-8", "replace")


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]]


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class Encoder:
    """Encodes whole texts in a task, remembering the chunks it has met."""

    def __init__(self, path: str):
        self.bpe = ByteBpe(path)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.flat = np.zeros(0, dtype=np.int32)
        self.sizes = np.zeros(0, dtype=np.int64)

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind one another, and the number of ids of each text."""
        if len(self.known) > CACHE_CHUNKS:
            self._forget()
        number, before = self.known.__getitem__, len(self.known)
        use = [np.fromiter(map(number, c), dtype=np.int64, count=len(c)) for c in map(self.bpe.chunks, texts)]
        flat, sizes = self.bpe.encode(list(islice(self.known, before, None)))
        self.flat, self.sizes = np.r_[self.flat, flat.astype(np.int32)], np.r_[self.sizes, sizes]
        at = np.cumsum(self.sizes) - self.sizes
        per_text = np.fromiter(map(len, use), dtype=np.int64, count=len(use))
        used = np.concatenate([per_text[:0], *use])
        lengths = self.sizes[used]
        upto = np.r_[0, np.cumsum(lengths)]
        last = np.cumsum(per_text)
        flat = np.concatenate([self.flat[:0], *(ragged(self.flat, at[used[lo:lo + GATHERED]], lengths[lo:lo + GATHERED])
                                                for lo in range(0, len(used), GATHERED))])
        return flat, upto[last] - upto[last - per_text]


def encode_decode(docs: DataFrame, tokenizer_path: str, with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; on request the ids and the decoded text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        decimal = np.array([str(i) for i in range(len(encoder.bpe.spelled_len))], dtype=object)
        digest = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
        for batch in batches:
            for part in slices(batch, "text"):
                flat, sizes = encoder.ids(texts_of(part))
                ends = np.cumsum(sizes)
                ids = np.split(flat, ends[:-1])
                decoded = [encoder.bpe.decode(i) for i in ids]
                columns = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(sizes, pa.int64()),
                           "ids_sha256": pa.array([digest(",".join(decimal[i])) for i in ids], pa.string()),
                           "decoded_sha256": pa.array([digest(d) for d in decoded], pa.string())}
                if with_ids:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(flat, pa.int32()))
                if with_text:
                    columns["decoded"] = pa.array(decoded, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_text
    return docs.select("doc_id", "text").mapInArrow(lean(run), schema)
