"""SentencePiece encoding and decoding with source offsets (operator 11).

A text is normalised by the character map that is compiled into the model: at
every place the longest prefix that the map's trie holds is replaced, otherwise
one character is kept.  Each normalised character records how many bytes of the
source it stands for, so the running sum of these widths projects every piece
to the byte span of the original text, whatever the map rewrote, joined or
dropped.  The pieces come from merging, inside words that no piece of the model
crosses, the best-scored neighbours first (ties: from the left); a word that a
task has met before is looked up.

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated rows give repeated rows; a null doc_id stays null; other input columns
are ignored; an empty table gives an empty result.  Whole texts of any length
are encoded.  Models with other than BPE pieces, user-defined or unused pieces,
or without byte fallback are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sifter.llm.common import ragged, slices, texts_of

#: Characters of distinct words that a task remembers before it starts anew.
CACHE_CHARS = 8_000_000
#: Characters up to which words are merged together; longer ones by themselves.
SHORT_WORD = 64
_NO_RANK = np.int32(2**31 - 1)
_SPACE = "▁"
# Fixed values of the model format: numbers of its fields and piece types
_PIECES, _TRAINER, _NORMALIZER = 1, 2, 3
_MODEL_TYPE, _BYTE_FALLBACK, _BPE = 3, 35, 2
_CHAR_MAP, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE = 2, 3, 4, 5
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message; fixed-width values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if kind == 2 else 4 if kind == 5 else 8
            yield tag >> 3, data[at:at + size]
            at += size


# -- normalisation -------------------------------------------------------------


class CharMap:
    """The model's normaliser: a trie over UTF-8 bytes whose leaves name replacement strings."""

    def __init__(self, spec: bytes):
        found = dict(_fields(spec))
        self.dummy_prefix = bool(found.get(_DUMMY_PREFIX, 1))
        self.squeeze = bool(found.get(_EXTRA_SPACES, 1))
        self.space = _SPACE if found.get(_ESCAPE, 1) else " "
        blob = found.get(_CHAR_MAP, b"")
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.strings = blob[4 + size:]
        self._begins: dict[str, bool] = {}

    def _step(self, node: int, byte: int) -> tuple[int, int | None] | None:
        """Follow one byte: the next node and the replacement that ends there, or None."""
        node ^= byte
        unit = self.units[node] if node < len(self.units) else 0
        if unit & 0x800000FF != byte:
            return None
        node ^= unit >> 10 << ((unit & 0x200) >> 6)
        return node, self.units[node] & 0x7FFFFFFF if unit & 0x100 else None

    def longest(self, data: bytes, at: int) -> tuple[str, int] | None:
        """Replacement and length of the longest prefix of ``data[at:]`` in the map."""
        root = self.units[0]
        node, best = root >> 10 << ((root & 0x200) >> 6), None
        for i in range(at, len(data)):
            step = self._step(node, data[i])
            if step is None:
                break
            node, leaf = step
            if leaf is not None:
                best = leaf, i + 1 - at
        if best is None:
            return None
        return self.strings[best[0]:self.strings.index(b"\0", best[0])].decode("utf-8"), best[1]

    def _may_begin(self, char: str) -> bool:
        """Whether a rule of the map can begin with this character."""
        if char not in self._begins:
            root = self.units[0]
            node, found = root >> 10 << ((root & 0x200) >> 6), True
            for byte in char.encode("utf-8"):
                step = self._step(node, byte)
                if step is None:
                    found = False
                    break
                node = step[0]
            self._begins[char] = found
        return self._begins[char]

    def _mapped(self, text: str) -> tuple[str, np.ndarray, int]:
        """Characters after the map, the source bytes of each, and the bytes dropped before the first."""
        rare = {c for c in set(text) if self._may_begin(c)} if self.units else set()
        if not rare:
            return text, utf8_widths(text), 0
        out: list[str] = []
        widths: list[np.ndarray] = []
        lead, resume = 0, 0
        data = text.encode("utf-8")
        place = np.r_[0, np.cumsum(utf8_widths(text))]  # byte of every character

        def keep(lo: int, hi: int) -> None:
            out.append(text[lo:hi])
            widths.append(place[lo + 1:hi + 1] - place[lo:hi])

        for m in re.finditer("[" + "".join(map(re.escape, rare)) + "]", text):
            at = m.start()
            if at < resume:
                continue
            rule = self.longest(data, int(place[at]))
            if rule is None:
                continue
            keep(resume, at)
            resume = int(np.searchsorted(place, place[at] + rule[1]))
            if rule[0]:  # the source belongs to the last character of the replacement
                out.append(rule[0])
                widths.append(np.r_[np.zeros(len(rule[0]) - 1, np.int64), rule[1]])
            elif any(len(w) for w in widths):
                next(w for w in reversed(widths) if len(w))[-1] += rule[1]
            else:
                lead += rule[1]
        keep(resume, len(text))
        return "".join(out), np.concatenate(widths), lead

    def normalise(self, text: str) -> tuple[str, np.ndarray, int]:
        """Normalised text, source bytes of each of its characters, and the bytes before the first."""
        if not text:
            return "", np.zeros(0, np.int64), 0
        chars, widths, lead = self._mapped(text)
        if self.squeeze:
            chars, widths, lead = self._squeezed(chars, widths, lead)
            if not chars:
                return chars, widths, 0
        if self.dummy_prefix:
            chars, widths = " " + chars, np.r_[0, widths]
        return chars.replace(" ", self.space), widths, lead

    def _squeezed(self, chars: str, widths: np.ndarray, lead: int) -> tuple[str, np.ndarray, int]:
        """One space for a run of spaces, which gets the run's bytes; none at the ends (nor marks at the last)."""
        head = len(chars) - len(chars.lstrip(" "))
        tail = len(chars.rstrip(" " + self.space))
        lead += int(widths[:head].sum())
        chars, widths = chars[head:tail], widths[head:tail]
        if "  " not in chars:
            return chars, widths, lead
        code = np.frombuffer(chars.encode("utf-32-le"), dtype=np.uint32)
        blank = code == 32
        first = np.flatnonzero(np.r_[True, ~(blank[1:] & blank[:-1])])
        return code[first].tobytes().decode("utf-32-le"), np.add.reduceat(widths, first), lead


def utf8_widths(text: str) -> np.ndarray:
    """UTF-8 bytes of every character."""
    if text.isascii():
        return np.ones(len(text), dtype=np.int64)
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)


# -- pieces --------------------------------------------------------------------


class PieceModel:
    """Pieces of a sentencepiece BPE model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            parts = list(_fields(f.read()))
        trainer = dict(_fields(next(v for n, v in parts if n == _TRAINER)))
        if trainer.get(_MODEL_TYPE, 1) != _BPE or not trainer.get(_BYTE_FALLBACK, 0):
            raise ValueError("a BPE model with byte fallback is expected")
        self.char_map = CharMap(next((v for n, v in parts if n == _NORMALIZER), b""))
        self.spelled: list[str] = []
        self.score: dict[str, float] = {}
        self.id_of: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.byte_of: dict[int, int] = {}
        for i, piece in enumerate(v for n, v in parts if n == _PIECES):
            found = dict(_fields(piece))
            text, kind = found[1].decode("utf-8"), found.get(3, _NORMAL)
            if kind in (_USER_DEFINED, _UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
            if kind == _BYTE:
                self.byte_of[i] = int(text[3:5], 16)
                self.byte_id[self.byte_of[i]] = i
            self.spelled.append("" if kind in (_CONTROL, _UNKNOWN, _BYTE) else text)
            if kind == _NORMAL:
                self.id_of[text] = i
                self.score[text] = float(np.frombuffer(found.get(2, b"\0\0\0\0"), "<f4")[0])
        self._tables()
        # a text may be cut before a space mark and before a line end unless a piece reaches across
        self.cuts = self.char_map.space == _SPACE and not any(
            re.search(f"[^{_SPACE}]{_SPACE}|.\n|\n.", p, re.S) for p in self.id_of)
        self.word = re.compile(f"{_SPACE}+[^{_SPACE}\n]*|\n[^{_SPACE}\n]*|[^{_SPACE}\n]+")

    def words(self, chars: str) -> list[str]:
        return self.word.findall(chars) if self.cuts else [chars] if chars else []

    def _tables(self) -> None:
        """Symbols (pieces and their characters) by number, and the pairs that make a piece, as sorted arrays."""
        symbols = {s: n for n, s in enumerate(self.id_of)}
        for c in sorted(set("".join(self.id_of))):
            symbols.setdefault(c, len(symbols))
        self.symbols = symbols
        ranks = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        found = [(symbols[p[:cut]] << 32 | symbols[p[cut:]], ranks[s], symbols[p]) for p, s in self.score.items()
                 for cut in range(1, len(p)) if p[:cut] in symbols and p[cut:] in symbols]
        table = np.array(sorted(found), dtype=np.int64).reshape(-1, 3)
        self.pair, self.rank, self.into = table[:, 0].copy(), table[:, 1].astype(np.int32), table[:, 2].astype(np.int32)
        # characters without a symbol are numbered behind the symbols, by code point
        self.symbol_of = np.arange(0x110000, dtype=np.int32) + len(symbols)
        self.symbol_of[[ord(s) for s in symbols if len(s) == 1]] = [n for s, n in symbols.items() if len(s) == 1]
        self.piece_of = np.array([self.id_of.get(s, -1) for s in symbols], dtype=np.int32)
        self.chars_of = np.array([len(s) for s in symbols], dtype=np.int32)
        self.code_of = np.array([ord(s[0]) for s in symbols], dtype=np.int32)
        raw = [bytes([self.byte_of[i]]) if i in self.byte_of else s.encode("utf-8") for i, s in enumerate(self.spelled)]
        self.raw_size = np.array(list(map(len, raw)), dtype=np.int64)
        self.raw_at = np.cumsum(self.raw_size) - self.raw_size
        self.raw = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.byte_ids = np.array(self.byte_id, dtype=np.int32)

    def _pairs(self, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pairs that begin at these places, ``_NO_RANK`` for none, and the symbols they make."""
        right = np.minimum(at + 1, len(sym) - 1)
        key = sym[at].astype(np.int64) << 32 | sym[right]
        place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        good = (self.pair[place] == key) & (word[at] == word[right]) & (right > at)
        return np.where(good, self.rank[place], _NO_RANK), self.into[place]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words behind one another, the characters each stands for, and the number of ids per word.

        Of a character that falls back to its bytes the last byte has the character.
        """
        short = [w if len(w) <= SHORT_WORD else "" for w in words]
        sym = self.symbol_of[np.frombuffer("".join(short).encode("utf-32-le"), dtype=np.uint32)]
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, short), np.int64, len(short)))
        ready = [self._merged(sym, word)]
        for i, w in enumerate(words):
            if len(w) > SHORT_WORD:
                left = [self.symbols[s] if s in self.symbols else len(self.symbols) + ord(s) for s in self._merged_long(w)]
                ready.append((np.array(left, dtype=np.int32), np.full(len(left), i)))
        sym, word = (np.concatenate(parts) for parts in zip(*ready, strict=True))
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        known = np.minimum(sym, len(self.symbols) - 1)
        outside = sym >= len(self.symbols)
        ids = np.where(outside, -1, self.piece_of[known])
        code = np.where(outside, sym - len(self.symbols), self.code_of[known])
        chars = np.where(ids < 0, 1, self.chars_of[known])
        several = np.where(ids < 0, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), 1)
        if (ids < 0).any():
            ids, chars = self._fall_back(ids, chars, code, several)
        return ids.astype(np.int32), chars.astype(np.int32), np.bincount(word, weights=several, minlength=len(words)).astype(np.int64)

    def _fall_back(self, ids: np.ndarray, chars: np.ndarray, code: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of bytes in place of characters without a piece."""
        end = np.cumsum(several)
        lost = np.flatnonzero(ids < 0)
        raw = np.frombuffer(code[lost].astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), dtype=np.uint8)
        spread, shown = np.repeat(ids, several), np.zeros(int(end[-1]), dtype=chars.dtype)
        spread[spread < 0] = self.byte_ids[raw]
        shown[end - 1] = chars
        return spread, shown

    def _merged(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols left, with their words, when in every round each word has merged the leftmost of its best pairs."""
        rank, into = self._pairs(sym, word, np.arange(len(sym)))
        ready = [(sym[:0], word[:0])]
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[first, len(word)])
            best = np.minimum.reduceat(rank, first)
            if (best == _NO_RANK).any():  # words without a pair are ready
                stay = np.repeat(best < _NO_RANK, sizes)
                ready.append((sym[~stay], word[~stay]))
                sym, word, rank, into = (v[stay] for v in (sym, word, rank, into))
                continue
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            at = at[np.r_[True, word[at[1:]] != word[at[:-1]]]]
            sym[at] = into[at]
            stay = np.ones(len(sym), dtype=bool)
            stay[at + 1] = False
            sym, word, rank, into = (v[stay] for v in (sym, word, rank, into))
            at -= np.arange(len(at))
            beside = np.concatenate([at, at[at > 0] - 1])
            rank[beside], into[beside] = self._pairs(sym, word, beside)
        return tuple(np.concatenate(parts) for parts in zip(*ready, strict=True))

    def _merged_long(self, word: str) -> list[str]:
        """The same for one word of any length, with a queue of pairs."""
        symbols, score = list(word), self.score.get
        after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        queue: list[tuple[float, int, str]] = []

        def enter(left: int) -> None:
            pair = symbols[left] + symbols[after[left]]
            s = score(pair)
            if s is not None:
                heapq.heappush(queue, (-s, left, pair))

        for i in range(len(word) - 1):
            enter(i)
        while queue:
            _, left, pair = heapq.heappop(queue)
            right = after[left]
            if not symbols[left] or right >= len(word) or symbols[left] + symbols[right] != pair:
                continue  # one of the two was merged elsewhere
            symbols[left], symbols[right] = pair, ""
            beyond = after[left] = after[right]
            if beyond < len(word):
                before[beyond] = left
                enter(left)
            if before[left] >= 0:
                enter(before[left])
        return [s for s in symbols if s]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; runs of byte pieces are read as UTF-8."""
        out: list[str] = []
        raw = bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(raw.decode("utf-8", "replace"))
                raw.clear()
            out.append(self.spelled[i])
        out.append(raw.decode("utf-8", "replace"))
        return self.plain("".join(out))

    def plain(self, spelled: str) -> str:
        """Spelled pieces as text: without the prefix that normalisation added, marks as spaces."""
        if self.char_map.squeeze:
            spelled = spelled.lstrip(_SPACE)
        elif self.char_map.dummy_prefix and spelled[:1] == _SPACE:
            spelled = spelled[1:]
        return spelled.replace(_SPACE, " ")


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class Encoder:
    """Encodes whole texts in a task; the words it has met are kept encoded."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self._forget()

    def _forget(self) -> None:
        self.known, self.held = _Numbers(), 0
        self.decimals: list[str] = []
        self.spelled: list[str] = []
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)
        self.chars = np.zeros(0, np.int32)

    def encode(self, texts: list[str]) -> list[Encoded]:
        if self.held > CACHE_CHARS:
            self._forget()
        normal = [self.model.char_map.normalise(t) for t in texts]
        number, before = self.known.__getitem__, len(self.known)
        used = [list(map(number, self.model.words(chars))) for chars, _, _ in normal]
        fresh = list(islice(self.known, before, None))
        self.held += sum(map(len, fresh))
        if fresh:
            self._learn(*self.model.encode(fresh))
        sizes, starts = self.sizes, np.cumsum(self.sizes) - self.sizes
        return [Encoded(self, np.array(u, dtype=np.int64), starts, sizes, widths, lead)
                for u, (_, widths, lead) in zip(used, normal, strict=True)]

    def _learn(self, ids: np.ndarray, chars: np.ndarray, sizes: np.ndarray) -> None:
        """Keep the ids of new words, in decimals, and what they spell (bytes of whole characters read as those)."""
        model, ends = self.model, np.cumsum(sizes)
        decimal, raw = list(map(str, ids.tolist())), ragged(model.raw, model.raw_at[ids], model.raw_size[ids]).tobytes()
        upto = np.r_[0, np.cumsum(model.raw_size[ids])]
        lo = 0
        for hi, begin, end in zip(ends.tolist(), upto[ends - sizes].tolist(), upto[ends].tolist(), strict=True):
            self.decimals.append(",".join(decimal[lo:hi]))
            self.spelled.append(raw[begin:end].decode("utf-8", "replace"))
            lo = hi
        self.ids, self.chars, self.sizes = np.r_[self.ids, ids], np.r_[self.chars, chars], np.r_[self.sizes, sizes]


class Encoded:
    """The pieces of one text."""

    def __init__(self, encoder: Encoder, words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, widths: np.ndarray, lead: int):
        self.encoder, self.words, self.starts, self.sizes = encoder, words, starts, sizes
        self.widths, self.lead = widths, lead

    @property
    def n_tokens(self) -> int:
        return int(self.sizes[self.words].sum())

    def ids(self) -> np.ndarray:
        return ragged(self.encoder.ids, self.starts[self.words], self.sizes[self.words])

    def decimals(self) -> str:
        return ",".join([self.encoder.decimals[w] for w in self.words.tolist()])

    def decoded(self) -> str:
        """Text of the ids; a word begins at a space mark or a line end, so words are read one by one."""
        return self.encoder.model.plain("".join([self.encoder.spelled[w] for w in self.words.tolist()]))

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte of every piece in the original text, and the byte after its last."""
        chars = ragged(self.encoder.chars, self.starts[self.words], self.sizes[self.words])
        source = self.lead + np.r_[0, np.cumsum(self.widths)]
        upto = np.cumsum(chars, dtype=np.int64)
        return source[upto - chars], source[upto]


# -- job -----------------------------------------------------------------------


def encode_decode(docs: DataFrame, model_path: str, with_pieces: bool = False, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, spans_crc32 of every whole text.

    ``spans_crc32`` is the crc32 of all piece starts followed by all piece ends, as
    little-endian 64-bit integers.  On request the ids with their byte spans in the
    text (``ids``, ``starts``, ``ends``) and the decoded text.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path)
        digest = lambda s: hashlib.sha256(s.encode("utf-8", "replace")).hexdigest()
        for batch in batches:
            for part in slices(batch, "text"):
                found = encoder.encode(texts_of(part))
                spans = [e.spans() for e in found]
                decoded = [e.decoded() for e in found]
                columns = {
                    "doc_id": part.column("doc_id"), "n_tokens": pa.array([e.n_tokens for e in found], pa.int64()),
                    "ids_sha256": pa.array([digest(e.decimals()) for e in found], pa.string()),
                    "decoded_sha256": pa.array(map(digest, decoded), pa.string()),
                    "spans_crc32": pa.array([zlib.crc32(b.astype("<i8").tobytes(), zlib.crc32(a.astype("<i8").tobytes()))
                                             for a, b in spans], pa.int64())}
                if with_pieces:
                    columns["ids"] = pa.array([e.ids() for e in found], pa.list_(pa.int32()))
                    columns["starts"] = pa.array([a for a, _ in spans], pa.list_(pa.int64()))
                    columns["ends"] = pa.array([b for _, b in spans], pa.list_(pa.int64()))
                if with_text:
                    columns["decoded"] = pa.array(decoded, pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_crc32 long"
    schema += ", ids array<int>, starts array<long>, ends array<long>" * with_pieces + ", decoded string" * with_text
    return docs.select("doc_id", "text").mapInArrow(run, schema)
