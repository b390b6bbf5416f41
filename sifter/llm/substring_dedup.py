"""Substring dedup with repeated-phrase automata (operator 7).

Every word covered by a 50-word window whose words also stand in a document
with a smaller doc_id is removed.

1. Anchors.  Of each window the least 16-word hash is its anchor; equal windows
   have equal anchors, and a document has few of them (one in 18 words).  An
   anchor seen in two documents recurs; only windows with a recurring anchor
   can recur.
2. Confirmed passages.  Documents are dealt into groups of bounded size; each
   group hashes its windows that have a recurring anchor, and the least
   doc_id of every window over all groups confirms it.  Runs of windows first
   seen in one document are cut out of it as passages.
3. Automata.  A passage goes to the groups that hold one of its windows.  Each
   group (a shard) compiles 25-word phrases of its passages into an
   Aho-Corasick automaton and streams its documents through it: each 50-word
   window of a passage holds a whole chosen phrase, so every occurrence is met,
   and is extended to both sides word by word.  What is removed rests on the words
   found, not on hashes.

Windows are judged on the input.  Defined results: words are the runs without
space, tab, line feed, vertical tab, form feed and carriage return; a null
or empty text has no words and the digest of the empty text; a null doc_id is
smaller than any other; rows with the same doc_id never remove each other's
words; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import lean, slices, store, utf8_of

WINDOW = 50
ANCHOR = 16
PHRASE = 25
#: Bytes of text in a group of documents.
GROUP_BYTES = 4 << 20
#: Distinct words a task remembers before it starts anew.
CACHE_WORDS = 300_000
_LEAST = -(2**63)
_BASE = 0x9E3779B97F4A7C15 | 1


def joined(text: str | None) -> bytes:
    """The words of a text joined by single spaces; ``bytes.split`` splits at space and 0x09-0x0D alone."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def words_of(text: str | None) -> list[str]:
    words = joined(text).decode("utf-8", "surrogatepass")
    return words.split(" ") if words else []


class _Hashes(dict):
    """Numbers words and keeps their 64-bit hashes."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class Hasher:
    """Rolling hashes of word sequences."""

    def __init__(self, longest: int = 1 << 16):
        self.known, self.hashes = _Hashes(), np.zeros(0, dtype=np.uint64)
        self._powers(longest)

    def _powers(self, n: int) -> None:
        base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 2**64))
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.r_[np.uint64(1), np.full(n, base)])
            self.back = np.cumprod(np.r_[np.uint64(1), np.full(n, inverse)])

    def words(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Hashes of the words of each text."""
        import xxhash

        if len(self.known) > CACHE_WORDS:
            self.known, self.hashes = _Hashes(), self.hashes[:0]
        number = self.known.__getitem__
        use = [np.fromiter(map(number, words), dtype=np.int64, count=len(words)) for words in texts]
        fresh = islice(self.known, len(self.hashes), None)
        self.hashes = np.r_[self.hashes, np.array([xxhash.xxh3_64_intdigest(w) for w in fresh], dtype=np.uint64)]
        longest = max(map(len, use), default=0)
        if longest >= len(self.power):
            self._powers(2 * longest)
        return [self.hashes[u] for u in use]

    def texts(self, texts: pa.Array) -> list[np.ndarray]:
        """Hashes of the words of each text (null: none), each distinct word of the batch hashed once."""
        import xxhash

        cut = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = cut.flatten().dictionary_encode()
        held = np.array([xxhash.xxh3_64_intdigest(w) for w in utf8_of(coded.dictionary)], dtype=np.uint64)
        ends, at = np.cumsum(np.asarray(pc.list_value_length(cut)), dtype=np.int64), np.asarray(coded.indices)
        blank = pc.index(coded.dictionary, "").as_py()  # before the first and behind the last white space
        if blank >= 0:
            real = at != blank
            ends, at = np.r_[0, np.cumsum(real)][ends], at[real]
        longest = int(np.diff(ends, prepend=0).max(initial=0))
        if longest >= len(self.power):
            self._powers(2 * longest)
        return np.split(held[at], ends[:-1])[:len(texts)]

    def rolled(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each place."""
        if len(hashes) < n:
            return hashes[:0]
        with np.errstate(over="ignore"):
            sums = np.r_[np.uint64(0), np.cumsum(hashes * self.power[:len(hashes)])]
            x = (sums[n:] - sums[:-n]) * self.back[:len(hashes) - n + 1]
            for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            return x ^ (x >> np.uint64(32))

    def anchors(self, hashes: np.ndarray) -> np.ndarray:
        """The least ANCHOR-word hash inside each window."""
        least, reach = self.rolled(hashes, ANCHOR), 1
        span = WINDOW - ANCHOR + 1
        if len(hashes) < WINDOW:
            return least[:0]
        while 2 * reach <= span:
            least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
        rest = span - reach
        return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def grouped(docs: DataFrame, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, doc (a long in its place), tag (of the text), grp and text; groups hold about ``group_bytes``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // group_bytes))
    tag = F.xxhash64("text")
    return docs.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("doc"), tag.alias("tag"),
        F.pmod(F.xxhash64("doc_id", tag), F.lit(groups)).cast("int").alias("grp"), "text")


def anchor_rows(rows: DataFrame) -> DataFrame:
    """Stored: the distinct anchors of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [np.unique(hasher.anchors(h)) for h in hasher.texts(part.column("text"))]
                sizes = [len(f) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), *(pa.array(np.repeat(np.asarray(part.column(c)), sizes)) for c in ("grp", "doc"))],
                    names=["anchor", "grp", "doc"])

    return store(rows.select("grp", "doc", "text").mapInArrow(lean(run), "anchor long, grp int, doc long"), "substring-anchors")


_ROW = "grp int, kind int, doc long, tag long, key long, text string"
Group = Callable[[pa.Table, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def by_group(side: DataFrame, docs: DataFrame, handle: Group, schema: str) -> DataFrame:
    """Stream the documents of each group past the side rows of the group.

    Both are dealt by group and sorted, side rows first; ``handle`` gets the side
    rows of a group as a table and its documents as a stream of batches.
    """
    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(batches)
        piece = next(pieces, None)
        while piece is not None:
            grp, sides = piece[0], []
            while piece is not None and piece[0] == grp and piece[1] == 0:
                sides.append(piece[2])
                piece = next(pieces, None)
            rest = [piece]

            def documents(rest=rest, grp=grp) -> Iterator[pa.RecordBatch]:
                while rest[0] is not None and rest[0][0] == grp:
                    yield rest[0][2]
                    rest[0] = next(pieces, None)

            left = documents()
            yield from handle(pa.Table.from_batches(sides) if sides else None, left)
            for _ in left:  # whatever the handler has not read
                pass
            piece = rest[0]

    names = [c.split()[0] for c in _ROW.split(", ")]

    def shaped(df: DataFrame, kind: int) -> DataFrame:
        kinds = dict(c.split() for c in _ROW.split(", "))
        have = df.withColumn("kind", F.lit(kind))
        return have.select(*(F.col(n).cast(kinds[n]) if n in have.columns else F.lit(None).cast(kinds[n]).alias(n) for n in names))

    both = shaped(side, 0).unionByName(shaped(docs, 1)).repartition("grp").sortWithinPartitions("grp", "kind")
    return both.mapInArrow(lean(stream), schema)


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Cut sorted batches where the group or the kind changes."""
    for batch in batches:
        for part in slices(batch, "text"):
            grp, kind = np.asarray(part.column("grp")), np.asarray(part.column("kind"))
            cuts = np.flatnonzero((np.diff(grp) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), part.num_rows], strict=True):
                yield int(grp[lo]), int(kind[lo]), part.slice(lo, hi - lo)


def _digest(words: list[str]) -> str:
    return hashlib.sha256(" ".join(words).encode("utf-8", "surrogatepass")).hexdigest()


def screen(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """Stored in two parts: 0, the windows with a recurring anchor, once per group; 1, the documents, with text where they have any."""
    recurring = anchors.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo < hi").select("anchor")
    need = anchors.join(recurring, "anchor").select("grp", F.col("anchor").alias("key")).distinct()

    def handle(side: pa.Table | None, docs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.sort(np.asarray(side.column("key")).view(np.uint64)) if side is not None else None
        hasher, held, grp = Hasher(), [], None
        for part in docs:
            grp = int(part.column("grp")[0].as_py())
            out = []
            ids, tags, texts = (part.column(c).to_pylist() for c in ("doc", "tag", "text"))
            for doc, tag, text, hashes in zip(ids, tags, texts, hasher.texts(part.column("text")), strict=True):
                hit = np.zeros(0, dtype=np.int64)
                if wanted is not None and len(hashes) >= WINDOW:
                    least = hasher.anchors(hashes)
                    at = np.minimum(np.searchsorted(wanted, least), len(wanted) - 1)
                    hit = np.flatnonzero(wanted[at] == least)
                    if len(hit):
                        held.append((hasher.rolled(hashes, WINDOW)[hit].view(np.int64), np.full(len(hit), doc), np.full(len(hit), tag), hit))
                out.append((doc, tag, len(hashes), None if len(hit) else hashlib.sha256(joined(text)).hexdigest(), text if len(hit) else None))
            columns = list(zip(*out, strict=True))
            yield _screened(grp, 1, key=None, doc=columns[0], tag=columns[1], pos=columns[2], last=None, digest=columns[3], text=columns[4])
        if held:
            key, doc, tag, pos = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((pos, tag, doc, key))
            key, doc, tag, pos = (x[order] for x in (key, doc, tag, pos))
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            last = np.maximum.reduceat(doc, first)
            # in the order of the documents, whose columns then take little room in files and shuffles
            by_doc = np.lexsort((pos[first], tag[first], doc[first]))
            first, last = first[by_doc], last[by_doc]
            yield _screened(grp, 0, key=key[first], doc=doc[first], tag=tag[first], pos=pos[first], last=last, digest=None, text=None)

    schema = "grp int, part int, key long, doc long, tag long, pos int, last long, digest string, text string"
    return store(by_group(need, rows, handle, schema), "substring-screened", ["part"])


def _screened(grp: int, part: int, **columns) -> pa.RecordBatch:
    n = len(columns["doc"])
    kinds = {"key": pa.int64(), "doc": pa.int64(), "tag": pa.int64(), "pos": pa.int32(), "last": pa.int64(), "digest": pa.string(), "text": pa.string()}
    made = [pa.nulls(n, k) if columns[c] is None else pa.array(columns[c], k) for c, k in kinds.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, grp, np.int32)), pa.array(np.full(n, part, np.int32)), *made],
                                      names=["grp", "part", *kinds])


def passages(screened: DataFrame) -> DataFrame:
    """Stored: passage (its id), first (doc of its first occurrence), text and the keys of its windows."""
    # a group has a window once, so nothing is gained by combining before the exchange, which would take the documents' order
    windows = screened.filter("part = 0").select("key", "doc", "tag", "pos", "grp", "last").repartition("key")
    confirmed = (windows.groupBy("key").agg(F.min(F.struct("doc", "tag", "pos", "grp")).alias("first"), F.max("last").alias("last"))
                 .filter("first.doc < last").select("key", "first.*"))
    side = confirmed.select("grp", "doc", "tag", (F.col("pos")).cast("string").alias("text"), "key")

    def handle(rows: pa.Table | None, docs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rows is None:
            return
        at = defaultdict(list)
        for doc, tag, pos, key in zip(*(rows.column(c).to_pylist() for c in ("doc", "tag", "text", "key")), strict=True):
            at[doc, tag].append((int(pos), key))
        for part in docs:
            out = []
            for doc, tag, text in zip(*(part.column(c).to_pylist() for c in ("doc", "tag", "text")), strict=True):
                found = sorted(at.pop((doc, tag), ()))  # a repeated row gives its passages once
                words = words_of(text) if found else []
                lo = 0
                for i in range(1, len(found) + 1):
                    if i == len(found) or found[i][0] != found[i - 1][0] + 1:
                        start, end = found[lo][0], found[i - 1][0] + WINDOW
                        out.append((hash((doc, tag, start)), doc, " ".join(words[start:end]), [k for _, k in found[lo:i]]))
                        lo = i
            if out:
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=["passage", "first", "text", "keys"])

    candidates = screened.filter("part = 1 AND text IS NOT NULL").select("grp", "doc", "tag", "text")
    return store(by_group(side, candidates, handle, "passage long, first long, text string, keys array<long>"), "substring-passages")


def choose_phrases(rarity: np.ndarray, n: int) -> list[int]:
    """Starts of phrases such that every window of ``n`` words holds one, the rare ones where there is a choice.

    ``rarity`` has the number of places of the phrase at each start.  Where near
    copies give many passages with the same words beside one changed word, the
    chosen phrases hold the changed word, so a document meets only the passages
    that it shares.
    """
    reach = WINDOW - PHRASE  # a window holds the phrases at this distance from its start
    starts, at = [], -1
    while at < n - WINDOW:
        span = rarity[at + 1:min(at + 1 + reach, len(rarity) - 1) + 1]
        at += len(span) - int(np.argmin(span[::-1]))  # the last of the rarest
        starts.append(at)
    return starts


def compile_phrases(found: list[tuple[int, list[str]]]):
    """Automaton over the phrases of (first, words) passages; a phrase leads to its places in them."""
    import ahocorasick

    hasher = Hasher()
    rolled = [hasher.rolled(h, PHRASE) for h in hasher.words([words for _, words in found])]
    if not rolled:
        return None
    _, which, count = np.unique(np.concatenate(rolled), return_inverse=True, return_counts=True)
    rarity = np.split(count[which], np.cumsum([len(r) for r in rolled])[:-1])
    places = defaultdict(list)
    for p, (_, words) in enumerate(found):
        for o in choose_phrases(rarity[p], len(words)):
            places[" " + " ".join(words[o:o + PHRASE]) + " "].append((p, o))
    automaton = ahocorasick.Automaton()
    for phrase, where in places.items():
        automaton.add_word(phrase, where)
    automaton.make_automaton()
    return automaton


def covered(automaton, found: list[tuple[int, list[str]]], doc: int, words: list[str]) -> np.ndarray:
    """Which words lie in an occurrence of WINDOW words or more of a passage first seen in a smaller doc."""
    cover = np.zeros(len(words), dtype=bool)
    ends = np.cumsum([len(w) + 1 for w in words])  # place of the space behind each word in " w1 w2 ... "
    done: dict[tuple[int, int], int] = {}
    for end, where in automaton.iter(" " + " ".join(words) + " "):
        at = int(np.searchsorted(ends, end)) - PHRASE + 1
        for p, o in where:
            first, passage = found[p]
            if first >= doc or done.get((p, at - o), 0) > at:
                continue
            lo, hi, n = at, at + PHRASE, at - o
            while lo > 0 and lo - n > 0 and words[lo - 1] == passage[lo - 1 - n]:
                lo -= 1
            while hi + PHRASE <= len(words) and hi - n + PHRASE <= len(passage) and words[hi:hi + PHRASE] == passage[hi - n:hi - n + PHRASE]:
                hi += PHRASE
            while hi < len(words) and hi - n < len(passage) and words[hi] == passage[hi - n]:
                hi += 1
            done[p, n] = hi
            if hi - lo >= WINDOW:
                cover[lo:hi] = True
    return cover


def locate(screened: DataFrame, found: DataFrame) -> DataFrame:
    """doc, tag, n_words, n_removed, kept_sha256 and the kept words of the documents that share an anchor."""
    windows = screened.filter("part = 0").select("key", "grp")
    keys = found.select("passage", F.explode("keys").alias("key"))
    routes = windows.join(keys, "key").select("grp", "passage").distinct()
    side = store(routes.join(found.select("passage", "first", "text"), "passage").select("grp", F.col("first").alias("doc"), "text"),
                 "substring-routes")  # so the windows' exchange is gone before the texts' begins

    def handle(rows: pa.Table | None, docs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [] if rows is None else [(d, t.split(" ")) for d, t in zip(rows.column("doc").to_pylist(), rows.column("text").to_pylist(), strict=True)]
        automaton = compile_phrases(known)
        for part in docs:
            out = []
            for doc, tag, text in zip(*(part.column(c).to_pylist() for c in ("doc", "tag", "text")), strict=True):
                words = words_of(text)
                gone = covered(automaton, known, doc, words) if automaton else np.zeros(len(words), dtype=bool)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                out.append((doc, tag, len(words), len(words) - len(kept), _digest(kept), " ".join(kept)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                             names=["doc", "tag", "n_words", "n_removed", "kept_sha256", "kept_text"])

    candidates = screened.filter("part = 1 AND text IS NOT NULL").select("grp", "doc", "tag", "text")
    return by_group(side, candidates, handle, "doc long, tag long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def substring_dedup(docs: DataFrame, group_bytes: int = GROUP_BYTES, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; with ``texts`` also kept_text of the documents that share passages."""
    rows = grouped(docs, group_bytes)
    screened = screen(rows, anchor_rows(rows))
    shared = locate(screened, passages(screened))
    alone = screened.filter("part = 1 AND text IS NULL").select(
        "doc", "tag", F.col("pos").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.col("digest").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text"))
    kind = dict(docs.dtypes)["doc_id"]
    doc_id = F.when(F.col("doc") != _LEAST, F.col("doc")).cast(kind).alias("doc_id")
    return shared.unionByName(alone).select(doc_id, "n_words", "n_removed", "kept_sha256", *(["kept_text"] if texts else []))
