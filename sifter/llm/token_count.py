"""Token counts with a BPE piece model (operator 2).

The pre-tokens of a batch that are new to the task are laid out as ragged
numpy arrays: one flat symbol array and the start of each sequence.  In every
round each sequence applies its own lowest-rank pair, all sequences at the same
time, until no pair is left; the surviving symbols are counted.  A pre-token
starts at a run of spaces or at a line end, places that no piece of the model
crosses (checked when the model is loaded; otherwise whole texts are one
pre-token), so the counts are those of the library for the whole text.

Defined results: a null or empty text has 0 tokens; repeated rows give repeated
rows; a null doc_id stays null; other input columns are ignored; an empty table
gives an empty result.  Texts of any length are counted whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import slices, texts_of

#: Distinct pre-tokens a task remembers before it starts anew.
CACHE_WORDS = 400_000
TOKEN_LIMIT = 4096
_NONE = np.int32(2**31 - 1)
_SPACE = "▁"


class PieceModel:
    """Merge table of a sentencepiece BPE model as sorted numpy arrays."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                usable[sp.id_to_piece(i)] = sp.get_score(i)
        scores = sorted(set(usable.values()), reverse=True)
        rank_of_score = {s: r for r, s in enumerate(scores)}
        symbols: dict[str, int] = {}
        for piece in usable:
            symbols.setdefault(piece, len(symbols))
            for ch in piece:
                symbols.setdefault(ch, len(symbols))
        keys, ranks, merged = [], [], []
        for piece, score in usable.items():
            for cut in range(1, len(piece)):
                a, b = piece[:cut], piece[cut:]
                if (cut == 1 or a in usable) and (len(b) == 1 or b in usable):
                    keys.append(symbols[a] << 32 | symbols[b])
                    ranks.append(rank_of_score[score])
                    merged.append(symbols[piece])
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.ranks = np.array(ranks, dtype=np.int32)[order]
        self.merged = np.array(merged, dtype=np.int32)[order]
        # all places of a pair may merge at once unless the new symbol takes part in a
        # pair of better or equal rank, or another pair ties with it
        own = np.full(len(symbols), _NONE, dtype=np.int32)
        own[self.merged] = self.ranks
        best = np.full(len(symbols), _NONE, dtype=np.int32)
        np.minimum.at(best, self.keys >> 32, self.ranks)
        np.minimum.at(best, self.keys & 0xFFFFFFFF, self.ranks)
        self.at_once = best > own
        # symbol of a character; characters outside the model fall back to their bytes
        self.symbol_of = np.full(0x110000, len(symbols), dtype=np.int32)
        codepoints = np.arange(0x110000)
        self.bytes_of = (1 + (codepoints > 0x7F) + (codepoints > 0x7FF) + (codepoints > 0xFFFF)).astype(np.int32)
        self.in_model = np.zeros(0x110000, dtype=bool)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
                self.in_model[ord(s)] = s in usable
        self.splits = not any(re.search(f"[^{_SPACE}]{_SPACE}|.\n|\n.", p, re.S) for p in usable)

    def rank(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; rank ``_NONE`` where the pair is no piece."""
        key = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        found = self.keys[at] == key
        return np.where(found, self.ranks[at], _NONE), self.merged[at]

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of a text; the space mark in front of plain words is left off."""
        if not self.splits:
            return [_SPACE * 2 + text.replace(" ", _SPACE)] if text else []
        if "  " in text or " \n" in text or _SPACE in text or text[:1] == " " or text[-1:] == " ":
            marked = _SPACE + text.replace(" ", _SPACE)
            return [_SPACE + p for p in re.findall(f"{_SPACE}+[^{_SPACE}\n]*|\n[^{_SPACE}\n]*", marked)]
        return text.replace("\n", " \n").split(" ") if text else []

    @staticmethod
    def spelled(token: str) -> str:
        """The characters that a pre-token stands for."""
        if token[:1] == _SPACE:
            return token[1:]
        return token if token[:1] == "\n" else _SPACE + token


def count_symbols(model: PieceModel, tokens: list[str]) -> np.ndarray:
    """Number of tokens of every pre-token, by rank-synchronous merging."""
    spelled = [model.spelled(t) for t in tokens]
    code = np.frombuffer("".join(spelled).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, spelled), dtype=np.int64, count=len(spelled))
    sym = model.symbol_of[code]
    weight = np.where(model.in_model[code], 1, model.bytes_of[code])
    seq = np.repeat(np.arange(len(tokens), dtype=np.int32), lengths)
    counts = np.zeros(len(tokens), dtype=np.int64)
    rank, merged = _adjacent(model, sym, seq)
    while len(sym):
        starts = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
        sizes = np.diff(np.r_[starts, len(seq)])
        least = np.minimum.reduceat(rank, starts)
        done = least == _NONE
        if done.any():  # sequences without a pair left are counted and leave the arrays
            counts[seq[starts[done]]] = np.add.reduceat(weight, starts)[done]
            stay = np.repeat(~done, sizes)
            sym, seq, weight, rank, merged = (x[stay] for x in (sym, seq, weight, rank, merged))
            continue
        hit = rank == np.repeat(least, sizes)
        at = np.flatnonzero(hit)
        first = np.r_[True, seq[at[1:]] != seq[at[:-1]]]
        # of places next to each other (a a a) every second one merges
        run = np.r_[True, at[1:] != at[:-1] + 1]
        place = np.arange(len(at))
        within = place - np.maximum.accumulate(np.where(run, place, 0))
        # ties between different pairs are settled from the left, one at a time
        same = merged[at] == np.repeat(merged[at[first]], np.diff(np.r_[np.flatnonzero(first), len(at)]))
        at = at[first | (same & model.at_once[merged[at]] & (within % 2 == 0))]
        sym[at] = merged[at]
        weight[at] = 1
        keep = np.ones(len(sym), dtype=bool)
        keep[at + 1] = False
        new_at = at - np.arange(len(at))
        sym, seq, weight, rank, merged = (x[keep] for x in (sym, seq, weight, rank, merged))
        touched = np.unique(np.r_[new_at, np.maximum(new_at - 1, 0)])
        rank[touched], merged[touched] = _adjacent(model, sym, seq, touched)
    return counts


def _adjacent(model: PieceModel, sym: np.ndarray, seq: np.ndarray, at: np.ndarray | None = None):
    """Rank and merged symbol of the pair that starts at every place (or those ``at``)."""
    at = np.arange(len(sym)) if at is None else at
    right = np.minimum(at + 1, len(sym) - 1)
    rank, merged = model.rank(sym[at], sym[right])
    inside = (at + 1 < len(sym)) & (seq[at] == seq[right])
    return np.where(inside, rank, _NONE).astype(np.int32), merged


def token_counts(docs: DataFrame, model_path: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every whole text."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel(model_path)
        known: dict[str, int] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                words = [model.pre_tokens(t) for t in texts_of(part)]
                if len(known) > CACHE_WORDS:
                    known.clear()
                fresh = list(set().union(*words).difference(known))
                known.update(zip(fresh, count_symbols(model, fresh).tolist(), strict=True))
                totals = [sum(map(known.__getitem__, w)) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(totals, pa.int64()),
                     pa.array([n > limit for n in totals], pa.bool_())],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    base = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = dict(base.dtypes)["doc_id"]
    return base.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
