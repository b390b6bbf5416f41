"""Token counts, token ids and the BPE codec against the tokenizer libraries."""

import hashlib
import json
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex

from sifter.llm import bpe_codec, token_count, token_ids

from .messy import collected, empty, messy, rows, small

PIECES = ["a", "b", " ", "  ", "\n", "é", "日", "🎉", "▁", "the ", "ing", "<s>", "<0x41>", "<|endoftext|>", "'s", "'LL", "1", "\t", "\0",
          "　", "aaaa", "==", "-----", "\r\n", "\x85", "\x1c", "\xa0", "´", "́", "é", "Σ", "İ", "ß", "ﬁ"]


def fuzz(n=3000):
    rng = random.Random(3)
    made = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return [*made, "a" * 3000, " " * 500, "=-" * 200 + "-" * 500, "日本" * 300]


@pytest.fixture(scope="module")
def sp():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_piece_counts_equal_the_library(sp):
    model = token_count.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))
    texts = fuzz()
    words = [model.pre_tokens(t) for t in texts]
    known = list(set().union(*words))
    count = dict(zip(known, token_count.count_symbols(model, known).tolist(), strict=True))
    assert [sum(count[w] for w in ws) for ws in words] == [len(i) for i in sp.encode(texts, num_threads=1)]


def test_token_counts_on_messy_rows(spark, sp):
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = collected(token_count.token_counts(messy(spark), path, limit=500))
    want = sorted(((i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 500) for i, t, *_ in rows()), key=repr)
    assert got == want
    assert token_count.token_counts(empty(spark), path).count() == 0


def test_codec_equals_the_library():
    t, encoder = library("byte_bpe_50k.json"), bpe_codec.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = fuzz()
    flat, sizes = encoder.ids(texts)
    for text, ids, want in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids, text
        assert encoder.bpe.decode(ids) == t.decode(want.ids, skip_special_tokens=False)


def test_merges_come_after_their_parts():
    bpe = bpe_codec.ByteBpe(public_tokenizers.path("byte_bpe_50k.json"))
    made = {int(z): r for r, z in enumerate(bpe.merged)}
    assert all(made.get(int(a), -1) < r and made.get(int(b), -1) < r for r, (a, b) in enumerate(zip(bpe.left, bpe.right, strict=True)))


def test_encode_decode_on_messy_rows(spark):
    t, path = library("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.json")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, text, *_ in rows():
        ids = t.encode(text or "", add_special_tokens=False).ids
        decoded = t.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(decoded), ids, decoded))
    assert collected(bpe_codec.encode_decode(messy(spark), path, with_ids=True, with_text=True)) == sorted(want, key=repr)
    assert bpe_codec.encode_decode(empty(spark), path, with_ids=True).count() == 0


def test_word_ids_equal_the_library():
    t, encoder = library("word_bpe_49k.json"), token_ids.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = fuzz()
    flat, sizes = encoder.ids(pa.array(texts))
    for text, ids, want in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids, text


def test_simple_words_are_not_searched_for_pieces():
    t, encoder = library("word_bpe_49k.json"), token_ids.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    searched, pattern = [], encoder.pattern

    class Pattern:
        def findall(self, text):
            searched.append(text)
            return pattern.findall(text)

    encoder.pattern = Pattern()
    texts = ["Plain words,  DON'T x2 plain.\"", "", None, " <s>É\u0301 straße...\tüber\nΑΣ end<s> İx ŉ. ÇPA!!", "only] letters.%% Ёж, Straße. [x] ÀÉ", ".", "a\\ b- c^ d_e d_ e'"]
    for _ in range(2):
        flat, sizes = encoder.ids(pa.array(texts))
        want = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
        assert [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])] == want
    assert not {"plain", "plain.\"", "words,", "çpa!!", "only]", "letters.%%", "ёж,", "straße.", "àé", "a\\"} & set(" ".join(searched).split())
    assert "don't" in searched[0]


def test_letters_of_simple_words_are_pieces_as_they_are():
    letter = regex.compile(f"[{token_ids.LETTERS}]")
    found = [c for c in map(chr, range(0x110000)) if letter.match(c)]
    assert len(found) > 700
    for c in found:
        assert regex.fullmatch(r"\p{L}", c) and regex.fullmatch(r"\p{L}", c.lower()) and unicodedata.is_normalized("NFC", c), c
    t, encoder = library("word_bpe_49k.json"), token_ids.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [" ".join(found), "".join(found), "".join(reversed(found)), *(f"{c}{c}{s} {s}{c}" for c, s in zip(found, token_ids._SIGNS * 40))]
    flat, sizes = encoder.ids(pa.array(texts))
    for text, ids, want in zip(texts, np.split(flat, np.cumsum(sizes)[:-1]), t.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids, text


@pytest.mark.parametrize("sizes", [[0, 5, 0, 4000, 1, 0], [3], [0, 0], [9000, 9000]])
def test_blocks_decode_whole_and_in_parts(sizes):
    rng = np.random.default_rng(1)
    ids = rng.zipf(1.3, sum(sizes)).clip(0, 300).astype(np.uint32)
    ids[: sum(sizes) // 3] = 7  # runs of one id
    block = token_ids.Block(token_ids.compress(ids, np.array(sizes)))
    assert np.array_equal(block.all_ids(), ids)
    if sum(sizes) > 1000:
        assert len(block.left) and len(block.seq) < len(ids)
    for d, (lo, n) in enumerate(zip(np.cumsum(sizes) - sizes, sizes, strict=True)):
        assert block.ids(d).tolist() == ids[lo:lo + n].tolist()
        assert block.ids(d, n // 3, n // 2).tolist() == ids[lo + n // 3:lo + n // 2].tolist()


def check_ids(found, given):
    t = library("word_bpe_49k.json")
    found = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in given), key=lambda i: (i is not None, i or 0))
    want = sorted((str(i), len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                  for i, x in ((i, [*t.encode(text or "", add_special_tokens=False).ids, 2]) for i, text in given))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in found) == want
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]


def test_token_ids_are_read_back(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    check_ids(token_ids.token_ids(messy(spark), path).collect(), [r[:2] for r in rows()])
    check_ids(token_ids.token_ids(small(spark), path).collect(), [(r.doc_id, r.text) for r in small(spark).collect()])
    assert token_ids.token_ids(empty(spark), path).count() == 0


def test_files_with_other_rules_are_refused(tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    spec["normalizer"] = None
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError, match="other rules"):
        token_ids.check_rules(str(path))


def test_pieces_are_kept_from_task_to_task(monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    t, encoder = library("word_bpe_49k.json"), token_ids.shared_encoder(path)
    assert token_ids.shared_encoder(path) is encoder
    monkeypatch.setattr(token_ids, "CACHE_PIECES", 40)
    made = fuzz(400)
    for lo in range(0, len(made), 20):  # the full cache keeps what recurs, and numbers it anew
        part = made[lo:lo + 20]
        flat, sizes = encoder.ids(pa.array(part))
        assert flat.tolist() == [i for x in part for i in t.encode(x, add_special_tokens=False).ids]
        assert sizes.sum() == len(flat) and len(encoder.known) == len(encoder.pieces.sizes) == len(encoder.met)
    token_ids.shared_encoder.cache_clear()
