"""SentencePiece codec: ids, decoding, normalisation and byte spans against the library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from sifter.llm import piece_codec

from .messy import collected, empty, messy, rows
from .test_tokens import fuzz

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_ids_text_and_spans_equal_the_library(sp):
    encoder, texts = piece_codec.Encoder(PATH), fuzz()
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        want = sp.encode(text)
        assert found.ids().tolist() == want and found.n_tokens == len(want), text
        assert found.decoded() == encoder.model.decode(want) == sp.decode(want), text
        starts, ends = found.spans()
        assert [(p.begin, p.end) for p in sp.encode(text, return_type="proto").pieces] == list(zip(starts.tolist(), ends.tolist(), strict=True))


def test_short_and_long_words_merge_alike(monkeypatch):
    model, rng = piece_codec.PieceModel(PATH), random.Random(4)
    words = ["".join(rng.choice(["a", "aa", "ing", "==", "-", "th", "é", "日", "\U0001FAE0"]) for _ in range(rng.randint(1, 20))) for _ in range(300)]
    found = [part.tolist() for part in model.encode(words)]
    monkeypatch.setattr(piece_codec, "SHORT_WORD", 0)
    assert found == [part.tolist() for part in model.encode(words)]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_compiled_character_maps(rule, squeeze, prefix):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    char_map, rng = piece_codec.CharMap(library.serialized_normalizer_spec()), random.Random(6)
    for _ in range(300):
        text = "".join(rng.choices("aＡﬁ１  \t　ééßA 字ｶﾞ​\0가각ᄀ½㌀.▁", k=rng.randint(0, 14)))
        chars, widths, lead = char_map.normalise(text)
        want, offsets = library.normalize(text, with_offsets=True)
        assert chars == want
        if want:
            byte = np.r_[0, np.cumsum(piece_codec.utf8_widths(text))]
            assert (lead + np.r_[0, np.cumsum(widths)]).tolist() == byte[offsets].tolist(), text


def test_cache_starts_anew(sp, monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHE_CHARS", 10)
    encoder = piece_codec.Encoder(PATH)
    for text in ("some words here", "other words there", "some words here"):
        assert encoder.encode([text])[0].ids().tolist() == sp.encode(text)
        assert encoder.held <= 20


def test_messy_rows(spark, sp):
    def expected(t):
        ids = sp.encode(t or "")
        pieces = sp.encode(t or "", return_type="proto").pieces
        starts, ends = ([getattr(p, side) for p in pieces] for side in ("begin", "end"))
        spans = np.array(starts + ends, dtype="<i8").tobytes()
        text = sp.decode(ids)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return len(ids), digest(",".join(map(str, ids))), digest(text), zlib.crc32(spans), ids, starts, ends, text

    got = piece_codec.encode_decode(messy(spark), PATH, with_pieces=True, with_text=True)
    assert collected(got) == sorted(((i, *expected(t)) for i, t, *_ in rows()), key=repr)
    assert piece_codec.encode_decode(empty(spark), PATH).count() == 0
