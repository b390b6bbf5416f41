"""What tasks in Python hold at a time."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sifter.llm import bpe_codec, common, language_id, substring_dedup
from sifter.llm.common import SLICE_BYTES, lean, store


def test_tasks_of_a_stored_table_get_bounded_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], names=["n", "bytes"])

    texts = spark.range(0, 40, 1, 1).select(F.concat("id", F.repeat(F.lit("x"), 1 << 19)).alias("text"))  # 20 MB in one task
    rows = store(texts.mapInArrow(sizes, "n long, bytes long"), "test-batches").collect()
    assert sum(r.n for r in rows) == 40
    assert max(r.bytes for r in rows) < 2 * SLICE_BYTES


def test_a_task_gives_back_what_it_freed_once_it_has_ended(monkeypatch):
    told = []

    class Library:
        def malloc_trim(self, pad):
            told.append("trimmed")

    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: Library())
    for _ in lean(lambda batches: (told.append(b) or b for b in batches))(iter([1, 2])):
        pass
    assert told == [1, 2, "trimmed"]
    monkeypatch.setattr(common.ctypes, "CDLL", lambda name: object())  # no glibc
    assert list(lean(iter)([1, 2])) == [1, 2]


@pytest.mark.parametrize("texts", [["a b c", "", "one two  three\n four " * 9, "b"], [""], []])
def test_ids_put_together_in_steps_are_the_same(monkeypatch, texts):
    whole = bpe_codec.Encoder(public_tokenizers.path("byte_bpe_50k.json")).ids(texts)
    monkeypatch.setattr(bpe_codec, "GATHERED", 2)
    steps = bpe_codec.Encoder(public_tokenizers.path("byte_bpe_50k.json")).ids(texts)
    assert [x.tolist() for x in steps] == [x.tolist() for x in whole]
    assert steps[0].dtype == whole[0].dtype


def test_new_words_are_cut_into_n_grams_a_step_at_a_time(monkeypatch):
    weights = np.random.default_rng(0).normal(size=(language_id.DIMENSIONS + 1, 3)).astype(np.float32)
    model = lambda: language_id.Model(["de", "en"], ["g"], {"g": ["de", "en"]}, [("de", "en")], weights)
    counted = [["one", "two", "one"], [], ["three", "four", "five", "six"]]
    whole = model().scores(counted)
    most = []
    monkeypatch.setattr(language_id, "LOOKUP_SUMS", 6)
    monkeypatch.setattr(language_id.np, "fromiter", lambda of, real=np.fromiter, **k: most.append(k["count"]) or real(of, **k))
    assert model().scores(counted).tolist() == whole.tolist()
    assert max(most) <= 2 * len(language_id.word_grams("three"))


def test_tasks_of_substring_dedup_give_back_what_they_freed(spark, monkeypatch):
    leaned = []
    monkeypatch.setattr(substring_dedup, "lean", lambda run: leaned.append(run.__name__) or lean(run))
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(60))) for i in range(3)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in substring_dedup.substring_dedup(docs).collect()) == [(0, 0), (1, 60), (2, 60)]
    assert leaned == ["run", "stream", "stream", "stream"]
