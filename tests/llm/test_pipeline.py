"""The pipeline against its stages' brute-force versions, and the registered queries."""

import hashlib

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sifter.llm import catalog, language_id, minhash

from .messy import CLASHING, empty, messy
from .test_dedup import FOLD, near_groups

SMALL = "/root/testdata/sf0.001"


def test_the_pipeline_equals_its_stages_by_brute_force(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(docs)
    texts = {}
    for r in docs.collect():
        (lang, score), = model.predict([r.text])
        if lang != "und" and score >= language_id.LEAST_SCORE:
            texts[r.doc_id] = r.text
    last = {t.translate(FOLD): i for i, t in sorted(texts.items())}
    texts = {i: texts[i] for i in last.values()}
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    texts = {i: texts[i] for i, c, _ in near_groups(table, minhash.idf_table(table)) if i == c}
    squeeze = lambda t: " ".join("".join(c if c.isalnum() else " " for c in t.lower()).split())
    items = [squeeze(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    texts = {i: t for i, t in texts.items() if not any(x in squeeze(t) for x in items)}
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        assert got[i].ids == t.encode(text, add_special_tokens=False).ids
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("table", [messy, empty])
def test_stages_pass_the_columns_on(spark, table):
    docs = table(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns and kept.exceptAll(docs).isEmpty()
        docs = kept.cache()
    assert set(CLASHING) <= set(docs.columns)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count()


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in catalog.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "bpe_encode"]
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_exact_dedup_equals_its_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    want = con.execute(catalog.ORACLE_SQL["op4_exact_dedup"]).fetchall()
    got = catalog.QUERIES["op4_exact_dedup"](spark, SMALL).select("doc_id", "keep_id", "group_size", F.col("kept"), "text_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)
