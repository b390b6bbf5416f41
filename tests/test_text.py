"""Golden HTML → text → token cases, traced by hand through the reference's parser."""

import pytest
from pyspark.sql import functions as F

from sifter.functions import text as tx
from sifter.operators import index as ix

CASES = [
    # name, html, text, tokens, is_document
    ("plain", "<html><body class=x>Hello, <b>World</b></body></html>", "hello, world ", ["hello", "world"], True),
    ("nobody", "<html><p>x</p></html>", "", [], False),
    ("empty", "<body></body>", "", [], False),
    ("tagsonly", "<body><p></p></body>", " ", [], True),
    ("commentonly", "<body><!-- a --></body>", "", [], False),
    ("mlcomment", "<body>a<!-- x\n > y -->b</body>", "a y -->b", ["a", "y", "b"], True),
    ("nest", "<BODY>a<SCRIPT>1<2</script>b<style>p</STYLE>c</BODY>", "abc", ["abc"], True),
    ("ent", "<body>a&lt;b &amp;lt; it&#39;s x&nbsp;y don't 3.14 É</body>",
     "a<b &lt; it&#39;s x&nbsp;y don't 3.14 É", ["ab", "lt", "it39s", "xnbspy", "dont", "314", "É"], True),
    ("twobody", "<body>a</body><body>b</body>", "a", ["a"], True),
    ("jointag", "<body>a<b>b</b>c</body>", "a b c", ["a", "b", "c"], True),
    ("space", "<body>\t a\n\n b \x0b c</body>", " a b c", ["a", "b", "c"], True),
]


@pytest.fixture(scope="module")
def golden(spark):
    df = spark.createDataFrame([(c[0], c[1]) for c in CASES], "url string, html string")
    out = df.select("url", tx.html_to_text("html").alias("text")).select(
        "url", "text", tx.tokenize("text").alias("tokens")).collect()
    return {r.url: r for r in out}


@pytest.mark.parametrize("case", CASES, ids=[c[0] for c in CASES])
def test_text_and_tokens(golden, case):
    name, _, text, tokens, _ = case
    assert golden[name].text == text
    assert golden[name].tokens == tokens


def test_indexable_and_document_stats(spark):
    df = spark.createDataFrame([(c[0], c[1]) for c in CASES], "url string, html string")
    docs = {r.url for r in ix.indexable_documents(df).collect()}
    assert docs == {c[0] for c in CASES if c[4]}
    fwd = {r.url: r for r in ix.forward_from_pages(df).collect()}
    assert set(fwd) == docs
    assert fwd["tagsonly"].total_terms == 0 and fwd["tagsonly"].terms == []
    assert fwd["ent"].term_count == 7 and fwd["ent"].total_terms == 7


def test_ascii_lower_keeps_non_ascii(spark):
    r = spark.range(1).select(tx.ascii_lower(F.lit("ÉCOLE Été")).alias("x")).first()
    assert r.x == "École Été"


def test_term_counts_match_explode_groupby(spark):
    texts = ["b a b c a b", "", "x", "z z z z"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    fwd = ix.forward_index(df.select(F.col("id").cast("string").alias("url"), "text"))
    got = {(r.url, r.term, r.frequency) for r in ix.term_frequency(fwd).collect()}
    want = set()
    for i, t in enumerate(texts):
        for w in set(t.split()):
            want.add((str(i), w, t.split().count(w)))
    assert got == want


def test_query_tokens_keep_case_and_punctuation(spark):
    r = spark.range(1).select(tx.tokenize_query(F.lit("  The of,  the ")).alias("t"),
                              tx.tokenize_query(F.lit("The of,"), normalize=True).alias("n")).first()
    assert r.t == ["The", "of,", "the"]
    assert r.n == ["the", "of"]
