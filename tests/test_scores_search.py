"""Worked TF-IDF corpus (hand-computed from the reference's formulas) and search rules."""

import math

import pytest
from pyspark.sql import functions as F

from sifter.operators import search as sx
from sifter.plans import build as bx
from sifter.plans import catalog

from conftest import SF_SMALL

PAGES = [("A", "<body>apple banana apple</body>"), ("B", "<body>banana cherry</body>"),
         ("C", "<body>cherry</body>")]


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(PAGES, "url string, html string")


def scores(df):
    return {r.url: round(r.score, 6) for r in df.collect()}


def test_constant_idf_postings(corpus):
    idx = bx.build_index(corpus, idf="constant")
    got = {(r.term, r.url): round(r.tf_idf, 6) for r in idx.postings.collect()}
    assert got == {("apple", "A"): 0.732408, ("banana", "A"): 0.366204, ("banana", "B"): 0.549306,
                   ("cherry", "B"): 0.549306, ("cherry", "C"): 1.098612}


def test_smoothed_idf_postings(corpus):
    idx = bx.build_index(corpus, idf="smoothed")
    got = {(r.term, r.url): round(r.tf_idf, 6) for r in idx.postings.collect()}
    assert got[("apple", "A")] == round(2 / 3 * math.log(3 / 2), 6) == 0.27031
    assert got[("banana", "A")] == 0 and got[("cherry", "C")] == 0


@pytest.mark.parametrize("query,expected", [
    ("banana cherry", {"B": 1.098612, "C": 1.098612, "A": 0.366204}),
    ("apple apple", {"A": 1.464816}),
    ("Apple", {}), ("apple,", {}), ("", {}), ("zzz", {}),
])
def test_search_constant(corpus, query, expected):
    idx = bx.build_index(corpus, idf="constant")
    assert scores(sx.search(idx, query)) == expected


def test_search_ties_broken_by_url_and_zero_scores_kept(corpus):
    idx = bx.build_index(corpus, idf="constant")
    assert [r.url for r in sx.search(idx, "banana cherry").collect()] == ["B", "C", "A"]
    smoothed = bx.build_index(corpus, idf="smoothed")
    assert scores(sx.search(smoothed, "banana")) == {"A": 0.0, "B": 0.0}


def test_search_batch_equals_single_and_doubling(spark, corpus):
    idx = bx.build_index(corpus, idf="constant")
    q = spark.createDataFrame([(1, "banana cherry"), (2, "banana cherry banana cherry")], "qid long, query string")
    res = sx.search_batch(idx, q).collect()
    one = {r.url: r.score for r in res if r.qid == 1}
    two = {r.url: r.score for r in res if r.qid == 2}
    assert {u: round(s, 6) for u, s in one.items()} == scores(sx.search(idx, "banana cherry"))
    assert set(two) == set(one) and all(abs(two[u] - 2 * one[u]) < 1e-12 for u in one)


def test_topk_rank(spark, corpus):
    idx = bx.build_index(corpus, idf="constant")
    q = spark.createDataFrame([(1, "banana cherry")], "qid long, query string")
    res = sx.search_batch(idx, q, k=2).orderBy("rank").collect()
    assert [(r.url, r.rank) for r in res] == [("B", 1), ("C", 2)]


def test_stored_index_prunes_partitions(spark, corpus, tmp_path):
    idx = bx.write_index_tables(bx.ix.forward_from_pages(corpus), str(tmp_path / "idx"), "constant", buckets=4)
    lookup = sx.term_lookup(idx, "cherry")
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(term_bucket" in plan
    assert {r.url for r in lookup.collect()} == {"B", "C"}
    assert scores(sx.search(idx, "banana cherry")) == {"B": 1.098612, "C": 1.098612, "A": 0.366204}


def test_request_log(spark, corpus):
    idx = bx.build_index(corpus, idf="constant")
    reqs = spark.createDataFrame([
        (1, "GET", "/search?query=banana+cherry"), (2, "GET", "/search?q=1"),
        (3, "POST", "/search?query=apple"), (4, "GET", "/search?query=apple&query=cherry")],
        "req_id long, method string, uri string")
    res = sx.answer_requests(reqs, idx, k=10).collect()
    by = {}
    for r in res:
        by.setdefault(r.req_id, set()).add(r.url)
    assert by == {1: {"A", "B", "C"}, 2: {None}, 4: {"B", "C"}}
    assert F is not None


def test_topk_with_many_exact_copies(spark, tmp_path):
    copies = [(f"http://c/{i:03d}", "<body>spam eggs</body>") for i in range(40)]
    others = [("http://o/1", "<body>spam spam ham</body>"), ("http://o/2", "<body>ham</body>")]
    pages = spark.createDataFrame(copies + others, "url string, html string")
    q = spark.createDataFrame([(1, "spam"), (2, "eggs ham")], "qid long, query string")
    stored = bx.write_index_tables(bx.ix.forward_from_pages(pages), str(tmp_path / "copies"), "constant", buckets=2)
    lazy = bx.build_index(pages, idf="constant")
    rows = lambda df: sorted((r.qid, r.url, round(r.score, 9), r.rank) for r in df.collect())
    for layout in ({"query_side_bytes": 0}, {}, {"shards": 1}, {"shards": 50}):
        got = rows(sx.search_batch(stored, q, k=5, **layout))
        assert got == rows(sx.search_batch(lazy, q, k=5))
    top_spam = [r.url for r in sx.search_batch(stored, q, k=5).filter("qid = 1").orderBy("rank").collect()]
    assert top_spam == ["http://o/1", "http://c/000", "http://c/001", "http://c/002", "http://c/003"]


def test_driver_bucket_matches_spark(spark):
    from pyspark.sql import functions as F
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    terms = bx.ix.term_frequency(bx.ix.forward_from_pages(pages)).select("term").distinct()
    rows = terms.select("term", bx.ix.term_bucket("term", 37).alias("b")).collect()
    assert rows and all(bx.ix.bucket_of(r.term, 37) == r.b for r in rows)
    assert F is not None


def test_join_sums_are_those_of_all_joined_postings(spark, corpus):
    idx = bx.build_index(corpus, idf="constant")
    queries = spark.createDataFrame([(1, "banana cherry banana"), (2, "cherry zzz"), (3, ""), (4, "banana"), (4, "banana"), (None, "apple")],
                                    "qid int, query string")
    qt = sx.query_terms(queries)
    every = (sx.search_join(idx.postings, qt).groupBy("qid", "term", "mult")
             .agg(F.count(F.lit(1)).alias("postings"), F.sum("tf_idf").alias("tf_idf")))
    rows = lambda df: sorted(((r.qid, r.term, r.mult, r.postings, round(r.tf_idf, 9)) for r in df.collect()), key=repr)
    got = rows(sx.search_join_totals(idx.postings, qt))
    assert got == rows(every) and (4, "banana", 2, 2) in {r[:4] for r in got} and len(got) == 5


def test_registered_join_sums_postings_before_the_queries_multiply_them(spark):
    """Nothing is summed above the join with the queries: their terms meet one row per term."""
    plan = catalog.queries()["search_join"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Join Inner")[0]
    assert "Join Inner" in plan and "Aggregate" not in above
