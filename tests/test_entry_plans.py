"""Driver contract and plan-shape checks."""

import __spark_entry__ as entry
from sifter.operators import index as ix
from sifter.operators import search as sx
from sifter.plans import build as bx
from sifter.plans import catalog
from sifter.plans.fixtures import fixture
from sifter.session import scratch_path

from conftest import SF_SMALL


def plan_text(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"qid", "url", "score", "rank"}
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(catalog.queries())
    assert len(catalog.queries()) >= 57
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_no_python_udf_in_core_plans(spark):
    for key in ["html_to_text", "term_frequency", "tf_idf_smoothed", "search_topk", "resolve_url"]:
        plan = entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key


def test_forward_index_has_no_shuffle(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    plan = ix.forward_from_pages(pages)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "hashpartitioning" not in plan.lower()


def test_search_plan_prunes_and_limits(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    idx = bx.write_index_tables(ix.forward_from_pages(pages), scratch_path(spark, "t-plan"), buckets=8)
    res = sx.search_batch(idx, fixture(spark, SF_SMALL, "chat_queries"), k=10)
    plan = plan_text(res)
    assert "WindowGroupLimit" in plan
    assert "PartitionFilters: [term_bucket" in plan or "PartitionFilters: [isnotnull(term_bucket)" in plan
    assert "BroadcastHashJoin" in plan or "broadcast" in plan.lower()


def test_hits_stay_in_their_shard(spark):
    """Postings are scanned once and dealt once; above them only ranked rows are dealt, by query."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    idx = bx.write_index_tables(ix.forward_from_pages(pages), scratch_path(spark, "t-shards"), buckets=8)
    queries = fixture(spark, SF_SMALL, "chat_queries")
    for found, above in ((sx.search_batch(idx, queries, k=10), "WindowGroupLimit [qid"), (sx.search_totals(idx, queries), "HashAggregate(keys=[qid")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        lines = plan.splitlines()
        by_shard = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(shard" in ln]
        assert len(by_shard) == 1 and plan.count("frequency#") and sum("FileScan" in ln and "frequency" in ln for ln in lines) == 1
        moved = [i for i, ln in enumerate(lines[:by_shard[0]]) if "Exchange hashpartitioning(qid" in ln]
        assert len(moved) == 1 and above in lines[moved[0] + 1], lines[moved[0] + 1]
        assert not any("Exchange hashpartitioning(qid" in ln and "doc_id" in ln for ln in lines)


def test_totals_are_those_of_all_matches(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    idx = bx.write_index_tables(ix.forward_from_pages(pages), scratch_path(spark, "t-totals"), buckets=8)
    queries = fixture(spark, SF_SMALL, "chat_queries")
    want = {}
    for r in sx.search_batch(idx, queries).collect():
        want.setdefault(r.qid, []).append(r.score)
    for layout in ({}, {"shards": 1}, {"shards": 37}, {"query_side_bytes": 0}):
        got = {r.qid: (r.matches, round(r.best, 9), round(r.total, 6)) for r in sx.search_totals(idx, queries, **layout).collect()}
        assert got == {q: (len(v), round(max(v), 9), round(sum(v), 6)) for q, v in want.items()}


def unpartitioned_windows(plan: str) -> list[str]:
    """Window specs list partition keys first; without any, the first item is an ordering or the frame."""
    out = []
    for ln in plan.splitlines():
        for spec in ln.split("windowspecdefinition(")[1:]:
            first = spec.split(", ")[0]
            if first.startswith("specifiedwindowframe") or first.endswith(("NULLS FIRST", "NULLS LAST")):
                out.append(ln)
    return out


def test_unpartitioned_window_detector(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    bad = spark.range(5).withColumn("r", F.row_number().over(Window.orderBy("id")))
    good = spark.range(5).withColumn("r", F.row_number().over(Window.partitionBy("id").orderBy("id")))
    assert unpartitioned_windows(bad._jdf.queryExecution().executedPlan().toString())
    assert not unpartitioned_windows(good._jdf.queryExecution().executedPlan().toString())


def test_all_registered_plans_stay_jvm_side_and_partitioned(spark):
    for key, fn in catalog.queries().items():
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, key
        assert not unpartitioned_windows(plan), key
        assert "CartesianProduct" not in plan, key


def test_stored_search_plans_agree(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    idx = bx.write_index_tables(ix.forward_from_pages(pages), scratch_path(spark, "t-plans2"), buckets=8)
    q = fixture(spark, SF_SMALL, "chat_queries")
    rows = lambda df: sorted((r.qid, r.url, round(r.score, 9), r.rank) for r in df.collect())
    broadcast_plan = sx.search_batch(idx, q, k=10)
    shuffle_plan = sx.search_batch(idx, q, k=10, query_side_bytes=0)
    assert rows(broadcast_plan) == rows(shuffle_plan)
    lazy = sx.search_batch(bx.build_index(pages), q, k=10)
    assert rows(lazy) == rows(shuffle_plan)
    every = lambda df: sorted((r.qid, r.url, round(r.score, 9)) for r in df.collect())
    assert every(sx.search_batch(idx, q)) == every(sx.search_batch(idx, q, query_side_bytes=0))


def test_registered_queries_parse_html_once(spark):
    """What they return derives from the stored forward table: no scan below them reads html."""
    for key in ("search_topk", "search_batch", "search_join", "search", "tf_idf_smoothed", "tf_idf_constant",
                "join_document_stats", "join_term_idf", "corpus_scalar", "inverted_index", "search_request_log"):
        df = catalog.queries()[key](spark, SF_SMALL)
        scans = [ln for ln in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in ln]
        assert scans and not any("html" in ln for ln in scans), key


def test_the_text_corpus_is_parsed_once(spark):
    found = catalog.QUERIES["search_topk_text"](spark, "/root/testdata/sf0.001")
    # terms, stats and postings come from the stored forward index, not each from the texts
    assert not [f for f in found.inputFiles() if "/documents.parquet" in f]
    assert found.count() > 0
