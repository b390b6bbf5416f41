"""Benchmark of the headline jobs; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Jobs (each forced to completion with a write or a full aggregate):
  bulk_build      pages → forward index → terms, stats, scored postings (written, published)
  search_topk     top-10 for every user turn of the conversations over the stored index
  search_batch    matches and best score of every benchmark item over the stored index
  request_log     request log → query parameter → decode → top-10 answers
  refresh         recrawled pages merged into the next published version
  extract_links   anchors of every page, resolved and de-duplicated
  crawl_order     breadth-first crawl order over the link graph (its whole reach)
  docs_build      the plain-text documents corpus (ASCII-lowered text, doc_id as key) indexed and written
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sifter.functions.text import ascii_lower  # noqa: E402
from sifter.operators import index as ix  # noqa: E402
from sifter.operators import links as lx  # noqa: E402
from sifter.operators import search as sx  # noqa: E402
from sifter.plans import build as bx  # noqa: E402
from sifter.plans import refresh as rx  # noqa: E402
from sifter.plans.fixtures import fixture, table  # noqa: E402
from sifter.session import get_spark, scratch_path  # noqa: E402


def force(df) -> int:
    """Run the whole plan: count plus a checksum so no column is pruned away."""
    cols = [F.xxhash64(*df.columns)]
    row = df.agg(F.count(F.lit(1)), F.sum(F.pmod(cols[0], F.lit(1000003)))).collect()[0]
    return int(row[0])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app_name="sifter-bench")
    if not spark.sparkContext.getConf().get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sifter-bench-"))
    times: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t = time.time()
        rows[name] = fn()
        times[name] = round(time.time() - t, 3)

    pages = table(spark, sf_dir, "pages")
    root = scratch_path(spark, "bench-index")
    buckets = 16
    holder = {}

    def build():
        holder["idx"] = bx.bulk_build(pages, root, buckets=buckets)
        return holder["idx"].n_terms

    timed("bulk_build", build)
    idx = holder["idx"]
    timed("search_topk", lambda: force(sx.search_batch(idx, fixture(spark, sf_dir, "chat_queries"), k=10)))
    timed("search_batch", lambda: force(sx.search_totals(idx, fixture(spark, sf_dir, "bench_queries"))))
    timed("request_log", lambda: force(sx.answer_requests(fixture(spark, sf_dir, "query_log"), idx, k=10)))

    def refresh():
        new = fixture(spark, sf_dir, "recrawl").filter("seq = 1").select("url", "html")
        return rx.refresh_index(new, root, buckets=buckets).n_terms

    timed("refresh", refresh)
    timed("extract_links", lambda: force(lx.extract_links(pages)))
    timed("crawl_order", lambda: force(lx.crawl_order(
        pages.filter("page_id = 0").select("url"), fixture(spark, sf_dir, "link_graph"))))

    def docs_build():
        docs = table(spark, sf_dir, "documents")
        fwd = ix.forward_index(ix.spread(docs).select(F.col("doc_id").cast("string").alias("url"),
                                                      ascii_lower("text").alias("text")))
        return bx.write_index_tables(fwd, scratch_path(spark, "bench-docs"), buckets=buckets).n_terms

    timed("docs_build", docs_build)

    print(json.dumps({
        "metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "sf": sf, "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
