"""Derived test tables, defined once as SQL over the provided tables.

Each statement runs unchanged in Spark SQL and in DuckDB, so the registered
queries and their oracles start from the same rows.  All of them grow with the
``pages`` / ``conversations`` tables they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("pages", "conversations", "benchmark", "documents")

FIXTURE_SQL: dict[str, str] = {
    # one dump file per page: url, line "---URL---", html
    "raw_dump": """
        SELECT page_id, url, url || chr(10) || '---URL---' || chr(10) || html AS value FROM pages""",
    # version 1 gives every third URL its neighbour's content
    "recrawl": """
        SELECT 0 AS seq, url, html FROM pages
        UNION ALL
        SELECT 1 AS seq, a.url, b.html FROM pages a JOIN pages b ON b.page_id = a.page_id + 1
        WHERE a.page_id % 3 = 0""",
    "query_log": """
        SELECT conv_id * 1000 + turn AS req_id,
               CASE WHEN conv_id % 10 = 9 THEN 'POST' ELSE 'GET' END AS method,
               CASE WHEN conv_id % 10 = 8 THEN '/'
                    ELSE '/search?page=1&query=' || replace(replace(replace(replace(replace(replace(
                         text, '%', '%25'), '&', '%26'), '+', '%2B'), '#', '%23'), chr(10), '%0A'), ' ', '+')
               END AS uri
        FROM conversations WHERE role = 'user'""",
    "fetch_log": """
        SELECT page_id, url, CASE WHEN page_id % 7 = 0 THEN 404 ELSE 200 END AS status,
               CASE WHEN page_id % 11 = 0 THEN '' ELSE html END AS html
        FROM pages""",
    "robots_rules": """
        SELECT DISTINCT split_part(split_part(url, '://', 2), '/', 1) AS host, '*' AS agent,
               r.rule_order, r.allow, r.path_prefix
        FROM pages CROSS JOIN (SELECT 0 AS rule_order, true AS allow, '/der' AS path_prefix
                               UNION ALL SELECT 1, false, '/de'
                               UNION ALL SELECT 2, false, '/the') r
        WHERE page_id % 2 = 0""",
    # the same rules percent-encoded, a group for a named agent, and an exception under a query string
    "robots_named": """
        SELECT DISTINCT split_part(split_part(url, '://', 2), '/', 1) AS host, r.agent, r.rule_order, r.allow, r.path_prefix
        FROM pages CROSS JOIN (SELECT '*' AS agent, 0 AS rule_order, true AS allow, '/%64er' AS path_prefix
                               UNION ALL SELECT '*', 1, false, '/d%65'
                               UNION ALL SELECT '*', 2, false, '/the'
                               UNION ALL SELECT 'mycrawler', 3, true, '/%74he%3Fx'
                               UNION ALL SELECT 'mycrawler', 4, false, '/%74h') r
        WHERE page_id % 2 = 0 AND (r.agent = '*' OR page_id % 3 = 0)""",
    # page urls as they are, with one character percent-encoded, and with a query and a fragment
    "robots_urls": """
        SELECT url FROM pages
        UNION SELECT replace(replace(url, '/d', '/%64'), '/t', '/%74') FROM pages
        UNION SELECT replace(url, '/the', '/the?x=') || '#f' FROM pages""",
    "link_graph": """
        SELECT a.url AS src, b.url AS dst FROM pages a CROSS JOIN (SELECT count(*) AS n FROM pages) c
        JOIN pages b ON b.page_id = (a.page_id * 7 + 3) % c.n
        UNION
        SELECT a.url, b.url FROM pages a CROSS JOIN (SELECT count(*) AS n FROM pages) c
        JOIN pages b ON b.page_id = (a.page_id * 5 + 1) % c.n""",
    # queries: the benchmark items and the user turns of the conversations
    "bench_queries": "SELECT item_id AS qid, text AS query FROM benchmark",
    "chat_queries": "SELECT conv_id * 1000 + turn AS qid, text AS query FROM conversations WHERE role = 'user'",
}


def register_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    """Temp views over the provided Parquet tables (scans stay lazy)."""
    for name in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    register_tables(spark, sf_dir)
    return spark.sql(FIXTURE_SQL[name])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_fixtures(sql: str, *names: str) -> str:
    """Prefix an oracle query with the fixture CTEs it uses."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
