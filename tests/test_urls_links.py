"""URL functions against Python's urllib (library parity) and the request-URI cases."""

import itertools
import urllib.robotparser
from urllib.parse import urljoin

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sifter.functions import urls as ux
from sifter.operators import links as lx

BASES = ["http://a/b/c?q#f", "http://a/b/c", "http://a/b/c/", "http://a", "https://x.org/p/q/r?z=1",
         "HTTP://H/a/./b/../c", "http://a/b/c;p?q", ""]
HREFS = ["d", "../d", "//x/y", "#z", "?k=v", "", "mailto:x@y", "../../../d", "..", ".", "./", "g/", "/g",
         "/./g", "/../g", "g/../..", "g;x", "http:g", "https://o/t/../u", "a//b/./c", "../", "a?b#c"]


def test_resolve_url_matches_urljoin(spark):
    pairs = list(itertools.product(BASES, HREFS))
    df = spark.createDataFrame(pairs, "base string, href string")
    got = df.select("base", "href", ux.resolve_url("base", "href").alias("r")).collect()
    assert [r.r for r in got] == [urljoin(b, h) for b, h in pairs]


segment = st.sampled_from(["a", "b", "..", ".", "", "c;p", "d.e"])


@settings(max_examples=40, deadline=None)
@given(base=st.lists(segment, min_size=0, max_size=4), href=st.lists(segment, min_size=1, max_size=4),
       absolute=st.booleans(), query=st.sampled_from(["", "?x=1"]))
def test_resolve_url_property(spark, base, href, absolute, query):
    b = "http://h/" + "/".join(base)
    h = ("/" if absolute else "") + "/".join(href) + query
    r = spark.createDataFrame([(b, h)], "b string, h string").select(ux.resolve_url("b", "h")).first()[0]
    assert r == urljoin(b, h)


@pytest.mark.parametrize("uri,raw,decoded", [
    ("/search?query=a+b&query=c%20d&z", "c%20d", "c d"),
    ("/search", None, None),
    ("query=x", "x", "x"),
    ("/search?query=100%", "100%", "100%"),
    ("/search?q=1", None, None),
    ("/search?query=%C3%A9t%C3%A9", "%C3%A9t%C3%A9", "été"),
])
def test_query_param_and_decode(spark, uri, raw, decoded):
    r = spark.createDataFrame([(uri,)], "uri string").select(
        ux.query_param("uri").alias("p"), ux.url_decode_lenient(ux.query_param("uri")).alias("d")).first()
    assert (r.p, r.d) == (raw, decoded)


def test_dump_key_and_robots_url(spark):
    r = spark.createDataFrame([("https://en.wikipedia.org/wiki/Main_Page",)], "u string").select(
        ux.dump_key("u").alias("k"), ux.robots_url("u").alias("r")).first()
    assert r.k == "en.wikipedia.org_wiki_Main_Page.html"
    assert r.r == "https://en.wikipedia.org/robots.txt"


def test_extract_links_and_host_filter(spark):
    html = ('<body><a href="/w/A">a</a><script><a href="/no"></a></script><!-- <a href="/no2"> -->'
            "<A class=x HREF='b?c=1&amp;d=2'>b</A><a href=//other.org/x>o</a><a data-href=\"/no3\">n</a>"
            '<a href="/w/A">dup</a></body>')
    pages = spark.createDataFrame([("http://h.org/p/q", html)], "url string, html string")
    got = {r.dst for r in lx.extract_links(pages).collect()}
    assert got == {"http://h.org/w/A", "http://h.org/p/b?c=1&d=2", "http://other.org/x"}
    kept = {r.dst for r in lx.extract_links(pages, hosts=["h.org"]).collect()}
    assert kept == {"http://h.org/w/A", "http://h.org/p/b?c=1&d=2"}


def test_robots_filter_matches_robotparser(spark):
    robots = ["User-agent: other", "Disallow: /", "", "User-agent: mycrawler", "Allow: /a/b",
              "Disallow: /a", "", "User-agent: *", "Disallow: /x", "Allow: /"]
    rp = urllib.robotparser.RobotFileParser()
    rp.parse(robots)
    rules = [("h", "other", 0, False, "/"), ("h", "mycrawler", 1, True, "/a/b"), ("h", "mycrawler", 2, False, "/a"),
             ("h", "*", 3, False, "/x"), ("h", "*", 4, True, "/")]
    rules_df = spark.createDataFrame(rules, "host string, agent string, rule_order int, allow boolean, path_prefix string")
    paths = ["/", "/a", "/a/b", "/a/bc", "/x", "/xy", "/b", "/a/c?q", ""]
    urls = spark.createDataFrame([(f"http://h{p}",) for p in paths], "url string")
    got = {r.url: r.allowed for r in lx.robots_filter(urls, rules_df, agent="MyCrawler/1.0").collect()}
    assert got == {f"http://h{p}": rp.can_fetch("MyCrawler/1.0", f"http://h{p}") for p in paths}
    star = {r.url: r.allowed for r in lx.robots_filter(urls, rules_df, agent="Bot").collect()}
    assert star == {f"http://h{p}": rp.can_fetch("Bot", f"http://h{p}") for p in paths}


def test_crawl_order_bfs(spark):
    edges = [("s", "a"), ("s", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("d", "s"), ("b", "e")]
    links = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("s",)], "url string")
    full = {r.url: r.level for r in lx.crawl_order(seeds, links, max_pages=100).collect()}
    assert full == {"s": 0, "a": 1, "b": 1, "c": 2, "e": 2, "d": 3}
    cut = {r.url: r.level for r in lx.crawl_order(seeds, links, max_pages=4).collect()}
    assert cut == {"s": 0, "a": 1, "b": 1, "c": 2}
    shallow = {r.url for r in lx.crawl_order(seeds, links, max_pages=100, max_depth=1).collect()}
    assert shallow == {"s", "a", "b"}
    assert F is not None


ROBOTS_FILES = [
    "User-agent: *\nDisallow: /private\nAllow: /",
    "User-agent: MyCrawler\nUser-agent: other\nDisallow: /a\n\nUser-agent: *\nDisallow: /",
    "# comment\nUser-agent: mycrawler # inline\nAllow: /a/b\nDisallow: /a\nUser-agent: x\nDisallow: /\n",
    "Disallow: /ignored-before-agent\nUser-agent: *\n\nDisallow: /orphan\nUser-agent: *\nDisallow: /x",
    "User-agent: *\nDisallow:\n\nUser-agent: *\nDisallow: /second-star-ignored",
    "User-agent: bot\nUser-agent: *\nDisallow: /b\n\nUser-agent: mycrawler\nDisallow: /m",
    "  \nUser-agent: MyCrawler\n   \nDisallow: /spaces-do-not-end-entries\r\nAllow: /%7Etilde",
]
PATHS = ["/", "/a", "/a/b", "/a/bc", "/private/x", "/x", "/b", "/m", "/orphan", "/second-star-ignored",
         "/spaces-do-not-end-entries", "/~tilde", "/ignored-before-agent"]


@pytest.mark.parametrize("agent", ["MyCrawler/1.0", "OtherBot"])
def test_robots_rules_match_robotparser(spark, agent):
    rows = [(f"h{i}", 200, body) for i, body in enumerate(ROBOTS_FILES)]
    rows += [("d401", 401, None), ("a404", 404, None), ("e503", 503, None)]
    robots = spark.createDataFrame(rows, "host string, status int, body string")
    rules = lx.robots_rules(robots)
    urls = spark.createDataFrame([(f"http://{h}{p}",) for h, _, _ in rows for p in PATHS], "url string")
    got = {r.url: r.allowed for r in lx.robots_filter(urls, rules, agent=agent).collect()}
    want = {}
    for host, status, body in rows:
        rp = urllib.robotparser.RobotFileParser()
        if status == 200:
            rp.parse(body.splitlines())
        elif status in (401, 403):
            rp.disallow_all = True
        elif 400 <= status < 500:
            rp.allow_all = True
        for p in PATHS:
            want[f"http://{host}{p}"] = rp.can_fetch(agent, f"http://{host}{p}")
    assert got == want


def test_robots_rules_random_files_match_robotparser(spark):
    import random
    rnd = random.Random(11)
    line_kinds = ["User-agent: *", "User-agent: mycrawler", "User-agent: Other", "user-agent: MyCrawler",
                  "Allow: /a", "Allow: /a/b", "Disallow: /a", "Disallow: /", "Disallow:", "Disallow: /b",
                  "", "# comment", "   ", "Crawl-delay: 3", "Allow: /b # tail", "garbage line", "Request-rate: 1/5", "Sitemap: http://s/x"]
    rows = []
    for i in range(200):
        body = "\n".join(rnd.choice(line_kinds) for _ in range(rnd.randrange(0, 14)))
        rows.append((f"r{i}", 200, body))
    paths = ["/", "/a", "/a/b", "/a/c", "/b", "/bb", "/c"]
    robots = spark.createDataFrame(rows, "host string, status int, body string")
    rules = lx.robots_rules(robots)
    urls = spark.createDataFrame([(f"http://{h}{p}",) for h, _, _ in rows for p in paths], "url string")
    for agent in ["MyCrawler/2.1", "SomeBot"]:
        got = {r.url: r.allowed for r in lx.robots_filter(urls, rules, agent=agent).collect()}
        want = {}
        for host, _, body in rows:
            rp = urllib.robotparser.RobotFileParser()
            rp.parse(body.splitlines())
            for p in paths:
                want[f"http://{host}{p}"] = rp.can_fetch(agent, f"http://{host}{p}")
        assert got == want, [(u, got[u], want[u]) for u in want if got.get(u) != want[u]][:5]


def test_robots_compare_decoded_paths(spark):
    import urllib.robotparser

    body = "User-agent: *\nDisallow: /a%20b\nDisallow: /caf%C3%A9\nDisallow: /x/\nAllow: /q?ok\nDisallow: /q?\n"
    parser = urllib.robotparser.RobotFileParser()
    parser.parse(body.splitlines())
    urls = [f"http://h{p}" for p in ("/a%20b/c", "/a b", "/caf%C3%A9/1", "/café", "/%78/1", "/x/1", "/x", "/q?ok=1", "/q?no", "/q", "/", "", "/q%3Fok")]
    rules = lx.robots_rules(spark.createDataFrame([("h", 200, body)], "host string, status int, body string"))
    got = {r.url: r.allowed for r in lx.robots_filter(spark.createDataFrame([(u,) for u in urls], "url string"), rules).collect()}
    assert got == {u: parser.can_fetch("MyCrawler", u) for u in urls}


def test_hrefs_are_cleaned_like_urljoin(spark):
    from urllib.parse import urljoin

    hrefs = [" /x", "/x\n", "/p\nq", "\thttp://z/1", "\x01/c", "a\tb", "  "]
    df = spark.createDataFrame([("http://a/b/", h) for h in hrefs], "base string, href string")
    got = [(r.href, r.u) for r in df.select("href", ux.resolve_url("base", "href").alias("u")).collect()]
    assert got == [(h, urljoin("http://a/b/", h)) for h in hrefs]


def test_crawl_seeds_are_bounded_and_checked(spark):
    seeds = spark.createDataFrame([(f"http://h/{i}",) for i in range(10)], "url string")
    links = spark.createDataFrame([("http://h/0", "http://h/n"), ("http://h/n", "http://h/m"), ("http://d/1", "http://h/z")], "src string, dst string")
    assert sorted(r.url for r in lx.crawl_order(seeds, links, max_pages=3).collect()) == ["http://h/0", "http://h/1", "http://h/2"]
    deny = spark.createDataFrame([("d", "*", 0, False, "/")], "host string, agent string, rule_order int, allow boolean, path_prefix string")
    both = seeds.unionByName(spark.createDataFrame([("http://d/1",)], "url string"))
    reach = {r.url for r in lx.crawl_order(both, links, rules=deny).collect()}
    assert reach == {f"http://h/{i}" for i in range(10)} | {"http://h/n", "http://h/m"}
    fetched = spark.createDataFrame([(f"http://h/{i}", 200, "x") for i in range(10)] + [("http://h/n", 404, "x"), ("http://h/m", 200, "x")],
                                    "url string, status int, html string")
    assert {r.url for r in lx.crawl_order(seeds, links, fetched=fetched).collect()} == {f"http://h/{i}" for i in range(10)}


def test_hrefs_decode_character_references(spark):
    import html

    hrefs = ["/q?a=1&#38;b=2", "/e&eacute;&amp;eacute;", "&#x1F600;&#233;&#xe9;", "/a?x=1&y=2", "&lt;&quot;&apos;&gt;", "&nosuch;", "&amp;#38;", "/plain"]
    pages = spark.createDataFrame([("http://h/", f'<a href="{h}">x</a>') for h in hrefs], "url string, html string")
    got = [r.h[0] for r in pages.select(lx.anchor_hrefs("html").alias("h")).collect()]
    assert got == [html.unescape(h) for h in hrefs]


def test_urls_emit_prefixes_of_their_own_hosts_lengths_only(spark):
    rules = spark.createDataFrame(
        [("a", "*", 0, False, "/" + "x" * n) for n in range(1, 40)] + [("b", "*", 0, False, "/p")],
        "host string, agent string, rule_order int, allow boolean, path_prefix string")
    long_path = "/" + "y" * 60
    urls = spark.createDataFrame([(f"http://{h}{p}",) for h in ("a", "b", "c") for p in ("/xx", "/p1", long_path)], "url string")
    decided = lx.robots_filter(urls, rules)
    assert {r.url for r in decided.filter("not allowed").collect()} == {"http://a/xx", "http://b/p1"} and decided.count() == 9
    plan = decided._jdf.queryExecution().optimizedPlan().toString()
    assert "__lengths" in plan and "collect_set" in plan  # joined per host, not collected on the driver


def test_anchors_behind_other_attributes(spark):
    """Against the standard library's HTML parser: quoted values may hold '>' or 'href=', long tags do not overflow."""
    from html.parser import HTMLParser

    class Anchors(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a":
                self.found += [v for k, v in attrs if k == "href" and v][:1]

    tags = ['<a title="a>b" href="/1">', "<a title='x > y' href='/2' class=z>", '<a title="see href=/no" href=/3>', '<a data-href="/no" href="/4">',
            "<A\n TITLE = \"a>b\"\n HREF = '/5'>", '<a title=don\'t href="/6">', "<a title=\"href='/no'\">", '<a class="x"href="/8">', "<a x= href=/no>",
            "<a>", "<abbr href='/no'>", "<a hrefs='/no'>", "<a href=''>", "<a disabled href=/10/a?b=c&amp;d>", '<a href="/11?a>b">', "<a name=x>", "<a x=1 y href=/12>",
            "<a " + " ".join(f'data-{i}="v>{i}"' for i in range(400)) + " href=/13>", '<a title="' + "long > " * 20_000 + '" href=/14>']
    bodies = [*(f"<p>it's {t}one</a> isn't</p>" for t in tags), "".join(f"{t}text</a>\n" for t in tags)]
    pages = spark.createDataFrame(list(enumerate(bodies)), "n int, html string")
    got = {r.n: [h for h in r.h if h] for r in pages.select("n", lx.anchor_hrefs("html").alias("h")).collect()}
    for n, body in enumerate(bodies):
        parser = Anchors()
        parser.feed(body)
        parser.close()
        assert got[n] == parser.found, body[:200]
