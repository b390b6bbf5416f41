"""Links, robots rules, frontiers and crawl order.

The crawler's network work is not rebuilt; what it computes from stored pages
is: the anchors of a page resolved against its URL, the host filter, the
robots decision, the new frontier of a crawl step and the breadth-first order
of a crawl over a stored link table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sifter.functions.text import decode_references
from sifter.functions.urls import resolve_url, url_host
from sifter.operators.index import assign_ids, broadcast_if_small, spread
from sifter.session import checkpoint_root

# ---------------------------------------------------------------------------
# What an HTML parser skips and what counts as an anchor.
#   skipped: <script>/<style> blocks and <!-- … --> comments (also multi-line)
#   anchor:  <a …href=VALUE…>, VALUE double-quoted, single-quoted or bare; the attributes in
#            front are read whole, so a quoted value may hold ">" or "href="
#   default crawler user agent: MyCrawler
# ---------------------------------------------------------------------------
SKIP_PATTERN = r"(?i)<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>|<!--[\s\S]*?-->"
_BLANK = r"\t\n\x0B\f\r "
_EQUALS = rf"[{_BLANK}]*+=[{_BLANK}]*+"
_ATTRIBUTE = rf"""[^{_BLANK}>=]++(?:{_EQUALS}(?:"[^"]*+"|'[^']*+'|[^{_BLANK}"'>][^{_BLANK}>]*+)?+)?+"""
ANCHOR_PATTERN = (rf"""(?i)<a(?=[{_BLANK}])(?:[{_BLANK}]*+(?!href{_EQUALS})(?:{_ATTRIBUTE}|=))*+"""
                  rf"""[{_BLANK}]*+href{_EQUALS}("[^"]*"|'[^']*'|[^{_BLANK}"'>]+)""")
DEFAULT_AGENT = "MyCrawler"


def _unquote(v: Column) -> Column:
    quoted = v.startswith('"') | v.startswith("'")
    return F.when(quoted, F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v)


def anchor_hrefs(html) -> Column:
    """Raw href values of all anchors outside script/style/comments, character references decoded."""
    h = F.col(html) if isinstance(html, str) else html
    raw = F.regexp_extract_all(F.regexp_replace(h, SKIP_PATTERN, ""), F.lit(ANCHOR_PATTERN), 1)
    return F.transform(raw, lambda v: decode_references(_unquote(v)))


def extract_links(pages: DataFrame, hosts: list[str] | DataFrame | None = None,
                  url: str = "url", html: str = "html") -> DataFrame:
    """R48 (+R46, R20): distinct (src, dst) links of every page; fragments kept."""
    return distinct_links(_filter_hosts(resolved_anchors(pages, url, html), hosts))


def resolved_anchors(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, href, dst) for every anchor of every page (not de-duplicated).

    The url is resolved inside the generator: predicates that later joins
    infer on ``dst`` (``isnotnull``) cannot be pushed below a generator's
    output, so the resolution is never copied into a filter and run twice.
    """
    src = F.col(url)
    anchors = F.transform(anchor_hrefs(html), lambda h: F.struct(h.alias("href"), resolve_url(src, h).alias("dst")))
    return spread(pages).select(src.alias("src"), F.inline(anchors))


def _filter_hosts(links: DataFrame, hosts) -> DataFrame:
    if hosts is not None:
        links = host_filter(links, hosts)
    return links


def distinct_links(links: DataFrame) -> DataFrame:
    """The link set (src, dst)."""
    return links.select("src", "dst").distinct()


def host_filter(links: DataFrame, hosts: list[str] | DataFrame, col: str = "dst") -> DataFrame:
    """Keep links whose netloc equals one of ``hosts`` exactly (port, case kept)."""
    h = url_host(F.col(col))
    if isinstance(hosts, (list, tuple, set)):
        return links.filter(h.isin(sorted(hosts)))
    keyed = links.withColumn("__host", h)
    return keyed.join(hosts.select(F.col(hosts.columns[0]).alias("__host")).distinct(),
                      "__host", "left_semi").drop("__host")


def usable_pages(fetched: DataFrame) -> DataFrame:
    """Fetch results with status 200 and non-empty content."""
    return fetched.filter((F.col("status") == 200) & F.col("html").isNotNull() & (F.col("html") != ""))


def _robots_path(p: Column) -> Column:
    """Percent-decoded path (with query and fragment) without an empty query or fragment mark.

    The parser decodes and re-encodes both the rule and the URL; encoding keeps
    prefixes, so the decoded texts are compared.
    """
    decoded = F.coalesce(_percent_decode(p), p)
    return F.regexp_replace(F.regexp_replace(decoded, "#$", ""), r"\?(?=#|$)", "")


def _path_for_robots(u: Column) -> Column:
    rest = _robots_path(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([\s\S]*)$", 1))
    return F.when(rest == "", F.lit("/")).otherwise(rest)


# ---------------------------------------------------------------------------
# Robots.txt reading as Python's urllib.robotparser does it.
#   lines split like str.splitlines; '#' starts a comment; "key: value" with the
#   key case-insensitive; keys user-agent, allow, disallow, and crawl-delay /
#   request-rate (which end the agent list of an entry like a rule does); an
#   empty raw line ends an entry; "Disallow:" with an empty path allows
#   everything; the first entry naming "*" is the default entry, later ones
#   are ignored.
#   HTTP status: 401/403 → deny all, other 4xx → allow all, 200 → parse,
#   anything else → nothing is allowed.
# ---------------------------------------------------------------------------
ROBOTS_LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def _percent_decode(v: Column) -> Column:
    """urllib's unquote: %XX decoded, '+' kept, a lone '%' kept."""
    plus_safe = F.replace(v, F.lit("+"), F.lit("%2B"))
    return F.try_url_decode(F.regexp_replace(plus_safe, r"%(?![0-9A-Fa-f]{2})", "%25"))


def robots_rules(robots: DataFrame) -> DataFrame:
    """R21 input: ``robots(host, status, body)`` → rules(host, entry, agent, rule_order, allow, path_prefix).

    One robots file is one row; its lines are exploded and the parser's state
    (which entry a line belongs to, whether a rule is accepted) is derived with
    running window aggregates over the lines of that one file.
    """
    parsed = robots.filter(F.col("status") == 200).select(
        "host", F.posexplode(F.split(F.coalesce("body", F.lit("")), ROBOTS_LINE_BREAK)).alias("pos", "raw"))
    line = F.trim(F.regexp_replace(F.regexp_extract("raw", r"^([^#]*)", 1), r"^\s+|\s+$", ""))
    has_colon = F.instr(line, ":") > 0
    key = F.lower(F.trim(F.substring_index(line, ":", 1)))
    value = F.trim(F.expr("substring(__line, instr(__line, ':') + 1)"))
    lines = parsed.withColumn("__line", line).select(
        "host", "pos",
        F.when(F.col("raw") == "", F.lit("B"))
        .when(has_colon & (key == "user-agent"), F.lit("A"))
        .when(has_colon & key.isin("allow", "disallow"), F.lit("R"))
        .when(has_colon & key.isin("crawl-delay", "request-rate"), F.lit("D"))
        .alias("kind"),
        (key == "allow").alias("allow"),
        value.alias("value"))
    lines = lines.filter(F.col("kind").isNotNull())
    w = Window.partitionBy("host").orderBy("pos")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    lines = (lines
             .withColumn("__blank", F.max(F.when(F.col("kind") == "B", F.col("pos"))).over(before))
             .withColumn("__agent", F.max(F.when(F.col("kind") == "A", F.col("pos"))).over(before)))
    accepted = F.col("kind").isin("R", "D") & (F.coalesce("__agent", F.lit(-1)) > F.coalesce("__blank", F.lit(-1)))
    lines = lines.withColumn("__accepted", accepted).withColumn(
        "__rule", F.max(F.when(F.col("__accepted"), F.col("pos"))).over(before))
    last_other = F.greatest(F.coalesce("__blank", F.lit(-1)), F.coalesce("__rule", F.lit(-1)))
    starts = (F.col("kind") == "A") & (F.coalesce("__agent", F.lit(-1)) < last_other) | \
        ((F.col("kind") == "A") & F.col("__agent").isNull())
    lines = lines.withColumn("entry", F.sum(F.when(starts, 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    agents = lines.filter(F.col("kind") == "A").select("host", "entry", _percent_decode(F.col("value")).alias("agent"))
    events = lines.filter("__accepted")
    rules = events.filter(F.col("kind") == "R").select(
        "host", "entry", F.col("pos").alias("rule_order"),
        (F.col("allow") | (F.col("value") == "")).alias("allow"),
        F.col("value").alias("path_prefix"))
    # an entry that only carries a crawl delay still exists and allows everything
    rule_less = events.groupBy("host", "entry").agg(
        F.max(F.when(F.col("kind") == "R", 1).otherwise(0)).alias("__has_rules"),
        F.max("pos").alias("rule_order")).filter(F.col("__has_rules") == 0).select(
        "host", "entry", "rule_order", F.lit(True).alias("allow"), F.lit("").alias("path_prefix"))
    rules = rules.unionByName(rule_less)
    entries = agents.join(rules.select("host", "entry").distinct(), ["host", "entry"], "left_semi")
    star = entries.filter(F.col("agent") == "*").groupBy("host").agg(F.min("entry").alias("__default"))
    tagged = entries.join(star, "host", "left").withColumn(
        "__has_star", F.max((F.col("agent") == "*").cast("int")).over(Window.partitionBy("host", "entry")))
    kept = tagged.filter((F.col("__has_star") == 0) |
                         ((F.col("entry") == F.col("__default")) & (F.col("agent") == "*")))
    parsed_rules = kept.select("host", "entry", "agent").join(rules, ["host", "entry"])
    deny_all = robots.filter(~F.col("status").between(200, 200) &
                             ~(F.col("status").between(400, 499) & ~F.col("status").isin(401, 403))).select(
        "host", F.lit(0).alias("entry"), F.lit("*").alias("agent"), F.lit(0).alias("rule_order"),
        F.lit(False).alias("allow"), F.lit("").alias("path_prefix"))
    return parsed_rules.select("host", "entry", "agent", "rule_order", "allow", "path_prefix").unionByName(
        deny_all.select("host", F.col("entry").cast("long"), "agent", F.col("rule_order").cast("int"),
                        "allow", "path_prefix"))


def robots_filter(urls: DataFrame, rules: DataFrame, agent: str = DEFAULT_AGENT,
                  url: str = "url") -> DataFrame:
    """(url, allowed) for every URL under a robots rule table.

    ``rules(host, agent, rule_order, allow, path_prefix)``.  Per host the first
    group (by rule order) whose agent name occurs in the crawler's agent token
    applies, the ``*`` group only when none does; inside the group the first
    rule whose path is a prefix of the URL's path decides; no rule → allowed.

    Exact and pair-free: instead of pairing each URL with every rule of its
    host, each URL emits only its prefixes of the lengths that the rules of its
    host have, and those meet the rules in an equi-join on (host, prefix).
    """
    token = agent.split("/")[0].lower()
    group = "entry" if "entry" in rules.columns else "agent"   # a group of rules shares an entry
    r = rules.select(
        "host", F.col(group).alias("__g"), "agent", "rule_order", "allow",
        F.when(F.col("path_prefix") == "*", F.lit("")).otherwise(_robots_path(F.col("path_prefix"))).alias("path_prefix"),
        (F.col("agent") == "*").alias("is_default"))
    r = r.filter(F.col("is_default") | F.lit(token).contains(F.lower(F.col("agent"))))
    chosen = r.groupBy("host").agg(
        F.min_by("__g", F.struct("is_default", "rule_order")).alias("__g"))
    applicable = r.join(chosen, ["host", "__g"], "left_semi").select(
        "host", "path_prefix", "rule_order", "allow").distinct()

    # a host's prefix lengths: one short row per host, so a URL emits no more prefixes than its own host has lengths
    lengths = applicable.groupBy("host").agg(F.array_sort(F.collect_set(F.length("path_prefix"))).alias("__lengths"))
    n_rules = applicable.count()
    u = urls.select(F.col(url).alias("url")).distinct().select(
        "url", url_host(F.col("url")).alias("host"), _path_for_robots(F.col("url")).alias("__path"))
    prefixes = F.transform(F.filter("__lengths", lambda n: F.length("__path") >= n), lambda n: F.substring(F.col("__path"), F.lit(1), n))
    cand = (u.join(broadcast_if_small(lengths, n_rules), "host", "left")
            .select("url", "host", F.explode_outer(prefixes).alias("path_prefix")))
    hits = cand.join(broadcast_if_small(applicable, n_rules), ["host", "path_prefix"], "left")
    return hits.groupBy("url").agg(
        F.coalesce(F.min_by("allow", "rule_order"), F.lit(True)).alias("allowed"))


def frontier_difference(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Link targets not visited yet (distinct)."""
    return (links.select(F.col("dst").alias("url")).distinct()
            .join(visited.select("url"), "url", "left_anti"))


def frontier_step(frontier: DataFrame, visited: DataFrame, links: DataFrame,
                  rules: DataFrame | None = None, agent: str = DEFAULT_AGENT) -> DataFrame:
    """Links leaving the frontier, not yet visited, allowed by robots."""
    out = links.join(frontier.select(F.col("url").alias("src")).distinct(), "src", "left_semi")
    nxt = frontier_difference(out, visited)
    if rules is not None:
        nxt = robots_filter(nxt, rules, agent).filter("allowed").select("url")
    return nxt


def crawl_order(seeds: DataFrame, links: DataFrame, max_pages: int | None = None,
                max_depth: int | None = None, rules: DataFrame | None = None,
                agent: str = DEFAULT_AGENT, fetched: DataFrame | None = None) -> DataFrame:
    """Breadth-first reach from the seeds over a stored link table.

    Returns (url, level), all of it unless ``max_pages`` bounds it to the first
    pages in (level, url) order.  Seeds pass the robots rules like any other URL.
    With ``fetched(url, status, html)`` only pages fetched with status 200 and
    content count as visited, and only they lead further.  One join per level;
    each level is checkpointed to the shared folder, so lineage stays one level
    deep and survives executor loss; the link table is checkpointed once.
    """
    checkpoint_root(seeds.sparkSession)
    graph = links.select("src", "dst").distinct().repartition("src").checkpoint()
    usable = usable_pages(fetched).select("url").distinct().checkpoint() if fetched is not None else None

    def admitted(urls: DataFrame, level: int, room: int | None) -> DataFrame:
        if usable is not None:
            urls = urls.join(usable, "url", "left_semi").checkpoint()
        if room is not None and urls.count() > room:
            # dense url-ordered numbers from range-partitioned sorting: no single task holds the level
            urls = assign_ids(urls.select("url"), "url", id_col="__n").filter(F.col("__n") <= room).checkpoint()
        return urls.select("url", F.lit(level).alias("level"))

    first = seeds.select(F.col(seeds.columns[0]).alias("url")).distinct()
    if rules is not None:
        first = robots_filter(first, rules, agent).filter("allowed").select("url")
    tried = [first.checkpoint()]  # every url met, whether it was usable or not
    levels = [admitted(tried[0], 0, max_pages)]
    n_visited, n_new, level = 0, levels[0].count(), 0
    while n_new:
        n_visited += n_new
        if (max_pages is not None and n_visited >= max_pages) or (max_depth is not None and level >= max_depth):
            break
        level += 1
        nxt = frontier_step(levels[-1].select("url"), reduce(DataFrame.unionByName, tried), graph, rules, agent).checkpoint()
        found = admitted(nxt, level, None if max_pages is None else max_pages - n_visited)
        n_new = found.count()
        tried.append(nxt.select("url"))
        levels.append(found)
    return reduce(DataFrame.unionByName, levels)
