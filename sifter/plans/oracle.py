"""DuckDB SQL for the oracle side of the correctness check.

Written independently of the Spark plans: RE2 has no back-references, so the
script/style rule spells out both tag names; ``\\s`` of RE2 lacks the vertical
tab, so the whitespace class is written out.
"""

from __future__ import annotations

S_SCRIPT = r"(?i)<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>"
S_BODY = r"(?i)<body[^>]*>([\s\S]*?)</body>"
S_COMMENT = r"<!--[^\n\r]*?-->"
S_TAG = r"<[^>]*>"
S_WS = r"[\t\n\x0B\f\r ]+"
S_PUNCT = r"[[:punct:]]"
UP, LO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def strip_script_style(x: str) -> str:
    return f"regexp_replace({x}, '{S_SCRIPT}', '', 'g')"


def extract_body(x: str) -> str:
    return f"regexp_extract({x}, '{S_BODY}', 1)"


def strip_comments(x: str) -> str:
    return f"regexp_replace({x}, '{S_COMMENT}', '', 'g')"


def strip_tags(x: str) -> str:
    return f"regexp_replace({x}, '{S_TAG}', ' ', 'g')"


def decode_entities(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), "
            f"'&quot;', '\"'), '&apos;', ''''), '&amp;', '&')")


def collapse_whitespace(x: str) -> str:
    return f"regexp_replace({x}, '{S_WS}', ' ', 'g')"


def ascii_lower(x: str) -> str:
    return f"translate({x}, '{UP}', '{LO}')"


def html_to_text(x: str) -> str:
    return ascii_lower(collapse_whitespace(decode_entities(strip_tags(strip_comments(
        extract_body(strip_script_style(x)))))))


def tokens(x: str) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace({x}, '{S_PUNCT}', '', 'g'), '{S_WS}'), "
            f"lambda w: w <> '')")


def query_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{S_WS}'), lambda w: w <> '')"


def index_ctes(src: str = "pages", url: str = "url", html: str = "html", idf: str = "smoothed",
               prefix: str = "") -> str:
    """CTEs ``{p}docs {p}toks {p}documents {p}tf {p}stats {p}terms {p}postings`` over ``src``."""
    p = prefix
    if idf == "smoothed":
        idf_expr = "ln(s.total_documents::DOUBLE / (t.document_count + 1))"
    else:
        idf_expr = "ln(s.total_documents::DOUBLE)"
    return f"""
{p}docs AS (SELECT {url} AS url, {html_to_text(html)} AS text FROM {src}),
{p}toks AS (SELECT url, {tokens('text')} AS tokens FROM {p}docs WHERE text <> ''),
{p}documents AS (SELECT url, CAST(len(list_distinct(tokens)) AS BIGINT) AS term_count,
                        CAST(len(tokens) AS BIGINT) AS total_terms FROM {p}toks),
{p}tf AS (SELECT url, term, CAST(count(*) AS BIGINT) AS frequency
          FROM (SELECT url, unnest(tokens) AS term FROM {p}toks) GROUP BY url, term),
{p}stats AS (SELECT CAST(count(*) AS BIGINT) AS total_documents FROM {p}documents),
{p}terms AS (SELECT term, CAST(count(*) AS BIGINT) AS document_count FROM {p}tf GROUP BY term),
{p}postings AS (
    SELECT f.term, f.url, f.frequency, d.total_terms,
           (f.frequency::DOUBLE / d.total_terms) * {idf_expr} AS tf_idf
    FROM {p}tf f JOIN {p}documents d USING (url) JOIN {p}terms t USING (term) CROSS JOIN {p}stats s)"""


def with_index(sql: str, *fixtures: str, src: str = "pages", idf: str = "smoothed") -> str:
    from sifter.plans.fixtures import FIXTURE_SQL
    parts = [f"{n} AS ({FIXTURE_SQL[n]})" for n in fixtures]
    parts.append(index_ctes(src=src, idf=idf).strip())
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()


def url_decode_lenient(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def query_param(x: str, name: str = "query") -> str:
    pre = f"{name}="
    return (f"substr(list_filter(string_split(substr({x}, instr({x}, '?') + 1), '&'), "
            f"lambda p: starts_with(p, '{pre}'))[-1], {len(pre) + 1})")


# --------------------------------------------------------------------------- URLs and links

SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
HOST_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
RELATIVE = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms",
            "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")
SKIP_RE = r"(?i)<script[^>]*>[\s\S]*?</script>|<style[^>]*>[\s\S]*?</style>|<!--[\s\S]*?-->"
_WS = r"[\t\n\x0B\f\r ]"
# what may stand in front of href: a quoted or bare value behind "=", or any other character but ">"
_FRONT = rf"(?:={_WS}*\"[^\"]*\"|={_WS}*''[^'']*''|={_WS}*[^\t\n\x0B\f\r \"''>]|[^>=])*?"
ANCHOR_RE = (rf"(?i)<a{_WS}(?:{_FRONT}{_WS})?href{_WS}*={_WS}*"
             r"(\"[^\"]*\"|''[^'']*''|[^\t\n\x0B\f\r \"''>]+)")


def host(x: str) -> str:
    return f"regexp_extract({x}, '{HOST_RE}', 1)"


def _unsplit(scheme: str, netloc: str, path: str, query: str, frag: str) -> str:
    pth = f"(CASE WHEN {path} <> '' AND NOT starts_with({path}, '/') THEN '/' || {path} ELSE {path} END)"
    out = f"(CASE WHEN {netloc} <> '' OR {scheme} <> '' THEN '//' || {netloc} || {pth} ELSE {path} END)"
    out = f"(CASE WHEN {scheme} <> '' THEN {scheme} || ':' || {out} ELSE {out} END)"
    out = f"(CASE WHEN {query} <> '' THEN {out} || '?' || {query} ELSE {out} END)"
    return f"(CASE WHEN {frag} <> '' THEN {out} || '#' || {frag} ELSE {out} END)"


def resolve_sql(pairs: str, p: str = "rz_") -> str:
    """Subquery (src, href, dst) with dst = urljoin(src, href) for the distinct pairs of a subquery.

    Each step is materialized: DuckDB would otherwise copy the expressions of
    every alias into the next and spend its time planning.
    """
    base, href, out, items = "src", "href", "dst", []
    for side, x in (("b", base), ("h", href)):
        s = f"{p}{side}_"
        items += [
            f"lower(regexp_extract({x}, '{SCHEME_RE}', 1)) AS {s}scheme",
            f"CASE WHEN {s}scheme = '' THEN {x} ELSE substr({x}, length({s}scheme) + 2) END AS {s}rest",
            f"starts_with({s}rest, '//') AS {s}hasnet",
            f"CASE WHEN {s}hasnet THEN regexp_extract({s}rest, '^//([^/?#]*)', 1) ELSE '' END AS {s}netloc",
            rf"CASE WHEN {s}hasnet THEN regexp_extract({s}rest, '^//[^/?#]*([\s\S]*)$', 1) ELSE {s}rest END AS {s}after",
            rf"regexp_extract({s}after, '#([\s\S]*)$', 1) AS {s}fragment",
            f"regexp_extract({s}after, '^([^#]*)', 1) AS {s}nofrag",
            rf"regexp_extract({s}nofrag, '\?([\s\S]*)$', 1) AS {s}query",
            f"regexp_extract({s}nofrag, '^([^?]*)', 1) AS {s}path",
        ]
    b, h = f"{p}b_", f"{p}h_"
    rel = ", ".join(f"'{r}'" for r in RELATIVE)
    items += [
        f"CASE WHEN {h}scheme = '' THEN {b}scheme ELSE {h}scheme END AS {p}scheme",
        f"({p}scheme <> {b}scheme OR {p}scheme NOT IN ({rel})) AS {p}other",
        rf"regexp_extract({b}path, '^([\s\S]*/)', 1) AS {p}bdir",
        f"string_split({p}bdir || {h}path, '/') AS {p}rs0",
        f"CASE WHEN len({p}rs0) > 2 THEN list_slice({p}rs0, 1, 1) || "
        f"list_filter(list_slice({p}rs0, 2, len({p}rs0) - 1), lambda q: q <> '') || "
        f"list_slice({p}rs0, len({p}rs0), len({p}rs0)) ELSE {p}rs0 END AS {p}rs",
        f"CASE WHEN starts_with({h}path, '/') THEN string_split({h}path, '/') ELSE {p}rs END AS {p}segs",
        f"list_reduce({p}segs, lambda acc, sg: CASE WHEN sg = '..' THEN list_slice(acc, 1, greatest(len(acc) - 1, 0)) "
        f"WHEN sg = '.' THEN acc ELSE list_append(acc, sg) END, []::VARCHAR[]) AS {p}kept0",
        f"CASE WHEN {p}segs[-1] IN ('.', '..') THEN list_append({p}kept0, '') ELSE {p}kept0 END AS {p}kept",
        f"CASE WHEN array_to_string({p}kept, '/') = '' THEN '/' ELSE array_to_string({p}kept, '/') END AS {p}joined",
    ]
    final = (f"CASE WHEN {base} IS NULL OR {href} IS NULL THEN NULL "
             f"WHEN {base} = '' THEN {href} WHEN {href} = '' THEN {base} "
             f"WHEN {p}other THEN {href} "
             f"WHEN {h}netloc <> '' THEN {_unsplit(p + 'scheme', h + 'netloc', h + 'path', h + 'query', h + 'fragment')} "
             f"WHEN {h}path = '' THEN {_unsplit(p + 'scheme', b + 'netloc', b + 'path', f'(CASE WHEN {h}query = {chr(39)}{chr(39)} THEN {b}query ELSE {h}query END)', h + 'fragment')} "
             f"ELSE {_unsplit(p + 'scheme', b + 'netloc', p + 'joined', h + 'query', h + 'fragment')} END AS {out}")
    steps = [f"{p}0 AS MATERIALIZED (SELECT DISTINCT src, href FROM {pairs})"]
    steps += [f"{p}{i} AS MATERIALIZED (SELECT *, {item} FROM {p}{i - 1})" for i, item in enumerate(items, 1)]
    return f"(WITH {', '.join(steps)} SELECT src, href, {final} FROM {p}{len(items)})"


def unquote(x: str) -> str:
    return (f"CASE WHEN starts_with({x}, '\"') OR starts_with({x}, '''') "
            f"THEN substr({x}, 2, length({x}) - 2) ELSE {x} END")


def links_sql(src_table: str = "pages") -> str:
    """Subquery text of the distinct (src, href, dst) anchors of ``src_table``."""
    return resolve_sql(hrefs_sql(src_table))


def hrefs_sql(src_table: str = "pages") -> str:
    """Subquery text of the (src, href) anchors of ``src_table``."""
    return f"""(SELECT src, {decode_entities(unquote('raw'))} AS href FROM (
        SELECT url AS src, unnest(regexp_extract_all(regexp_replace(html, '{SKIP_RE}', '', 'g'), '{ANCHOR_RE}', 1)) AS raw
        FROM {src_table}))"""


def robots_allowed_sql(urls: str, rules: str = "robots_rules", agent: str = "MyCrawler") -> str:
    """(url, allowed) by brute force over every rule of the URL's host."""
    token = agent.split("/")[0].lower()
    return f"""(
  WITH r AS (SELECT host, agent, rule_order, allow,
                    CASE WHEN path_prefix = '*' THEN '' ELSE url_decode(path_prefix) END AS path_prefix,
                    agent = '*' AS is_default
             FROM {rules} WHERE agent = '*' OR contains('{token}', lower(agent))),
       chosen AS (SELECT host, arg_min(agent, (CASE WHEN is_default THEN 1 ELSE 0 END) * 1000000000 + rule_order) AS agent
                  FROM r GROUP BY host),
       app AS (SELECT r.* FROM r JOIN chosen USING (host, agent)),
       u AS (SELECT DISTINCT url, {host('url')} AS h,
                    CASE WHEN regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([\\s\\S]*)$', 1) = '' THEN '/'
                         ELSE url_decode(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*([\\s\\S]*)$', 1)) END AS p
             FROM {urls})
  SELECT u.url, coalesce(arg_min(app.allow, app.rule_order) FILTER (WHERE starts_with(u.p, app.path_prefix)), true) AS allowed
  FROM u LEFT JOIN app ON app.host = u.h GROUP BY u.url)"""
