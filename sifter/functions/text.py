"""HTML → text → tokens as native Column expressions.

Every function maps Column → Column and stays inside whole-stage codegen
(regex and string built-ins only, no Python UDF).  Applied in this order they
reproduce the reference's document parser byte for byte on valid UTF-8.
"""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from sifter.functions._util import col

# ---------------------------------------------------------------------------
# These must equal the reference's behaviour exactly.
#   script/style block  <(script|style)[^>]*>[\s\S]*?</\1>   case-insensitive, lazy
#   body                <body[^>]*>([\s\S]*?)</body>          case-insensitive, first only
#   comment             <!--.*?-->   '.' stops at line ends → [^\n\r]
#   tag                 <[^>]*>      replaced by one space
#   entities            &lt; &gt; &quot; &apos; &amp;  (the only five decoded;
#                       the reference's order is unspecified, we fix amp last)
#   whitespace          \s = space \t \n \v \f \r  (C-locale isspace)
#   punctuation         the 32 ASCII ispunct characters = Java \p{Punct}
#   case                ASCII A-Z → a-z only
# ---------------------------------------------------------------------------
SCRIPT_STYLE_PATTERN = r"(?i)<(script|style)[^>]*>[\s\S]*?</\1>"
BODY_PATTERN = r"(?i)<body[^>]*>([\s\S]*?)</body>"
COMMENT_PATTERN = r"<!--[^\n\r]*?-->"
TAG_PATTERN = r"<[^>]*>"
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
WHITESPACE_PATTERN = r"\s+"
PUNCT_PATTERN = r"\p{Punct}"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def strip_script_style(c) -> Column:
    """Delete <script…>…</script> and <style…>…</style> blocks."""
    return F.regexp_replace(col(c), SCRIPT_STYLE_PATTERN, "")


def extract_body(c) -> Column:
    """Content of the first <body…>…</body>; '' when there is none."""
    return F.regexp_extract(col(c), BODY_PATTERN, 1)


def strip_comments(c) -> Column:
    """Delete one-line <!--…--> comments (multi-line ones are left)."""
    return F.regexp_replace(col(c), COMMENT_PATTERN, "")


def strip_tags(c) -> Column:
    """Every tag becomes one space."""
    return F.regexp_replace(col(c), TAG_PATTERN, " ")


def decode_entities(c) -> Column:
    """The five named entities, one left-to-right pass each."""
    out = col(c)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


@cache
def _reference_names() -> str:
    """Characters of the named references of HTML, from the standard library's table, as JSON."""
    return json.dumps({name[:-1]: chars for name, chars in html5.items() if name.endswith(";")})


def decode_references(c) -> Column:
    """Character references with a semicolon, named and numeric, as an attribute value has them.

    Those that stand for an ampersand come last, so that what they leave is not decoded again.
    """
    def numeric(ref: Column) -> Column:
        hexed = F.lower(ref.substr(1, 1)) == "x"
        code = F.when(hexed, F.conv(F.substring(ref, 2, 8), 16, 10)).otherwise(F.conv(F.substring(ref, 1, 8), 10, 10)).cast("long")
        valid = ((code > 0) & (code < 0xD800)) | code.between(0xE000, 0x10FFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")

    def decoded(text: Column) -> Column:
        names = F.from_json(F.lit(_reference_names()), "map<string,string>")  # folded to one literal
        found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"&(#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);"), 1))
        known = F.filter(F.transform(found, lambda r: F.struct(
            r.alias("ref"), F.when(r.startswith("#"), numeric(F.substring(r, 2, 16))).otherwise(F.try_element_at(names, r)).alias("chars"))),
            lambda r: r.chars.isNotNull())
        ordered = F.concat(F.filter(known, lambda r: r.chars != "&"), F.filter(known, lambda r: r.chars == "&"))
        return F.aggregate(ordered, text, lambda t, r: F.replace(t, F.concat(F.lit("&"), r.ref, F.lit(";")), r.chars))

    text = col(c)
    return F.when(text.contains("&"), decoded(text)).otherwise(text)


def collapse_whitespace(c) -> Column:
    """Runs of whitespace → one space, no trim."""
    return F.regexp_replace(col(c), WHITESPACE_PATTERN, " ")


def ascii_lower(c) -> Column:
    """ASCII-only lower-casing (É stays É); not ``lower()``."""
    return F.translate(col(c), ASCII_UPPER, ASCII_LOWER)


def html_to_text(c) -> Column:
    """R05 → R06 → R07 → R08 → R09 → R10 → R11 as one projection."""
    out = strip_script_style(c)
    out = extract_body(out)
    out = strip_comments(out)
    out = strip_tags(out)
    out = decode_entities(out)
    out = collapse_whitespace(out)
    return ascii_lower(out)


def strip_punctuation(c) -> Column:
    """Delete ASCII punctuation (inside words: don't → dont, 3.14 → 314)."""
    return F.regexp_replace(col(c), PUNCT_PATTERN, "")


def tokenize(c) -> Column:
    """Whitespace split, punctuation deleted, empty words dropped.

    Deleting punctuation from the whole text before splitting is the same as
    deleting it per word (punctuation never touches whitespace) and costs one
    regex pass per document instead of one per word.
    """
    return F.filter(F.split(strip_punctuation(c), WHITESPACE_PATTERN), lambda w: w != "")


def tokenize_query(c, normalize: bool = False) -> Column:
    """Whitespace split only; case, punctuation and duplicates kept.

    ``normalize=True`` applies the document rules (R11 + R25) instead.
    """
    if normalize:
        return tokenize(ascii_lower(c))
    return F.filter(F.split(col(c), WHITESPACE_PATTERN), lambda w: w != "")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it several times inside ``body``.

    ``transform(array(value), v -> body(v))[0]``: the optimizer may inline
    projections into their consumers, but a lambda variable is evaluated
    once, so an expensive value (the sorted token array of a 20,000-word
    page) is never recomputed per reference.
    """
    return F.get(F.transform(F.array(value), body), 0)


def run_starts(sorted_tokens: Column) -> Column:
    """0-based positions where a sorted array starts a new value."""
    s = sorted_tokens
    return F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(s) - 1, F.lit(0))),
        lambda i: (i < F.size(s)) & ((i == 0) | (F.get(s, i) != F.get(s, i - 1))),
    )


def document_terms(text) -> Column:
    """Struct(term_count, total_terms, terms ARRAY<STRUCT<term, frequency>>) of one text.

    Sort the tokens once, mark where a new term starts and take the distance
    to the next start: O(n log n) per document inside one projection, so the
    per-document counts need no shuffle.  ``terms`` is sorted by term.
    """
    def counts(s: Column) -> Column:
        return let(run_starts(s), lambda st: F.struct(
            F.size(st).cast("long").alias("term_count"),
            F.size(s).cast("long").alias("total_terms"),
            F.transform(st, lambda i, k: F.struct(
                F.get(s, i).alias("term"),
                (F.coalesce(F.get(st, k + 1), F.size(s)) - i).cast("long").alias("frequency"),
            )).alias("terms"),
        ))
    # no word is null; sort_array compares words directly, array_sort by an interpreted lambda
    return let(F.sort_array(tokenize(text)), counts)
