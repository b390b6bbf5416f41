"""Personal data by patterns and information-theoretic sanitisation (operator 9).

Patterns find the protected entities (e-mail and IP addresses, card and phone
numbers) in every whole text.  The words around each entity are its context.
Over the whole corpus, with c(t) the occurrences of a term, c(t, e) those of the
term in contexts of the entity, and p the share of all words that stand in
contexts of the entity, a term discloses an entity by

    share    = c(t, e) / c(t)                     how often the term points to the entity
    evidence = c(t, e) * log2(share / p)          bits by which that is no accident

Neither shrinks with the entity's own frequency.  A term seen in at least
``MIN_SUPPORT`` contexts of an entity, with at least ``MIN_EVIDENCE``, is
generalised at a share of ``GENERALISE`` and removed at ``REMOVE`` and above, in
the documents that hold the entity, where it stands in its context.  So an entity
that occurs once or twice has no disclosing terms: two occurrences side by side
tell nothing.  A text without an entity is never changed.

Counts are summed per task before they are shuffled; the terms, not the texts,
move.  Defined results: a null or empty text has no spans; equal rows get equal
spans; a null doc_id stays null; an empty table gives an empty result; other
input columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sifter.llm.common import free_name, slices, store, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Words on each side of an entity that are its context.
CONTEXT = 5
MIN_SUPPORT, MIN_EVIDENCE, GENERALISE, REMOVE = 3, 8.0, 0.5, 0.9
#: Distinct terms a task counts before it hands them on.
COUNT_TERMS = 300_000

# The patterns of the entities; possessive where that changes no match, to stay linear.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, normalised value) by kind, then start."""
    found = [("email", s, e, text[s:e].lower()) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            found.append(("ip", m.start(), m.end(), ".".join(parts)))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end(), digits))
    for m in _PHONE.finditer(text) if "+" in text else ():
        digits = re.sub(r"[^0-9]", "", m[0])
        if 8 <= len(digits) <= 15:
            found.append(("phone", m.start(), m.end(), digits))
    return found


def contexts(text: str, spans: list[tuple[str, int, int, str]]) -> list[tuple[str, str, int, int]]:
    """(entity, term, start, end) of the words around each span; words inside spans are none."""
    if not spans:
        return []
    covered = sorted((s, e) for _, s, e, _ in spans)
    words, i = [], 0
    for m in _WORD.finditer(text):
        while i < len(covered) and covered[i][1] <= m.start():
            i += 1
        if not any(s < m.end() and e > m.start() for s, e in covered[i:i + len(KINDS)]):
            words.append((m.start(), m.end()))
    starts = [s for s, _ in words]
    out = {}
    for kind, s, e, value in spans:
        near = words[max(0, bisect_left(starts, s) - CONTEXT):][: min(CONTEXT, bisect_left(starts, s))]
        near += words[bisect_left(starts, e):][:CONTEXT]
        for a, b in near:
            out[f"{kind}:{value}", text[a:b].lower(), a, b] = None
    return list(out)


def joined(spans: Iterable[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in spans)


def find(docs: DataFrame) -> DataFrame:
    """Stored: per row the base spans and the context of each entity."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in slices(batch, "text"):
                texts = texts_of(part)
                spans = [base_spans(t) for t in texts]
                counts = [Counter(k for k, *_ in s) for s in spans]
                near = [[dict(zip(("entity", "term", "start", "end"), c, strict=True)) for c in contexts(t, s)]
                        for t, s in zip(texts, spans, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"),
                     *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS),
                     pa.array([joined(s) for s in spans], pa.string()),
                     pa.array([[f"{k}:{v}" for k, _, _, v in s] for s in spans], pa.list_(pa.string())), pa.array(near, context)],
                    names=["doc_id", "text_hash", *(f"n_{k}" for k in KINDS), "base", "entities", "context"])

    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    kind = dict(base.dtypes)["doc_id"]
    return store(base.mapInArrow(
        scan, f"doc_id {kind}, text_hash long, {', '.join(f'n_{k} long' for k in KINDS)}, base string, entities array<string>, "
              "context array<struct<entity:string,term:string,start:int,end:int>>"), "pii-found")


def term_counts(docs: DataFrame) -> DataFrame:
    """Occurrences of every term in all texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for text in texts_of(part):
                    seen.update(_WORD.findall(text.lower()))
                if len(seen) > COUNT_TERMS:
                    yield _counted(seen)
                    seen.clear()
        if seen:
            yield _counted(seen)

    return docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])


def disclosures(found: DataFrame, counts: DataFrame, min_support: int = MIN_SUPPORT, min_evidence: float = MIN_EVIDENCE,
                generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """entity, term, share, evidence, action of the disclosing terms."""
    near = found.select(F.explode("context").alias("c")).select("c.entity", "c.term")
    n_near = near.groupBy("entity").agg(F.count(F.lit(1)).alias("n_near"))
    total = counts.agg(F.sum("n_term").alias("total"))
    both = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")).filter(F.col("n_both") >= min_support)
    told = (both.join(counts, "term").join(n_near, "entity").crossJoin(F.broadcast(total))  # one row
            .withColumn("share", F.col("n_both") / F.col("n_term"))
            .withColumn("evidence", F.col("n_both") * F.log2(F.col("share") * F.col("total") / F.col("n_near"))))
    return (told.filter((F.col("evidence") >= min_evidence) & (F.col("share") >= generalise))
            .select("entity", "term", "share", "evidence", F.when(F.col("share") >= remove, "removed").otherwise("generalised").alias("action")))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row: counts and digest of the base spans, and all spans with the disclosing terms (``term``) behind them."""
    found = find(docs)
    risky = store(disclosures(found, term_counts(docs)), "pii-disclosures")
    spans = (found.select("doc_id", "text_hash", F.explode("context").alias("c")).select("doc_id", "text_hash", "c.*")
             .join(risky.select("entity", "term", "action"), ["entity", "term"])
             .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(F.struct("start", "end", "action"))).alias("terms")))
    named = spans.withColumnsRenamed({"doc_id": "of_doc", "text_hash": "of_text"})
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text"))
    # a term near two entities has one span; the stronger action holds
    ends = F.array_distinct(F.transform(F.col("terms"), lambda t: F.concat_ws(":", F.lit("term"), t.start, t.end)))
    removed = F.array_distinct(F.transform(F.filter("terms", lambda t: t.action == "removed"), lambda t: F.concat_ws(":", t.start, t.end)))
    terms = F.coalesce(ends, F.array().cast("array<string>"))
    return found.join(named, same, "left").select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"),
        F.array_join(F.concat(F.filter(F.array("base"), lambda b: b != ""), terms), ",").alias("spans"),
        F.array_size(terms).cast("long").alias("n_term"),
        F.coalesce(F.array_size(removed), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(removed, ","), F.lit("")).alias("removed"), "text_hash")


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents' columns with the text rewritten: entities and generalised terms become their kind, removed terms go."""
    spans = personal_data(docs).select("doc_id", "text_hash", "spans", "removed").distinct()
    doc, own, other, found, gone = (free_name(docs, n) for n in ("__doc", "__own", "__other", "__spans", "__removed"))
    keyed = docs.withColumn(own, F.xxhash64("text"))
    named = spans.withColumnsRenamed({"doc_id": doc, "text_hash": other, "spans": found, "removed": gone})
    both = keyed.join(named, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(other)), "left")

    @F.pandas_udf("string")
    def rewrite(text: pd.Series, spans: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([rewritten(*row) for row in zip(text, spans, removed, strict=True)], dtype=object)

    return both.withColumn("text", rewrite("text", found, gone)).select(docs.columns)


def rewritten(text: str | None, spans: str | None, removed: str | None) -> str | None:
    if not spans or text is None:
        return text
    gone = set((removed or "").split(","))
    parts, at = [], 0
    for start, end, kind in sorted(((int(s), int(e), k) for k, s, e in (x.split(":") for x in spans.split(","))), key=lambda x: (x[0], -x[1])):
        if start >= at:
            parts += [text[at:start], "" if kind == "term" and f"{start}:{end}" in gone else f"[{kind.upper()}]"]
            at = end
    return "".join([*parts, text[at:]])
