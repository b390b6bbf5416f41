"""The index: built in bulk, kept as segments, opened by version.

A stored index is a list of immutable segments below ``segments/`` and one small
manifest per version (``v=N/_PUBLISHED``) that names them.  A segment holds

* ``forward``   one row per new document with its sorted (term, frequency) array,
* ``postings``  (term, doc_id, frequency, total_terms) by ``term_bucket``, unscored,
* ``terms``     by how much each term's document count changes,
* ``deleted``   ids of the documents of earlier segments that it replaces,
* ``ledger``    the input files that it consumed.

Scores are not stored: df and N change with every version, so idf is applied
when postings are read (``Index.postings``), and a refresh writes no more than
its batch.  The manifest is created only if its version does not exist yet, so
of two writers one wins and the other starts again from the winner's version;
readers resolve a version once and never see a partial one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter import schema
from sifter.operators import index as ix
from sifter.sources import fs


@dataclass(frozen=True)
class Segment:
    path: str
    documents: int
    postings: int
    terms: int
    deleted: int
    buckets: int


@dataclass(frozen=True)
class Index:
    """``raw`` holds the unscored postings; ``postings`` scores them."""

    forward: DataFrame
    terms: DataFrame
    stats: DataFrame
    raw: DataFrame
    idf: str = "smoothed"
    n_terms: int | None = None        # at least the vocabulary's size, when known (broadcast check)
    path: str | None = None
    meta: dict | None = None          # the manifest
    segments: tuple[Segment, ...] = ()

    @property
    def dropped_pages(self) -> int | None:
        """Input pages that produced no document (no body / empty text), when recorded."""
        if not self.meta or self.meta.get("pages_in") is None:
            return None
        return int(self.meta["pages_in"]) - int(self.meta["documents"])

    @property
    def documents(self) -> DataFrame:
        return ix.document_stats(self.forward)

    @property
    def doc_urls(self) -> DataFrame:
        """(doc_id, url) of a stored index."""
        return self.forward.select("doc_id", "url")

    @property
    def postings(self) -> DataFrame:
        """(term, document, frequency, total_terms, tf_idf), scored as they are read."""
        return self.scored(self.raw, self.terms)

    def scored(self, raw: DataFrame, terms: DataFrame) -> DataFrame:
        return ix.score_postings(raw, terms, self.stats, self.idf, self.n_terms)

    def raw_of(self, condition: Column, buckets: Callable[[int], list[int]]) -> DataFrame:
        """Unscored postings that meet ``condition`` on the term; of a stored segment only these buckets are read."""
        if not self.segments:
            return self.raw.filter(condition)
        in_buckets = {n: buckets(n) for n in {s.buckets for s in self.segments}}
        return _live(self.spark, self.segments,
                     lambda s: _postings(self.spark, s).filter(F.col("term_bucket").isin(in_buckets[s.buckets]) & condition))

    @property
    def named_postings(self) -> DataFrame:
        """Postings with their url (a join with the documents when stored by id)."""
        if "url" in self.raw.columns:
            return self.postings
        return self.postings.join(self.doc_urls, "doc_id")

    @property
    def spark(self) -> SparkSession:
        return self.forward.sparkSession


def index_from_forward(forward: DataFrame, idf: str = "smoothed", n_terms: int | None = None) -> Index:
    """Derive terms, stats and scored postings from a forward index (lazy)."""
    tf_rows = ix.term_frequency(forward)
    terms = ix.document_frequency(tf_rows)
    stats = ix.corpus_size(ix.document_stats(forward))
    return Index(forward, terms, stats, tf_rows, idf=idf, n_terms=n_terms)


def build_index(pages: DataFrame, idf: str = "smoothed", url: str = "url", html: str = "html") -> Index:
    """Lazy bulk build (R12 → R18 → R25 → R27/R28 → R29 → R30 → R39/R40 → R41)."""
    return index_from_forward(ix.forward_from_pages(pages, url, html), idf)


# --------------------------------------------------------------------------- segments

FORWARD, TERMS, POSTINGS, DELETED, LEDGER = "forward", "terms", "postings", "deleted", "ledger"
PUBLISHED = "_PUBLISHED"
SEGMENTS = "segments"

# Target postings per term bucket when the bucket count is derived from the data.
POSTINGS_PER_BUCKET = 50_000_000
MAX_BUCKETS = 16_384


def auto_buckets(n_postings: int) -> int:
    """Bucket count so a bucket holds about POSTINGS_PER_BUCKET postings (8 … 16,384)."""
    return int(min(MAX_BUCKETS, max(8, -(-n_postings // POSTINGS_PER_BUCKET))))


def _read(spark: SparkSession, segment: Segment, table: str, columns) -> DataFrame:
    return spark.read.schema(columns).parquet(f"{segment.path}/{table}")


def _postings(spark: SparkSession, segment: Segment) -> DataFrame:
    return _read(spark, segment, POSTINGS, schema.POSTINGS)


def _deleted(spark: SparkSession, segments) -> DataFrame | None:
    """Ids of replaced documents, None when no segment names any."""
    found = [_read(spark, s, DELETED, schema.DELETED) for s in segments if s.deleted]
    return reduce(DataFrame.unionByName, found) if found else None


def _live(spark: SparkSession, segments, read: Callable[[Segment], DataFrame], naming=None) -> DataFrame:
    """Rows of all segments whose document is not replaced by one of ``naming`` (default: of the same segments)."""
    rows = reduce(DataFrame.unionByName, map(read, segments))
    naming = segments if naming is None else naming
    gone = _deleted(spark, naming)
    if gone is None:
        return rows
    return rows.join(ix.broadcast_if_small(gone, sum(s.deleted for s in naming)), "doc_id", "left_anti")


def _term_counts(spark: SparkSession, segments) -> DataFrame:
    """Document counts: the sum of what the segments changed."""
    deltas = reduce(DataFrame.unionByName, (_read(spark, s, TERMS, schema.TERMS) for s in segments))
    if len(segments) == 1:
        return deltas
    return deltas.groupBy("term").agg(F.sum("document_count").alias("document_count")).filter("document_count <> 0")


def _write_postings(rows: DataFrame, path: str, buckets: int) -> None:
    """Partitioned by ``term_bucket`` and sorted by term inside each file; AQE splits the bucket of a hot term."""
    (rows.select("term", "doc_id", "frequency", "total_terms", ix.term_bucket("term", buckets).alias("term_bucket"))
     .hint("rebalance", "term_bucket")
     .sortWithinPartitions("term_bucket", "term", "doc_id")
     .write.partitionBy("term_bucket").parquet(f"{path}/{POSTINGS}"))


def _segment(spark: SparkSession, path: str, buckets: int) -> Segment:
    """The segment just written; counts come from Parquet footers."""
    count = lambda table: spark.read.parquet(f"{path}/{table}").count() if fs.exists(spark, f"{path}/{table}") else 0
    return Segment(path, count(FORWARD), int(spark.read.schema(schema.POSTINGS).parquet(f"{path}/{POSTINGS}").count()),
                   count(TERMS), count(DELETED), buckets)


def write_segment(forward: DataFrame, root: str, first_id: int = 0, buckets: int | None = None,
                  replaced: Callable[[DataFrame], DataFrame] | None = None, ledger: DataFrame | None = None) -> tuple[Segment, int]:
    """Write the documents of ``forward`` as a new segment; returns it and the next free document id.

    The regex pipeline runs once (into ``forward``); all else is derived from the
    written table.  ``replaced`` gives, for the written forward table, the rows
    (doc_id, terms) of earlier documents that it replaces.
    """
    spark = forward.sparkSession
    path = f"{root.rstrip('/')}/{SEGMENTS}/{uuid.uuid4().hex}"
    # doc_id: unique in the index, fixed once written (postings refer to it, not to the url string)
    (forward.drop("doc_id").withColumn("doc_id", F.lit(first_id) + F.monotonically_increasing_id())
     .write.parquet(f"{path}/{FORWARD}"))
    fwd = spark.read.schema(schema.FORWARD).parquet(f"{path}/{FORWARD}")
    tf_rows = ix.term_frequency(fwd, with_url=False)
    changes = tf_rows.select("term", F.lit(1).cast("long").alias("n"))
    if replaced is not None:
        replaced(fwd).select("doc_id", "terms").write.parquet(f"{path}/{DELETED}")
        gone = spark.read.parquet(f"{path}/{DELETED}").select(F.inline("terms"))
        changes = changes.unionByName(gone.select("term", F.lit(-1).cast("long").alias("n")))
    (changes.groupBy("term").agg(F.sum("n").alias("document_count")).filter("document_count <> 0")
     .write.parquet(f"{path}/{TERMS}"))
    total, last = fwd.agg(F.sum("term_count"), F.max("doc_id")).first()
    buckets = buckets or auto_buckets(int(total or 0))
    _write_postings(tf_rows, path, buckets)
    if ledger is not None:
        ledger.write.parquet(f"{path}/{LEDGER}")
    return _segment(spark, path, buckets), first_id if last is None else int(last) + 1


# --------------------------------------------------------------------------- versions


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version}"


def manifest(spark: SparkSession, root: str, version: int) -> dict | None:
    """What a version consists of; None when it is not (wholly) published."""
    path = f"{version_path(root, version)}/{PUBLISHED}"
    text = fs.read_text(spark, path) if fs.exists(spark, path) else ""
    return json.loads(text) if text.endswith("}\n") else None


def published_versions(spark: SparkSession, root: str) -> list[int]:
    names = (name for name in fs.list_names(spark, root) if name.startswith("v="))
    return sorted(v for v in (int(n[2:]) for n in names) if manifest(spark, root, v) is not None)


def latest_version(spark: SparkSession, root: str) -> int | None:
    for v in sorted((int(n[2:]) for n in fs.list_names(spark, root) if n.startswith("v=")), reverse=True):
        if manifest(spark, root, v) is not None:
            return v
    return None


def commit(spark: SparkSession, root: str, version: int, segments: list[Segment], documents: int, next_id: int, idf: str,
           ledgers: list[str], pages_in: int | None = None, tag: str = "") -> Index | None:
    """Publish a version; None when another writer has published it first."""
    found = {"version": version, "idf": idf, "documents": documents, "next_id": next_id, "pages_in": pages_in, "tag": tag,
             "segments": [asdict(s) for s in segments], "ledgers": ledgers}
    if not fs.create_new(spark, f"{version_path(root, version)}/{PUBLISHED}", json.dumps(found) + "\n"):
        return None
    return read_index_tables(spark, root, version)


def read_index_tables(spark: SparkSession, root: str, version: int) -> Index:
    """Open a published version (column pruning and partition pruning apply)."""
    meta = manifest(spark, root, version)
    if meta is None:
        raise ValueError(f"{root} has no published version {version}")
    segments = tuple(Segment(**s) for s in meta["segments"])
    return Index(
        forward=_live(spark, segments, lambda s: _read(spark, s, FORWARD, schema.FORWARD)),
        terms=_term_counts(spark, segments),
        stats=spark.range(1).select(F.lit(meta["documents"]).cast("long").alias("total_documents")),
        raw=_live(spark, segments, lambda s: _postings(spark, s).drop("term_bucket")),
        idf=meta["idf"], n_terms=sum(s.terms for s in segments), path=root, meta=meta, segments=segments)


def open_index(spark: SparkSession, root: str) -> Index | None:
    """The last published version, resolved once by the caller."""
    v = latest_version(spark, root)
    return None if v is None else read_index_tables(spark, root, v)


def consumed(spark: SparkSession, root: str) -> DataFrame:
    """The input files (``path``) that the last published version of ``root`` has consumed."""
    v = latest_version(spark, root)
    ledgers = [] if v is None else manifest(spark, root, v)["ledgers"]
    return spark.read.schema(schema.LEDGER).parquet(*ledgers) if ledgers else spark.createDataFrame([], schema.LEDGER)


def replace_all(forward: DataFrame, root: str, idf: str = "smoothed", buckets: int | None = None, pages_in: int | None = None) -> Index:
    """Publish a next version that consists of ``forward`` alone; what was consumed stays so."""
    spark = forward.sparkSession
    segment, next_id = write_segment(forward, root, 0, buckets)
    while True:  # another writer's version in between is replaced as well
        v = latest_version(spark, root)
        ledgers = [] if v is None else manifest(spark, root, v)["ledgers"]
        idx = commit(spark, root, 0 if v is None else v + 1, [segment], segment.documents, next_id, idf, ledgers, pages_in)
        if idx is not None:
            return idx


def write_index_tables(forward: DataFrame, path: str, idf: str = "smoothed",
                       buckets: int | None = None, pages_in: int | None = None) -> Index:
    """Persist an index of ``forward`` under ``path``."""
    return replace_all(forward, path, idf, buckets, pages_in)


def scan_postings(index: Index) -> DataFrame:
    """Full scan of (term, url, frequency); Parquet reads only the needed columns."""
    rows = index.raw if "url" in index.raw.columns else index.raw.join(index.doc_urls, "doc_id")
    return rows.select("term", "url", "frequency")


def bulk_build(pages: DataFrame, root: str, idf: str = "smoothed", buckets: int | None = None,
               url: str = "url", html: str = "html") -> Index:
    """Bulk build into the next version of ``root`` and publish it.

    Of pages that repeat a url one is indexed, as in a refresh.
    """
    n_in = pages.count()  # pages without a body are dropped; the difference is kept as a metric
    return replace_all(ix.latest_forward(pages, url, html), root, idf, buckets, n_in)


def score_matrix(index: Index, idf: str | None = None) -> DataFrame:
    """Every posting scored (set-based, one join with the vocabulary); nothing is rewritten."""
    return ix.score_postings(index.raw, index.terms, index.stats, idf or index.idf, index.n_terms)


# --------------------------------------------------------------------------- compaction

# Segments of about equal size that are merged into one; each posting is rewritten once per size class.
FAN = 8


def due(segments, fan: int = FAN) -> list[Segment]:
    """Segments to merge: those up to the largest size class that has ``fan`` members, or all when most documents are replaced."""
    size_class = lambda s: next(c for c in range(64) if s.postings < fan ** (c + 1))
    if 2 * sum(s.deleted for s in segments) > sum(s.documents for s in segments):
        return list(segments)
    classes = [size_class(s) for s in segments]
    full = [c for c in set(classes) if classes.count(c) >= fan]
    return [s for s, c in zip(segments, classes, strict=True) if full and c <= max(full)]


def compact(spark: SparkSession, root: str, fan: int = FAN) -> Index | None:
    """Merge segments that are ``due`` into one; document ids stay.  None when there is nothing to do or another writer was first."""
    idx = open_index(spark, root)
    merged = due(idx.segments, fan) if idx is not None else []
    if not merged:
        return None
    path = f"{root.rstrip('/')}/{SEGMENTS}/{uuid.uuid4().hex}"
    every = _live(spark, merged, lambda s: _read(spark, s, FORWARD, schema.FORWARD), idx.segments)
    every.write.parquet(f"{path}/{FORWARD}")
    deltas = reduce(DataFrame.unionByName, (_read(spark, s, TERMS, schema.TERMS) for s in merged))
    (deltas.groupBy("term").agg(F.sum("document_count").alias("document_count")).filter("document_count <> 0")
     .write.parquet(f"{path}/{TERMS}"))
    others = [s for s in idx.segments if s not in merged]
    gone = _deleted(spark, merged)
    if gone is not None and others:  # only what others hold has to be remembered
        held = reduce(DataFrame.unionByName, (_read(spark, s, FORWARD, schema.FORWARD).select("doc_id") for s in others))
        gone.join(held, "doc_id", "left_semi").write.parquet(f"{path}/{DELETED}")
    buckets = max(s.buckets for s in merged)
    _write_postings(_live(spark, merged, lambda s: _postings(spark, s), idx.segments), path, buckets)
    ledgers = idx.meta["ledgers"]
    if len(ledgers) >= fan:
        spark.read.schema(schema.LEDGER).parquet(*ledgers).write.parquet(f"{path}/{LEDGER}")
        ledgers = [f"{path}/{LEDGER}"]
    return commit(spark, root, idx.meta["version"] + 1, [_segment(spark, path, buckets), *others], idx.meta["documents"],
                  idx.meta["next_id"], idx.idf, ledgers, idx.meta["pages_in"], idx.meta["tag"])
