"""Language identification by hierarchical discrimination (operator 10).

A text is a bag of the hashed character n-grams of its words, scaled to sum
one.  A linear classifier per language family decides the family first; inside
it one-versus-one linear support vector machines separate the languages, and
the language with most votes (then the larger sum of margins) is predicted.

The classifiers are fitted on a bounded sample: at most ``SAMPLE_PER_LANG``
labelled rows, whole texts, of every label, taken by the hash of doc_id from rows
whose crc32(doc_id as text) mod 4 is not ``HELD_OUT``; rows equal in label, doc_id and
text count once.  Every classifier is fitted in a task of its own: a pair of languages on
all sampled rows of the two, a family on up to ``FAMILY_ROWS`` of its rows against those
of other families among ``SHARED_ROWS`` rows that all labels share evenly.  Only
the weights come to the driver, one column per family and pair.  A prediction reads the text alone.

A text whose n-grams are too rare in the sample for its predicted language has a
score under ``LEAST_SCORE``: the mean log share of its n-grams is held against
that of the language's sampled rows, each third of them by n-gram shares counted over
the other two thirds.  The spread grows as a text gets shorter, so a few words are seldom
rejected; a language with under ``LEAST_USUAL`` such rows rejects nothing.

Defined results: ``und`` with score 0 for a null text or one without a letter
(also when no label could be learned); one learned label is predicted with
score 1; a row without doc_id is not held out and is not learned from; rows
repeated give repeated rows; an empty table gives an empty result; other input
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations, islice

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sifter.llm.common import lean, slices, store

#: Languages and the family that a first step tells apart.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "uk": "slavic", "bg": "slavic", "pl": "slavic", "cs": "slavic", "sk": "slavic",
    "fi": "uralic", "et": "uralic", "hu": "uralic", "tr": "turkic", "az": "turkic",
}
SAMPLE_PER_LANG = 300
#: Rows of a family, and rows over all labels, that a family's classifier is fitted on.
FAMILY_ROWS, SHARED_ROWS = 1_000, 2_000
HELD_OUT = 2
DIMENSIONS = 8192
MAX_GRAM = 4
UNDETERMINED = "und"
#: Score under which the pipeline rejects a document.
LEAST_SCORE = 0.2
#: Rows that tell what is usual for a language, standard deviations below it that pass, n-grams that count as one draw.
LEAST_USUAL, DEVIATIONS, OVERLAP = 30, 6.0, 8
#: Distinct words a task remembers before it starts anew, and sums of weights it holds for them.
CACHE_WORDS, CACHE_SUMS = 300_000, 30_000_000
#: Bytes of text cut into words at a time for a prediction.
TEXT_BYTES = 1 << 20
#: Sums of weights looked up at once for new words.
LOOKUP_SUMS = 200_000
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def fold():
    """Remainder of crc32(doc_id as text) by 4."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def word_grams(word: str) -> list[int]:
    """Hashed n-grams of a word with its two ends marked."""
    marked = f"<{word}>".encode()
    return [zlib.crc32(marked[i:i + n]) % DIMENSIONS for n in range(1, MAX_GRAM + 1) for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Weights (DIMENSIONS + bias, classifiers): families first, then pairs of languages, then the log shares of n-grams.

    ``usual`` has per language mean and variance of the rows' log shares, the variance inside a row, and the deviations allowed.
    """

    langs: list[str]
    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    usual: dict[str, tuple[float, float, float, float]] = field(default_factory=dict)
    words: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        family = {m: f for f, members in self.members.items() for m in members}
        self._pairs_of: dict[str, list[int]] = {f: [] for f in self.families}
        for at, (a, _) in enumerate(self.pairs):
            self._pairs_of[family[a]].append(at)

    # -- prediction ---------------------------------------------------------

    def scores(self, counted: list[list[str]]) -> np.ndarray:
        """Scores (texts, classifiers) of lists of words; a text's n-grams are those of its words."""
        wide = self.weights.shape[1]
        if len(self.words) > min(CACHE_WORDS, CACHE_SUMS // wide) or not hasattr(self, "_sums"):
            self.words = {}
            self._sums = np.zeros((0, wide), dtype=np.float32)
            self._grams = np.zeros(0, dtype=np.float32)
        before = len(self.words)
        for ws in counted:
            for w in ws:
                if w not in self.words:
                    self.words[w] = len(self.words)
        fresh, step, sums, grams = islice(self.words, before, None), max(1, LOOKUP_SUMS // wide), [self._sums], [self._grams]
        # in steps, as the looked-up weights are wide
        while some := [word_grams(w) for w in islice(fresh, step)]:
            sizes = np.fromiter(map(len, some), dtype=np.int64, count=len(some))
            flat = np.fromiter((g for gs in some for g in gs), dtype=np.int64, count=int(sizes.sum()))
            sums.append(np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes, axis=0))
            grams.append(sizes.astype(np.float32))
        if len(sums) > 1:
            self._sums, self._grams = np.concatenate(sums), np.concatenate(grams)
        out = np.zeros((len(counted), self.weights.shape[1]), dtype=np.float64)
        self.sizes = np.ones(len(counted))
        for i, ws in enumerate(counted):
            use = np.fromiter(map(self.words.__getitem__, ws), dtype=np.int64, count=len(ws))
            if len(use):
                self.sizes[i] = self._grams[use].sum(dtype=np.float64)
                out[i] = self._sums[use].sum(axis=0, dtype=np.float64) / self.sizes[i]
        return out + self.weights[-1]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        counted = [words_of(t) if t else [] for t in texts]
        if not self.langs:
            return [(UNDETERMINED, 0.0)] * len(texts)
        scores = self.scores(counted)
        return [self._held(*self._decide(s[:-1]), s[-1], n) if c else (UNDETERMINED, 0.0)
                for c, s, n in zip(counted, scores, self.sizes, strict=True)]

    def _held(self, lang: str, score: float, share: float, n: float) -> tuple[str, float]:
        """The score, brought under LEAST_SCORE if the text's n-grams are too rare for its language."""
        if lang in self.usual:
            mean, variance, inside, allowed = self.usual[lang]
            under = mean - allowed * np.sqrt(variance + OVERLAP * inside / n) - share
            if under > 0:
                score *= LEAST_SCORE * np.exp(-under)
        return lang, float(score)

    def _decide(self, s: np.ndarray) -> tuple[str, float]:
        sure = lambda m: 1.0 / (1.0 + np.exp(-4.0 * m))
        score, family = 1.0, self.families[0]
        if len(self.families) > 1:
            f = s[:len(self.families)]
            best, second = np.argsort(-f, kind="stable")[:2]
            family, score = self.families[best], sure((f[best] - f[second]) / 2)
        members = self.members[family]
        votes = {m: [0, 0.0] for m in members}
        for at in self._pairs_of[family]:
            (a, b), m = self.pairs[at], s[len(self.families) + at]
            votes[a if m >= 0 else b][0] += 1
            votes[a][1] += m
            votes[b][1] -= m
        lang = max(members, key=lambda m: (*votes[m], m))
        if len(members) > 1:
            score *= sure(votes[lang][1] / (len(members) - 1))
        return lang, float(min(1.0, max(0.0, score)))


def _fit_svm(x: np.ndarray, y: np.ndarray, c: float = 4.0, rounds: int = 60) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge) by dual coordinate descent on the Gram matrix."""
    gram = (x @ x.T + 1.0).astype(np.float64)
    cost = np.where(y > 0, 0.5 * len(y) / max(1, (y > 0).sum()), 0.5 * len(y) / max(1, (y < 0).sum())) * c
    alpha, margin = np.zeros(len(y)), np.zeros(len(y))
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(y)):
            slope = y[i] * margin[i] - 1.0 + alpha[i] / (2 * cost[i])
            new = max(0.0, alpha[i] - slope / (gram[i, i] + 1 / (2 * cost[i])))
            if new != alpha[i]:
                margin += (new - alpha[i]) * y[i] * gram[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return np.r_[x.T @ (alpha * y), (alpha * y).sum()]


def sample_rows(docs: DataFrame, sample_per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """Stored: lang, n (place in its language), n-grams (at, value: their shares), number of n-grams, sum of squared shares."""
    labelled = docs.select("doc_id", "lang", "text", F.xxhash64("text").alias("text_hash")).filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold() != HELD_OUT)
        & F.coalesce(F.col("text"), F.lit("")).rlike(r"\p{L}"))
    row = ["lang", "doc_id", "text_hash"]
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash")
    chosen = (labelled.select(*row).withColumn("n", F.row_number().over(by_hash)).filter(F.col("n") <= sample_per_lang)
              .groupBy(*row).agg(F.min("n").alias("n")))
    # stored, so that its measured size decides the join; repeated rows are put together before they move
    texts = labelled.join(store(chosen, "language-chosen"), row).groupBy(*row).agg(F.min("n").alias("n"), F.min("text").alias("text"))

    def features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sparse, sizes = [], []
                for text in part.column("text").to_pylist():
                    # word by word, as a long text has many more n-grams than distinct ones
                    count = np.zeros(DIMENSIONS, dtype=np.int64)
                    for w in words_of(text):
                        np.add.at(count, word_grams(w), 1)
                    at = np.flatnonzero(count)
                    sizes.append(int(count.sum()))
                    sparse.append((at.astype(np.int32), (count[at] / count.sum()).astype(np.float32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("n"),
                     pa.array([a for a, _ in sparse], pa.list_(pa.int32())),
                     pa.array([v for _, v in sparse], pa.list_(pa.float32())), pa.array(sizes, pa.int64()),
                     pa.array([float((v.astype(np.float64) ** 2).sum()) for _, v in sparse], pa.float64())],
                    names=["lang", "n", "at", "value", "grams", "norm"])

    return store(texts.select("lang", "n", "text").mapInArrow(
        lean(features), "lang string, n int, at array<int>, value array<float>, grams long, norm double"), "language-sample")


def _log_shares(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log shares of the n-grams over all rows, and per third of the rows (n mod 3) over the other two."""
    unit = float(2 ** 32)  # shares are summed as integers: any order gives the same sum
    rows = dict(sample.groupBy((F.col("n") % 3).alias("third")).count().collect())
    told = (sample.select((F.col("n") % 3).alias("third"), F.inline(F.arrays_zip("at", "value")))
            .groupBy("third", "at").agg(F.sum(F.round(F.col("value").cast("double") * unit).cast("long")).alias("sum")).collect())
    sums = np.zeros((3, DIMENSIONS))
    for third, at, total in told:  # at most three rows per n-gram slot
        sums[third, at] = total / unit
    log_of = lambda total, n: np.log(total / max(1, n) + 1e-6).astype(np.float32)
    everything, n = sums.sum(axis=0), sum(rows.values())
    return log_of(everything, n), np.stack([log_of(everything - sums[k], n - rows.get(k, 0)) for k in range(3)])


def _usual_shares(sample: DataFrame, others: np.ndarray) -> dict[str, tuple[float, float, float, float]]:
    """What the rows of a language have of the log shares over the rows outside their third; a language's sample is one group."""
    def usual(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        own = [(others[n % 3][at].astype(np.float64), value.astype(np.float64)) for n, at, value in zip(rows["n"], rows["at"], rows["value"], strict=True)]
        share, square = np.array([v @ o for o, v in own]), np.array([v @ o**2 for o, v in own])
        mean, variance, inside = share.mean(), share.var(), (square - share**2).mean()
        off = (mean - share) / np.sqrt(np.maximum(variance + OVERLAP * inside / rows["grams"].to_numpy(), 1e-30))
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "mean": [mean], "variance": [variance], "inside": [inside],
                             "allowed": [max(DEVIATIONS, 1.5 * off.max())], "counted": [len(rows)]})

    told = sample.select("lang", "n", "at", "value", "grams").groupBy("lang").applyInPandas(
        usual, "lang string, mean double, variance double, inside double, allowed double, counted int").filter(F.col("counted") >= LEAST_USUAL).collect()
    return {r["lang"]: (r["mean"], r["variance"], r["inside"], r["allowed"]) for r in told}


def _dense(at: Iterable[np.ndarray], value: Iterable[np.ndarray], rows: int) -> np.ndarray:
    x = np.zeros((rows, DIMENSIONS), dtype=np.float32)
    for i, (a, v) in enumerate(zip(at, value, strict=True)):
        x[i, a] = v
    return x


def _fit_all(sample: DataFrame, families: list[str], members: dict[str, list[str]], pairs: list[tuple[str, str]], scale: float) -> np.ndarray:
    """Weights (DIMENSIONS + bias, classifiers), each classifier fitted by the task of its group of rows."""
    spark, first = sample.sparkSession, len(families)
    weights = np.zeros((DIMENSIONS + 1, first + len(pairs)), dtype=np.float32)
    in_pairs = [(lang, first + k, sign) for k, pair in enumerate(pairs) for lang, sign in zip(pair, (1, -1), strict=True)]
    in_family = [(lang, k, 1) for k, f in enumerate(families) for lang in members[f]] if first > 1 else []
    if not in_pairs and not in_family:
        return weights
    role = "lang string, classifier int, sign int"
    told = ["classifier", "sign", "lang", "n", "at", "value"]
    rows = sample.join(spark.createDataFrame(in_pairs, role), "lang").select(*told)
    shared = None
    if in_family:
        by_place = Window.partitionBy("classifier").orderBy("n", "lang")
        own = (sample.join(spark.createDataFrame(in_family, role), "lang").withColumn("place", F.row_number().over(by_place))
               .filter(F.col("place") <= FAMILY_ROWS))
        rows = rows.unionByName(own.select(*told))
        # SHARED_ROWS rows, one of every label before a second of any
        pool = sample.select("lang", "n", "at", "value").orderBy("n", "lang").limit(SHARED_ROWS).toPandas()
        family = {lang: k for k, f in enumerate(families) for lang in members[f]}
        shared = spark.sparkContext.broadcast(pool.assign(family=[family[v] for v in pool["lang"]]))

    def fit_one(group: pd.DataFrame) -> pd.DataFrame:
        k = int(group["classifier"].iloc[0])
        if k < first:
            other = shared.value
            group = pd.concat([group, other[other["family"] != k].assign(sign=-1)])
        group = group.sort_values(["lang", "n"], kind="stable")
        x = _dense(group["at"], group["value"], len(group))
        x *= np.float32(scale)
        return pd.DataFrame({"classifier": [k], "weights": [_fit_svm(x, group["sign"].to_numpy(np.float64)).astype(np.float32)]})

    for r in rows.groupBy("classifier").applyInPandas(fit_one, "classifier int, weights array<float>").toLocalIterator():
        weights[:, r["classifier"]] = r["weights"]
    weights[:-1] *= np.float32(scale)
    return weights


def fit(docs: DataFrame, families: dict[str, str] | None = None, sample_per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Fit the classifiers on a bounded sample of the labelled rows outside the held-out fold."""
    families = FAMILIES if families is None else families
    sample = sample_rows(docs, sample_per_lang)
    langs = sorted(r["lang"] for r in sample.select("lang").distinct().collect())
    if not langs:
        return Model([], [], {}, [], np.zeros((DIMENSIONS + 1, 0), np.float32))
    members: dict[str, list[str]] = {}
    for name in langs:
        members.setdefault(families.get(name, name), []).append(name)
    names = sorted(members)
    pairs = [p for f in names for p in combinations(members[f], 2)]
    # n-gram shares are small numbers; summed as decimals, which do not depend on the order
    norm, rows = sample.agg(F.sum(F.col("norm").cast("decimal(20,12)")), F.count(F.lit(1))).first()
    log_share, others = _log_shares(sample)
    weights = _fit_all(sample, names, members, pairs, 1.0 / np.sqrt(max(float(norm) / rows, 1e-12)))
    return Model(langs, names, members, pairs, np.c_[weights, np.r_[log_share, np.float32(0.0)]], _usual_shares(sample, others))


def _shared(docs: DataFrame, model: Model):
    """The model for the tasks: DIMENSIONS weights per family and pair of languages, however many rows there are."""
    return docs.sparkSession.sparkContext.broadcast((model.langs, model.families, model.members, model.pairs, model.weights, model.usual))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    shared = _shared(docs, model)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                found = m.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array([p for p, _ in found], pa.string()),
                     pa.array([s for _, s in found], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    base = docs.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    kind = dict(base.dtypes)["doc_id"]
    return base.mapInArrow(lean(predict), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, model: Model, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows with a predicted language whose score is at least ``least_score``; all columns as they were."""
    shared = _shared(docs, model)

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(*shared.value)
        for batch in batches:
            for part in slices(batch, "text", TEXT_BYTES):
                found = m.predict(part.column("text").to_pylist())
                yield part.filter(pa.array([lang != UNDETERMINED and score >= least_score for lang, score in found]))

    return docs.mapInArrow(lean(choose), docs.schema)


def language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, fit(docs))
