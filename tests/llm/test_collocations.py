"""Collocations: the filters by themselves, and the whole job against a plain count."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from sifter.llm import collocations

from .messy import collected, empty, messy, rows

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, least=10, top=2000):
    """lang, rank, phrase, a, l, r, n, score from (lang, text), in Python's integers."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in texts:
        lang = lang if lang is not None else "und"
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = []
        for g, a in counts.items():
            if len(g) < 2 or a < least:
                continue
            if len(g) == 2 and any(len(h) == 3 and g in (h[:2], h[1:]) and b >= least and 100 * b >= 50 * a for h, b in counts.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def made(n=400, seed=3):
    rng = random.Random(seed)
    words = ["New", "york", "the", "of", "a b", "É", "\U0001F389", "zz", "x-y", "it's", "\x00", "Z", "ß"]
    out = []
    for i in range(n):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\x0b", "; "]) for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", " new york city", " New York City. once", "the the the the"])
        out.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return out


def run(spark, data, **options):
    table = spark.createDataFrame([(i, t, lang, "mine", 1) for i, t, lang in data], "doc_id long, text string, lang string, x string, salt int")
    return collected(collocations.collocations(table.repartition(3), **options))


def test_equals_plain_count(spark):
    data = made()
    got = run(spark, data)
    assert got == brute([(lang, t) for _, t, lang in data]) and len(got) > 100


def test_small_chunks_many_shards_and_the_top(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 900)
    monkeypatch.setattr(collocations, "SHARD_ENTRIES", 100)
    data = made(seed=9)
    assert run(spark, data, least=3, top=40) == brute([(lang, t) for _, t, lang in data], 3, 40)


def test_messy_rows(spark):
    assert collected(collocations.collocations(messy(spark), least=3)) == brute([(r[2], r[1]) for r in rows()], 3)
    nothing = collocations.collocations(empty(spark))
    assert nothing.count() == 0
    assert nothing.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_scores_beyond_64_bits(spark):
    l, r, a = 4 * 10**12 + 1, 4 * 10**12 + 3, 4 * 10**12 - 7  # noqa: E741
    table = spark.createDataFrame([(a, l, r), (10, 10, 10), (10, 3_333_333, 1), (3, 7, 11)], "a long, l long, r long")
    got = [x[0] for x in table.select(collocations._score(table.a, table.l, table.r)).collect()]
    assert got == [10**6 * x * x // (y * z) for x, y, z in [(a, l, r), (10, 10, 10), (10, 3_333_333, 1), (3, 7, 11)]]


@pytest.mark.parametrize("bits", [1, 2, 9, 20, 21, 22, 31])
def test_permutation_is_undone_and_spreads(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, (3, 5000))
    packing = collocations.Packing(bits)
    upper, lower = packing.pack(*ids)
    assert (np.stack(packing.unpack(upper, lower)) == ids).all()
    assert int(upper.max()) < 1 << packing.high and int(lower.max()) < 1 << packing.low
    if bits >= 20:  # neighbouring phrases go to different eighths
        x = np.arange(4000)
        upper, _ = packing.pack(x * 0 + 1, x * 0 + 2, x)
        share = np.bincount((upper >> np.uint64(packing.high - 3)).astype(int), minlength=8)
        assert share.min() > 350


@pytest.mark.parametrize("bits", [5, 21, 28])
@pytest.mark.parametrize("shard_bits", [0, 2])
def test_filters_lose_nothing(bits, shard_bits):
    rng = np.random.default_rng(bits)
    packing = collocations.Packing(bits)
    upper, lower, counts = collocations.count_sorted(packing, *packing.pack(*rng.integers(0, min(1 << bits, 900), (3, 4000))))
    counts = counts * rng.choice([1, 1, 300, 70_000], len(counts))
    shard = (upper >> np.uint64(packing.high - shard_bits)).astype(int)
    for s in range(1 << shard_bits):
        mine = shard == s
        data = collocations.write_filter(packing, shard_bits, upper[mine], lower[mine], counts[mine])
        back, u, v, c = collocations.read_filter(data, s)
        assert back.bits == bits and (u == upper[mine]).all() and (v == lower[mine]).all() and (c == counts[mine]).all()


@pytest.mark.parametrize("bits", [18, 21, 25])
def test_the_phrases_of_a_chunk_are_counted_in_little_memory(bits):
    rng, packing = np.random.default_rng(bits), collocations.Packing(bits)
    stream, ids = rng.integers(0, 3000, 300_000).astype("<u4"), np.r_[0, rng.permutation(1 << 16)[:2999] + 1]
    ids[rng.integers(1, 3000, 300)] = 0
    s = ids[stream].tolist()
    brute = Counter((*s[i:i + 2], 0) for i in range(len(s) - 1) if all(s[i:i + 2]))
    brute.update(tuple(s[i:i + 3]) for i in range(len(s) - 2) if all(s[i:i + 3]))
    tracemalloc.start()
    upper, lower, counts = collocations.count_phrases(stream, ids, packing)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert dict(zip(zip(*(v.tolist() for v in packing.unpack(upper, lower)), strict=True), counts.tolist(), strict=True)) == brute
    order = upper << np.uint64(packing.low) | lower if 3 * bits <= 64 else upper
    assert (order[1:] >= order[:-1]).all()
    assert 3 * bits > 64 or peak < 40 * counts.sum()
    assert all(len(x) == 0 for x in collocations.count_phrases(stream[:1], ids, packing))


def test_no_table_that_grows_with_the_corpus_is_broadcast(spark, monkeypatch):
    """The compressed size of stored tables says little about what the driver would hold, least of all after an explode."""
    plans, store = [], collocations.store
    planned = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())

    def spy(df, *args, **options):
        planned(df)
        return store(df, *args, **options)

    monkeypatch.setattr(collocations, "store", spy)
    table = spark.createDataFrame([(i, t, lang) for i, t, lang in made(100)], "doc_id long, text string, lang string")
    planned(collocations.collocations(table))
    keys = {re.sub(r"#\d+L?", "", k) for p in plans for k in re.findall(r"BroadcastHashJoin \[([^\]]*)\]", p)}
    assert keys <= {"lang", "__p"}  # a row per language, a row per partition
    assert sum("SortMergeJoin" in p for p in plans) > 2
