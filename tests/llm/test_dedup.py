"""Exact, near and substring dedup, sharding and decontamination against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from sifter.llm import common, decontaminate, exact_dedup, minhash, sharding, substring_dedup

from .messy import collected, empty, messy, rows, small

LEAST = -(2**63)
UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UP, LOW)


def pairs_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


# -- exact ---------------------------------------------------------------------


@pytest.mark.parametrize("capacity,depth", [(8 << 20, 16), (2000, 6), (1, 2)])
def test_exact_dedup(spark, capacity, depth):
    got = collected(exact_dedup.exact_dedup(messy(spark), capacity, depth))
    groups, seen, want = defaultdict(list), set(), []
    for i, t, *_ in rows():
        groups[(t or "").translate(FOLD)].append(i)
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want.append((i, keep, len(ids), i == keep and (text, i) not in seen, hashlib.sha256(text.encode()).hexdigest()))
            seen.add((text, i))
    assert got == sorted(want, key=repr)


def test_exact_dedup_of_nothing_and_kept_rows(spark):
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0
    docs = messy(spark)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = {((t or "").translate(FOLD), max(i or 0 for i, u, *_ in rows() if (u or "").translate(FOLD) == (t or "").translate(FOLD)))
            for _, t, *_ in rows()}
    assert sorted(((r.text or "").translate(FOLD), r.doc_id) for r in kept.collect()) == sorted(want)


def test_directory_doubles_only_where_buckets_overflow():
    directory, depth, buckets = exact_dedup.split_directory({0: 100, 1: 100, 8: 10, 15: 10}, capacity=120, max_depth=4)
    assert depth == 4 and len(directory) == 16
    assert sorted(d for _, d in buckets) == [1, 2, 3, 4, 4]
    for cell in range(16):
        prefix, d = buckets[directory[cell]]
        assert cell >> (4 - d) == prefix


def test_the_exact_index_is_the_only_table_and_has_few_files(spark, monkeypatch):
    stored = []

    def kept(df, name, *args, **kwargs):
        table = common.store(df, name, *args, **kwargs)
        stored.append((name, len(table.inputFiles())))
        return table

    monkeypatch.setattr(exact_dedup, "store", kept)
    assert exact_dedup.exact_dedup(messy(spark).repartition(8), 1, 6).count() == len(rows())
    assert stored == [("exact-index", 1)]


def test_a_text_counts_once_for_the_directory(spark, monkeypatch):
    sums, split = [], exact_dedup.split_directory
    monkeypatch.setattr(exact_dedup, "split_directory", lambda cells, *a: sums.append(cells) or split(cells, *a))
    docs = spark.range(0, 100, 1, 4).select(F.col("id").alias("doc_id"), F.repeat(F.lit("Ab"), 500).alias("text"))
    assert {r.group_size for r in exact_dedup.exact_dedup(docs).collect()} == {100}
    assert [list(s.values()) for s in sums] == [[1064]]


def test_equal_keys_are_chained_by_their_bytes(spark):
    entry = spark.createDataFrame([(7, "a", 1, 1), (7, "b", 9, 2), (7, "a", 5, 3)], "key long, text string, max_id long, rows long")
    leaves = exact_dedup.build_index(entry).select("chain", "text_sha256", "keep_id", "group_size").collect()
    found = {r.text_sha256: (r.keep_id, r.group_size) for r in leaves}
    assert len({r.chain for r in leaves}) == 2
    assert found == {hashlib.sha256(b"a").hexdigest(): (5, 4), hashlib.sha256(b"b").hexdigest(): (9, 2)}


# -- near ------------------------------------------------------------------------


def test_samples_agree_as_often_as_the_sets_are_alike():
    rng = np.random.default_rng(0)
    for share in (0.4, 0.8, 0.95):
        s = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
        w = rng.uniform(1, 2, 300) * rng.integers(1, 4, 300)
        keep = rng.random(300) < share
        a, b = (s, w), (s[keep], w[keep] * rng.uniform(0.7, 1.3, keep.sum()))
        agree = (minhash.icws(*a, samples=2000) == minhash.icws(*b, samples=2000)).mean()
        assert abs(agree - minhash.weighted_jaccard(a, b)) < 0.05


def near_groups(docs, idf):
    """Classes by comparing all pairs of texts."""
    given = pairs_of(docs)
    texts = sorted({" ".join(minhash.words_of(t or "")) for _, t in given})
    words = minhash.Words()
    use = words.look_up([t.split() for t in texts])
    sets = [minhash.weighted_shingles(words.hashes[u], idf[words.buckets[u]]) for u in use]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and minhash.weighted_jaccard(sets[i], sets[j]) >= 0.8:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    of = dict(zip(texts, label, strict=True))
    groups = defaultdict(list)
    for i, t in given:
        groups[of[" ".join(minhash.words_of(t or ""))]].append(i)
    return sorted(((i, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g), key=repr)


def near_copies(spark, n=60, seed=2):
    """A group of near copies, some too far from the others, copies of copies, and unrelated texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(LOW) for _ in range(5))
    base, out = [word() for _ in range(150)], []
    for i in range(n):
        t = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            t[rng.randrange(150)] = word()
        out.append((i, " ".join(t if i % 3 else [word() for _ in range(rng.randint(1, 80))])))
    return spark.createDataFrame(out, "doc_id long, text string")


def test_near_duplicates(spark):
    for docs in (messy(spark), near_copies(spark), small(spark)):
        got = collected(minhash.near_duplicates(docs).select("doc_id", "class_id", "class_size"))
        assert got == near_groups(docs, minhash.idf_table(docs))


def test_near_duplicates_of_nothing_and_kept_rows(spark):
    assert minhash.near_duplicates(empty(spark)).count() == 0
    docs = messy(spark)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    groups = near_groups(docs, minhash.idf_table(docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted([*{c for _, c, _ in groups}, 10])  # two texts have the id 10


@pytest.mark.parametrize("small,block", [(256, 2048), (4, 2048), (4, 7)])
def test_what_the_leaders_leave_is_compared(spark, monkeypatch, small, block):
    docs = near_copies(spark, 40, 9)
    nodes = minhash.sketches(docs, minhash.idf_table(docs)).groupBy("node").agg(F.first("samples").alias("samples")).cache()
    met = nodes.select(F.lit(1).cast("long").alias("bucket"), "node")  # all in one bucket, no links yet
    none = spark.createDataFrame([], "node binary, label binary")
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK", block)
    every = sorted(((bytes(r.node), np.array(r.samples)) for r in nodes.collect()), key=lambda x: x[0])
    led = {bytes(x) for x in minhash.leaders(met).first().leaders}
    rest = every if small > len(every) else [x for x in every if x[0] not in led]
    least = int(np.ceil(minhash.LEAST_AGREEMENT * minhash.BANDS * minhash.ROWS))
    alike = {a: [(-(x == y).sum(), b) for b, y in rest if b != a and (x == y).sum() >= least] for a, x in rest}
    allowed = {(min(a, b), max(a, b)) for a in alike for _, b in alike[a]}
    nearest = {(min(a, b), max(a, b)) for a in alike for _, b in sorted(alike[a])[:minhash.NEAREST]}
    got = {(bytes(r.a), bytes(r.b)) for r in minhash.residual_pairs(met, none, nodes).collect()}
    if small > len(every):
        assert got == allowed and got
    elif block > len(every):
        assert got == nearest and got
    else:  # split by a second band and compared in blocks
        assert got and got <= allowed


def drifting_copies(spark, n, edits, seed):
    """Copies of copies: each text differs from an earlier one in ``edits`` words, from most others in many."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(LOW) for _ in range(5))
    texts = [[word() for _ in range(150)]]
    while len(texts) < n:
        t = list(rng.choice(texts))
        for k in rng.sample(range(150), rng.choice(edits)):
            t[k] = word()
        texts.append(t)
    return spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")


def copies_around_the_threshold(spark, n, seed):
    """Edits of one text that is not there: most pairs are somewhat under the threshold, a few reach it."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(LOW) for _ in range(5))
    base, out = [word() for _ in range(150)], []
    for i in range(n):
        t = list(base)
        for k in rng.sample(range(150), rng.choice((3, 4))):
            t[k] = word()
        out.append((i, " ".join(t)))
    return spark.createDataFrame(out, "doc_id long, text string")


@pytest.mark.parametrize("small,nearest,tile,tile_bytes", [(64, 2, 1024, 8 << 20), (4, 0, 50, 8 << 20), (4, 2, 7, 20_000)])
def test_classes_of_large_buckets_equal_brute_force(spark, monkeypatch, small, nearest, tile, tile_bytes):
    for name, value in (("SMALL", small), ("NEAREST", nearest), ("TILE", tile), ("TILE_BYTES", tile_bytes)):
        monkeypatch.setattr(minhash, name, value)
    for docs in (copies_around_the_threshold(spark, 500, 1), drifting_copies(spark, 300, (2, 3, 4), 8)):
        got = collected(minhash.near_duplicates(docs).select("doc_id", "class_id", "class_size"))
        assert got == near_groups(docs, minhash.idf_table(docs))


# -- substrings --------------------------------------------------------------------


def without_repeats(given):
    """(doc_id, n_words, n_removed, kept digest) by looking at every window."""
    place = lambda i: LEAST if i is None else i
    first, out = {}, []
    cut = [(place(i), i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in given]
    for d, _, w in cut:
        for k in range(len(w) - 49):
            x = tuple(w[k:k + 50])
            first[x] = min(first.get(x, d), d)
    for d, i, w in cut:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k:k + 50])] < d:
                gone[k:k + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def passages_table(spark):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefgh")  # noqa: E731 - few words, many chance repeats
    shared = [[word() + word() for _ in range(rng.randint(49, 130))] for _ in range(6)]
    out = []
    for i in range(60):
        t = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(shared)
            lo = rng.randint(0, 20)
            t += [word() * 3 for _ in range(rng.randint(0, 30))] + p[lo:rng.randint(45, len(p))]
        out.append((rng.randint(0, 40), " ".join(t)))
    return spark.createDataFrame([*out, (50, "x " * 300), (51, "x " * 400)], "doc_id long, text string")


@pytest.mark.parametrize("group_bytes", [4 << 20, 3000])
def test_substring_dedup(spark, group_bytes):
    for docs in (messy(spark), passages_table(spark)):
        assert collected(substring_dedup.substring_dedup(docs, group_bytes)) == without_repeats(pairs_of(docs))


def test_substring_dedup_of_a_corpus(spark):
    docs = small(spark)
    assert collected(substring_dedup.substring_dedup(docs, 100_000)) == without_repeats(pairs_of(docs))
    assert substring_dedup.substring_dedup(empty(spark)).count() == 0


# -- sharding ------------------------------------------------------------------------


def test_sharding_places_every_row(spark):
    for docs in (messy(spark), small(spark)):
        placed = sharding.shard_documents(docs).collect()
        sized = lambda i, t: (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
        assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in placed) == sorted(sized(*p) for p in pairs_of(docs))
        slots, load, virtual = defaultdict(list), defaultdict(int), defaultdict(int)
        for r in placed:
            slots[r.shard].append(r.slot)
            load[r.shard] += r["size"]
            virtual[r.virtual_slot] += r["size"]  # is never split
            assert r.law == "bytes" and r.grown_shard is None
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(load.values()) - min(load.get(s, 0) for s in range(8)) <= max(virtual.values())
    assert sharding.shard_documents(empty(spark)).count() == 0


def test_a_rebalancing_keeps_most_slots(spark, tmp_path):
    root = f"file://{tmp_path}/map"
    used = spark.range(64).select(F.col("id").cast("int").alias("virtual_slot"), (F.col("id") * 10 + 1).alias("bytes"))
    sharding.publish_map(sharding.initial_map(spark, 4, 64), root)
    sharding.publish_map(sharding.rebalance(sharding.read_map(spark, root), used, 4), root)
    sharding.publish_map(sharding.rebalance(sharding.read_map(spark, root), used, 5), root)
    maps = [{r.virtual_slot: r.shard for r in sharding.read_map(spark, root, v).collect()} for v in (0, 1, 2)]
    assert [len(m) for m in maps] == [64, 64, 64] and sharding.read_map(spark, root).first().version == 2
    for v, shards in ((1, 4), (2, 5)):
        load = [sum(s * 10 + 1 for s, h in maps[v].items() if h == x) for x in range(shards)]
        assert max(load) - min(load) <= 0.05 * sum(load)
    for v, share in ((1, 0.1), (2, 0.25)):  # only the bytes beyond the target move
        assert sum(s * 10 + 1 for s in range(64) if maps[v][s] != maps[v - 1][s]) <= share * sum(s * 10 + 1 for s in range(64))


# -- decontamination -------------------------------------------------------------------


ITEMS = [
    (1, "Alice Smith buys 12 apples for 3 dollars and gives Alice Smith's brother 12 of them on the way home from the old market today"),
    (2, "What is the name of the long river that runs through the capital city and into the sea near the great harbour"),
    (2, "What is the name of the long river that runs through the capital city and into the sea near the great harbour"),
    (3, None), (4, "too short"), (None, "an item without any id that is still long enough to be found in a document by its words"),
]


def leaks(spark, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.decontaminate(table, bench).collect()}


def test_leaks_and_their_reparameterised_forms(spark):
    apples, river = ITEMS[0][1], ITEMS[1][1]
    changed = "We said that Alice Smith buys 99 apples for 7 dollars and gives Alice Smith's brother 99 of them on the way home from the old market today, so"
    wrong = changed.replace("brother 99", "brother 45")
    docs = [
        (1, f"before it {apples} and after it"), (2, f"some words {river.upper()} more words"), (3, changed), (4, wrong),
        (5, "What is the name of the long river, they asked, and nobody in the capital city had any idea at all about it"),
        (6, river.replace("capital", "old")), (7, None), (8, ""), (9, ITEMS[5][1].replace(" ", "\n ")), (10, ".".join(river.split())),
        (None, river), (1, f"before it {apples} and after it"),
    ]
    found = leaks(spark, docs)
    assert set(found) == {(1, 1), (2, 2), (3, 1), (9, None), (10, 2), (None, 2)}
    assert found[3, 1].reparameterised and found[3, 1].consistent and not found[1, 1].reparameterised
    assert found[2, 2].copies == 2


def test_leaks_in_the_corpus_equal_brute_force(spark):
    docs, bench = small(spark), spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    items = {r.item_id: words(r.text) for r in bench.collect()}
    want = set()
    for i, t in pairs_of(docs):
        have = grams(words(t))
        want |= {(i, b) for b, w in items.items() if sum(tuple(w[k:k + 5]) in have for k in range(len(w) - 4)) >= 0.8 * (len(w) - 4)}
    got = {(r.doc_id, r.item_id) for r in decontaminate.decontaminate(docs, bench).collect()}
    assert got == want and want
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in pairs_of(docs)} - {i for i, _ in want}


def test_items_with_inserted_or_missing_words_are_found(spark):
    """At every place of the item and of the stride; the item keeps at least 0.8 of its windows."""
    item = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(44)]
    docs, key = [], 0
    for n, cut in ((29, 0), (29, 1), (44, 0), (44, 1)):
        for k in range(4, n - 4):
            changed = item[:k] + (["inserted"] if not cut else []) + item[k + cut:n]
            for at in range(8):
                docs.append((key, " ".join(["before"] * at + changed + ["after"] * 3), 0 if n == 29 else 1))
                key += 1
    docs += [(key, " ".join([*item[:12], "x", *item[12:30], "y", *item[30:]]), 1), (key + 1, " ".join([*item[:15], "x", "y", *item[15:29]]), 0)]
    bench = spark.createDataFrame([(0, " ".join(item[:29])), (1, " ".join(item))], "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string, of long")
    found = {(r.doc_id, r.item_id) for r in decontaminate.decontaminate(table.drop("of"), bench).collect()}
    assert {(d, of) for d, _, of in docs} <= found


def test_two_fillings_of_a_template_in_one_document(spark):
    apples = ITEMS[0][1]
    fill = lambda a, b: apples.replace("12", a).replace(" 3 ", f" {b} ")
    assert set(leaks(spark, [(1, f"{fill('99', '7')} and then {fill('55', '8')}"), (2, fill("99", "7").replace("99 of", "45 of"))])) == {(1, 1)}


def test_every_wording_of_a_template_is_judged(spark):
    text = "she packs {} apples and {} pears into the basket and then walks all the long way to the market"
    other = "quite another question under the same number that speaks about a river and a bridge near the harbour"
    wordings = [(1, text.format(3, 3)), (2, text.format(3, 4)), (7, other), (7, ITEMS[1][1]), (None, other.replace("river", "lake")), (None, ITEMS[5][1])]
    bench = spark.createDataFrame(wordings, "item_id long, text string")
    docs = [(1, text.format(3, 4)), (2, text.format(3, 3)), (3, text.format(8, 9)), (4, f"{other} and {ITEMS[1][1]}"), (5, ITEMS[1][1]),
            (6, f"{ITEMS[5][1]}, {other.replace('river', 'lake')}")]
    found = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert sorted((r.doc_id, r.item_id or 0) for r in found) == [(1, 1), (2, 1), (3, 1), (4, 7), (4, 7), (5, 7), (6, 0), (6, 0)]
    assert {r.doc_id: r.reparameterised for r in found if r.doc_id < 4} == {1: False, 2: False, 3: True}
    assert {r.copies for r in found if r.doc_id < 4} == {2}


def test_decontamination_with_empty_tables(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.decontaminate(empty(spark), bench).count() == 0
    assert decontaminate.decontaminate(messy(spark), bench.limit(0)).count() == 0
    assert decontaminate.drop_leaks(messy(spark), bench).count() == len(rows())


@pytest.mark.parametrize("n", range(5, 60))
def test_the_stride_meets_every_leak(n):
    """Whatever words of an item are changed, 0.8 of its windows intact leave one at the stride, wherever it stands."""
    rng, windows = random.Random(n), n - 4
    step = decontaminate.stride_for(n)
    for _ in range(300):
        broken = {w for e in rng.sample(range(n), rng.randint(0, 3)) for w in range(max(0, e - 4), min(windows, e + 1))}
        if windows - len(broken) >= 0.8 * windows:
            assert all(any((w + at) % step == 0 for w in range(windows) if w not in broken) for at in range(step))


def test_one_row_of_every_class_is_kept(spark):
    found = minhash.near_duplicates(messy(spark)).groupBy("class_id", "class_size").agg(F.sum(F.col("kept").cast("int")).alias("n"), F.count("*").alias("rows"))
    rows = found.collect()
    assert sum(r.n for r in rows) == minhash.keep_one(messy(spark)).count()
    assert all(r.n * r.class_size == r.rows for r in rows)


def test_renamed_questions_are_found(spark):
    """Names may begin a sentence and may have another number of words; clean texts of the same shape stay clean."""
    item = "Tom buys 3 apples at the old market near the river. Tom eats one of them and gives the rest to Anna. How many apples does Tom have when he walks home in the evening"
    rename = lambda who, n=3, to="Anna": item.replace("Tom", who).replace(" 3 ", f" {n} ").replace("Anna", to)
    docs = [(1, rename("Sara")), (2, rename("Mary Ann")), (3, f"A story. {rename('Sara', 7, 'Bill')} And so on."), (4, rename("Mary Ann", 8)),
            (5, rename("Mary Ann", 8, "Peter Paul")), (6, rename("tom")), (7, item),
            (8, "Tom sells 3 horses at the new station near the hill. Sara takes one of those and leaves the other to Anna. Why did Tom stay there until he went back to the town"),
            (9, rename("Sara").replace("does Sara", "does Bill").replace("to Anna", "to Sara"))]
    bench = spark.createDataFrame([(1, item), (2, rename("Lady Jane", 5))], "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench.filter("item_id = 1")).collect()}
    assert {1, 2, 3, 4, 5, 6, 7} <= set(found) and 8 not in found
    assert found[1].reparameterised and found[2].reparameterised and not found[7].reparameterised
    found = {(r.doc_id, r.item_id) for r in decontaminate.decontaminate(spark.createDataFrame(docs[:1], "doc_id long, text string"), bench).collect()}
    assert found == {(1, 1), (1, 2)}


@pytest.mark.parametrize("kind", ["many", "one"])
def test_texts_of_numbers(spark, kind):
    """20,000 numbers, and 20,000 times one number, against an item that lists numbers; the leaks among them are found."""
    rng = random.Random(3)
    number = (lambda: str(rng.randint(0, 10**6))) if kind == "many" else (lambda: "7")
    listed = lambda n: " ".join(number() for _ in range(n))
    ask = "sort these values from the smallest to the largest one please"
    values = listed(40)
    bench = spark.createDataFrame([(1, f"{ask} {values} and write down the fifth of them")], "item_id long, text string")
    docs = [(1, listed(20_000)), (2, f"{listed(10_000)} {ask} {listed(40)} and write down the fifth of them {listed(10_000)}"),
            (3, f"{ask} {values} and write down the fifth of them"), (4, f"the table holds {listed(20_000)} in all")]
    start = time.monotonic()
    found = {r.doc_id for r in decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert time.monotonic() - start < 60
    assert found >= {2, 3} and (kind == "one" or found == {2, 3})


def test_the_comparison_is_planned_once(spark):
    bench = spark.createDataFrame([(1, "Tom sold 12 red apples to Sara for 3 dollars in the old market")], "item_id long, text string")
    docs = spark.createDataFrame([(7, "x y Tom sold 12 red apples to Sara for 3 dollars in the old market z")], "doc_id long, text string")
    found = decontaminate.decontaminate(docs, bench)
    # the comparison itself is stored: no filter or later column repeats it in the plan that the driver holds
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(7, 1)]


def test_words_of_a_batch_are_hashed_together():
    rng = random.Random(4)
    parts = ["a", "bc", " ", "  ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "　", "é", "日", "\0"]
    texts = [*("".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(500)), None, "", " ", "a"]
    cut = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert [substring_dedup.words_of(t) for t in texts] == cut
    hasher = substring_dedup.Hasher()
    for lo, hi in ((0, len(texts)), (7, 8), (500, 504), (3, 3)):
        got = hasher.texts(pa.array(texts, pa.string()).slice(lo, hi - lo))
        assert [h.tolist() for h in got] == [h.tolist() for h in hasher.words(cut[lo:hi])]
    words = minhash.Words()
    for some in (cut, cut[9:10], [[]], []):
        use = words.look_up(some)
        got = [(words.hashes[u].tolist(), words.buckets[u].tolist()) for u in use]
        assert got == [([xxhash.xxh3_64_intdigest(w) for w in t], [zlib.crc32(w.encode()) % minhash.DF_BUCKETS for w in t]) for t in some]


def test_shuffles_go_when_their_table_is_stored(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: {f for f in files.getAllFiles().mkString(" ").split() if "shuffle_" in f and f.endswith(".data")}
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", held()
    was = spark.conf.get(key)
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    assert {r.k: r["count"] for r in common.store(df, "test-shuffles").collect()} == {k: len(range(k, 1000, 7)) for k in range(7)}
    end = time.time() + 20
    while held() - before and time.time() < end:  # Spark removes them behind the query
        time.sleep(0.2)
    assert not held() - before and spark.conf.get(key) == was


def plain_sample(shingles, weights, samples):
    """Of every sample the element with the least value, all elements drawn in full."""
    mix = minhash._mix
    seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    h = shingles[:, None] * seeds
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    u = (h[:, :, None] >> np.arange(0, 64, 16, dtype=np.uint64) & np.uint64(0xFFFF)).astype(np.float32) / np.float32(65536) + np.float32(2.0**-17)
    r, c = -np.log(u[:, :, 0] * u[:, :, 1]), -np.log(u[:, :, 2] * u[:, :, 3])
    beta = (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
    t = np.floor(np.log(weights).astype(np.float32)[:, None] / r + beta)
    at = np.argmin(np.log(c) - r * (t - beta + np.float32(1)), axis=0)
    value = mix(shingles[at] + t[at, np.arange(samples)].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (value >> np.uint64(32)).astype(np.uint32).view(np.int32)


def test_few_elements_are_drawn_in_full(monkeypatch):
    rng, drawn = np.random.default_rng(5), []
    sets = []
    for n in (1, 2, 30, 400, 700, 3000):
        s = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        sets += [(s, rng.choice([1.0, 1.3, 2.0, 40.0], len(s))), (s[:0], np.zeros(0))]
    settle = minhash._settle
    monkeypatch.setattr(minhash, "_settle", lambda held, *rest: (drawn.extend(len(x[0]) for x in held), settle(held, *rest)))
    got = minhash.icws_of(sets, 300)
    for g, (s, w) in zip(got, sets, strict=True):
        assert g.tolist() == (plain_sample(s, w, 300).tolist() if len(s) else [0] * 300)
    assert sum(drawn) < 0.1 * 300 * sum(len(s) for s, _ in sets)


def test_shingles_of_texts_in_a_row():
    rng = np.random.default_rng(6)
    for lengths in ([0, 7, 3, 0, 5, 12, 1, 90], [2, 1], [0], []):
        n = np.array(lengths, dtype=np.int64)
        hashes, idf = rng.integers(0, 9, n.sum()).astype(np.uint64), 1 + rng.random(n.sum())
        ends = np.cumsum(n)
        got = list(minhash.weighted_sets(hashes, idf, n))
        want = [minhash.weighted_shingles(hashes[e - k:e], idf[e - k:e]) for e, k in zip(ends, n, strict=True)]
        assert [(s.tolist(), w.tolist()) for s, w in got] == [(s.tolist(), w.tolist()) for s, w in want]
