"""Personal data and language identification."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex

from sifter.llm import language_id, pii

from .messy import collected, empty, messy, rows, small

LETTERS = "abcdefghijklmnopqrstuvwxyz"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def spans(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


def test_spans_equal_the_plain_patterns(spark):
    rng = random.Random(2)
    pieces = ["a", "1", "2", "9", "255", "256", "0001", ".", "@", "-", " ", "+", "(", ")", "x.y", "a@b.c", "_", "4111111111111111",
              "10.0.0.1", "+1 555 123 4567", "é", "\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(20_000)]
    for text in [*texts, *(r.text or "" for r in small(spark).collect()), "1" * 20_000, "a" * 20_000, "+1" * 5000, "a@" * 5000]:
        assert [s[:3] for s in pii.base_spans(text)] == spans(text), text[:100]


def around(text, found):
    """(entity, term, start, end) of the five words before and after each span that are in no span."""
    free = [m for m in regex.finditer(r"\p{L}[\p{L}\p{M}]*", text) if not any(s < m.end() and e > m.start() for _, s, e, _ in found)]
    out = set()
    for kind, s, e, value in found:
        before, after = [m for m in free if m.start() < s][-5:], [m for m in free if m.start() >= e][:5]
        out |= {(f"{kind}:{value}", m[0].lower(), m.start(), m.end()) for m in before + after}
    return sorted(out)


def disclosing(given):
    """Spans of disclosing terms by row, counted in plain Python."""
    found = [pii.base_spans(t or "") for _, t in given]
    near = [around(t or "", s) for (_, t), s in zip(given, found, strict=True)]
    n_term = Counter(w for _, t in given for w in pii._WORD.findall((t or "").lower()))
    n_near = Counter(e for c in near for e, _, _, _ in c)
    both = Counter((e, w) for c in near for e, w, _, _ in c)
    total, risky = sum(n_term.values()), {}
    for (e, w), n in both.items():
        share = n / n_term[w]
        if n >= 3 and share >= 0.5 and n * math.log2(share * total / n_near[e]) >= 8:
            risky[e, w] = share
    return [sorted({(a, b) for e, w, a, b in c if (e, w) in risky}) for c in near]


def people(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in ("da", "lo", "mi", "re", "so") for b in ("n", "k", "l", "t", "s")]
    out = []
    for i in range(240):
        who = i % 24
        about = rng.sample(words, 8)
        if i % 2:
            about[4:4] = [f"captain{chr(97 + who)}", f"p{who}@mail.org", "of", f"ship{chr(97 + who)}"]
        out.append((i, " ".join(about)))
    return spark.createDataFrame(out, "doc_id long, text string")


def test_terms_of_frequent_and_of_few_entities_are_found(spark):
    """An address with a third of all occurrences, and a table of three addresses: terms that stand only beside theirs."""
    rng = random.Random(8)
    words = [a + b for a in ("da", "lo", "mi", "re") for b in ("n", "k", "l", "t")]
    for owners in ([0] * 40 + list(range(1, 21)) * 4, [0, 1, 2] * 30):
        rows = [(i, " ".join([*rng.sample(words, 6), f"captain{chr(97 + o)}", f"p{o}@mail.org", *rng.sample(words, 6)])) for i, o in enumerate(owners)]
        found = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        terms = {r.doc_id: r.n_term for r in found}
        assert all(terms[i] == 1 for i, o in enumerate(owners) if owners.count(o) >= 3)


@pytest.mark.parametrize("table", [messy, people, small])
def test_personal_data(spark, table):
    docs = table(spark)
    given = [(r.doc_id, r.text) for r in docs.collect()]
    want = []
    for (i, t), terms in zip(given, disclosing(given), strict=True):
        base = spans(t or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        count = Counter(k for k, *_ in base)
        everything = ",".join([*([joined] if joined else []), *(f"term:{s}:{e}" for s, e in terms)])
        want.append((i, *(count[k] for k in PATTERNS), hashlib.sha256(joined.encode()).hexdigest(), everything))
    got = pii.personal_data(docs).select("doc_id", *(f"n_{k}" for k in PATTERNS), "base_sha256", "spans")
    assert collected(got) == sorted(want, key=repr)
    if table is people:
        assert any("term:" in r[-1] for r in want)


def test_sanitised_texts(spark):
    docs = people(spark)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    for r in docs.collect():
        if "@" not in r.text:
            assert clean[r.doc_id] == r.text
        else:
            assert "@" not in clean[r.doc_id] and "[EMAIL]" in clean[r.doc_id] and "captain" not in clean[r.doc_id]
    assert pii.sanitise(messy(spark)).columns == messy(spark).columns
    assert pii.personal_data(empty(spark)).count() == 0


# -- language -----------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = language_id.language_id(docs).collect()
    assert sorted(r.doc_id for r in found) == sorted(lang)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_families_come_first(spark):
    model = language_id.fit(small(spark))
    assert model.families == ["germanic", "romance"] and model.pairs == [("de", "en"), ("es", "fr")]


def test_languages_of_messy_rows(spark):
    docs = messy(spark)
    found = defaultdict(list)
    for r in language_id.language_id(docs).collect():
        found[r.doc_id].append(r)
    assert all(r.lang_pred == "und" and r.score == 0 for i in (1, 2, 3, 4) for r in found[i])
    assert found[5][0].lang_pred == "en" and found[13][0].score == 1  # one learned language
    assert len(found[10]) == 3 and all(not r.held_out for r in found[None])
    kept = language_id.drop_unidentified(docs, language_id.fit(docs))
    assert kept.columns == docs.columns and kept.count() == len(rows()) - 5
    assert language_id.language_id(empty(spark)).count() == 0
    nothing = docs.withColumn("lang", docs["lang"].substr(9, 0)).filter("false").unionByName(docs.withColumn("lang", docs["n_chars"].cast("string")).filter("doc_id is null"))
    assert {r.lang_pred for r in language_id.language_id(nothing).collect()} == {"und"}


def test_unlearned_languages_are_rejected_and_held_out_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model, rng = language_id.fit(docs), random.Random(1)
    some = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))
    unknown = [(i, some(letters, n)) for i, (letters, n) in enumerate(
        (a, n) for a in ("абвгдежзиклмнопрстуфхцчшыья", "αβγδεζηθικλμνξοπρστυφχψω", "אבגדהוזחטיכלמנסעפצקרשת", LETTERS) for n in (40, 100, 1000))]
    table = spark.createDataFrame(unknown, "doc_id long, text string")
    assert language_id.drop_unidentified(table, model).count() == 0
    assert all(r.score < language_id.LEAST_SCORE for r in language_id.identify(table, model).collect())
    held = docs.filter(language_id.fold() == language_id.HELD_OUT).filter("text rlike '[a-z]'")
    assert language_id.drop_unidentified(held, model).count() == held.count()


def test_every_label_is_learned(spark):
    """More labels than fit one machine of all rows; a hot doc_id gives one sampled row, texts of a rare label are found."""
    rng = random.Random(2)
    vocabulary = {f"l{k:02}": ["".join(rng.choice(LETTERS) for _ in range(6)) for _ in range(30)] for k in range(90)}
    table, i = [], 0
    for k, (lang, known) in enumerate(vocabulary.items()):
        for _ in range(6 if k else 400):
            i += 1
            table.append((i, lang, " ".join(rng.choice(known) for _ in range(40))))
    table += [(i + 1, "l01", table[400][2])] * 2000
    docs = spark.createDataFrame(table, "doc_id long, lang string, text string")
    sample = language_id.sample_rows(docs).select("lang", "n").collect()
    assert max(Counter(r.lang for r in sample).values()) <= language_id.SAMPLE_PER_LANG and sum(r.lang == "l01" for r in sample) <= 7
    model = language_id.fit(docs, families={f"l{k:02}": "many" for k in range(4)})
    assert len(model.langs) == 90 and len(model.families) == 87 and len(model.pairs) == 6
    want = {r[0]: r[1] for r in table}
    found = language_id.identify(docs, model).collect()
    assert len(found) == len(table)
    assert sum(r.lang_pred == want[r.doc_id] for r in found) >= 0.99 * len(found)
    again = language_id.fit(docs.repartition(7), families={f"l{k:02}": "many" for k in range(4)})
    assert np.allclose(model.weights, again.weights, atol=1e-4) and model.usual == again.usual


def test_svm_reaches_the_least_cost():
    """Dual coordinate descent against plain gradient descent on the cost itself."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 4)).astype(np.float32)
    y = np.where(x[:, 0] + 0.3 * rng.normal(size=40) > 0.4, 1.0, -1.0)
    weight = np.where(y > 0, 20 / (y > 0).sum(), 20 / (y < 0).sum()) * 4.0
    one = np.c_[x, np.ones(40)]

    def cost(w):
        return 0.5 * w @ w + (weight * np.maximum(0, 1 - y * (one @ w)) ** 2).sum()

    plain = np.zeros(5)
    for _ in range(50_000):
        plain -= 1e-4 * (plain - 2 * one.T @ (weight * y * np.maximum(0, 1 - y * (one @ plain))))
    assert cost(language_id._fit_svm(x, y, rounds=5000)) <= cost(plain) * 1.001
    assert cost(language_id._fit_svm(x, y)) <= cost(plain) * 1.02  # as it is used, stopped after 60 rounds
