"""A small table with everything that a corpus may throw at an operator."""

import random

from pyspark.sql import functions as F

from sifter.llm.common import read_table

SMALL = "/root/testdata/sf0.001"
#: Columns whose names operators use inside.
CLASHING = ("key", "bucket", "node", "label", "grp", "kind", "shard", "slot", "lang_pred", "score", "place", "tag",
            "__who", "__key", "__sha", "__text_hash", "__first", "__place", "__doc", "__own", "__other", "__spans", "__REMOVED")


def rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(["an", "the", "or", "ing", "é", "ß", "x"]) for _ in range(rng.randint(1, 4)))
    base = [word() for _ in range(220)]
    long_text = " ".join(word() for _ in range(6000))
    edit = list(base)
    edit[100] = "changed"
    moved = [word() for _ in range(60)] + base[40:140] + [word() for _ in range(30)]
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, "12 34 !!"), (5, " ".join(base)), (6, " ".join(base)), (7, " ".join(base).upper()),
        (8, " ".join(edit)), (9, " ".join(moved)), (10, long_text), (10, long_text), (None, " ".join(base)), (None, None),
        (11, "Mail a.b@c.de or +1 (555) 123-4567, 4111 1111 1111 1111 and 10.0.0.1 now"), (12, "a" * 3000), (13, "one two"),
        (10, "other text with the id of another row"), (14, "日本語 text 🎉 ́ Σίσυφος <|endoftext|> \x00 end"),
    ]
    return [(i, t, None if i == 5 else "en", "s", len(t or "")) for i, t in texts]


def messy(spark, extra=True):
    df = spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(c) for c in CLASHING}) if extra else df


def empty(spark):
    return messy(spark).limit(0)


def small(spark):
    return read_table(spark, SMALL, "documents")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
