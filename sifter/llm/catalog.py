"""Registered queries of the training-data operators and their DuckDB SQL.

Every query applies its operator, with production parameters, to the whole
tables below ``sf_dir`` and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sifter.llm import (
    bpe_codec,
    centroids,
    collocations,
    decontaminate,
    exact_dedup,
    language_id,
    minhash,
    pii,
    piece_codec,
    sharding,
    substring_dedup,
    token_count,
    token_ids,
)
from sifter.llm.common import read_table


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(read_table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("piece_bpe_32k.model"))


def op6_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_decode(read_table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(read_table(spark, sf_dir, "documents"))


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_ids(read_table(spark, sf_dir, "documents"),
                               public_tokenizers.path("word_bpe_49k.json"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read_table(spark, sf_dir, "documents")).drop("text_hash", "removed")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.encode_decode(read_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(read_table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op2_token_counts": op2_token_counts,
    "op6_bpe_roundtrip": op6_bpe_roundtrip,
    "op3_sharding": op3_sharding,
    "op4_exact_dedup": op4_exact_dedup,
    "op10_language_id": op10_language_id,
    "op5_token_ids": op5_token_ids,
    "op9_pii": op9_pii,
    "op8_decontaminate": op8_decontaminate,
    "op7_substring_dedup": op7_substring_dedup,
    "op1_minhash_dedup": op1_minhash_dedup,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_centroids": op12_centroids,
    "op13_collocations": op13_collocations,
}


def _centroid_rounds() -> str:
    """The rounds of the centroid query as a chain of common table expressions."""
    steps = []
    for r in range(centroids.ROUNDS + 1):
        steps.append(f"""
        a{r} AS MATERIALIZED (
            SELECT id, min(struct_pack(d := d, c := c)) AS best FROM (
                SELECT id, c, list_sum(list_transform(list_zip(q, center), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT))) AS d
                FROM points, c{r}) GROUP BY id)""")
        if r < centroids.ROUNDS:
            steps.append(f"""
        s{r} AS (
            SELECT c, list(m ORDER BY j) AS center FROM (
                SELECT c, j, CAST((s - ((s % n) + n) % n) / n AS BIGINT) AS m FROM (
                    SELECT best.c AS c, j, sum(CAST(q[j] AS HUGEINT)) AS s, CAST(count(*) AS HUGEINT) AS n
                    FROM a{r} JOIN points USING (id), range(1, 65) AS dims(j) GROUP BY ALL)) GROUP BY c),
        c{r + 1} AS MATERIALIZED (
            SELECT c{r}.c, coalesce(s{r}.center, c{r}.center) AS center FROM c{r} LEFT JOIN s{r} USING (c))""")
    return ",".join(steps)

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY norm)""",
    # words cut as the operator cuts them; windows as texts; a word goes when a window over it starts in a smaller doc_id
    "op7_substring_dedup": r"""
        WITH cut AS (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
            FROM documents),
        windows AS (
            SELECT doc_id, s, array_to_string(list_slice(words, s, s + 49), ' ') AS run
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS s FROM cut WHERE len(words) >= 50)),
        seen AS (SELECT run, min(doc_id) AS first FROM windows GROUP BY run),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p
            FROM windows JOIN seen USING (run) WHERE first < doc_id),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM cut),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS left_over
            FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(left_over, '')) AS kept_sha256
        FROM cut LEFT JOIN kept USING (doc_id)""",
    "op12_centroids": f"""
        WITH points AS MATERIALIZED (
            SELECT row_number() OVER () AS id, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = 64),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q AS center
            FROM (SELECT sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, q FROM points ORDER BY h, q LIMIT 8)),
        {_centroid_rounds()},
        found AS (
            SELECT vec_id, best.c AS c, best.d AS d FROM a{centroids.ROUNDS} JOIN points USING (id))
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
               CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(center, ',')) AS centroid_sha256
        FROM found JOIN c{centroids.ROUNDS} USING (c)""",
    "op13_collocations": r"""
        WITH cut AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
            FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
                  FROM documents)),
        sizes AS (SELECT lang, sum(len(w)) AS n FROM cut GROUP BY lang),
        counted AS MATERIALIZED (
            SELECT lang, k, g, count(*) AS f
            FROM (SELECT lang, k, list_slice(w, s, s + k - 1) AS g
                  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM cut, range(1, 4) AS lengths(k) WHERE len(w) >= k))
            GROUP BY ALL),
        candidates AS MATERIALIZED (SELECT lang, k, g, f AS a FROM counted WHERE k > 1 AND f >= 10),
        longer AS (
            SELECT lang, list_slice(g, s, s + 1) AS g, max(a) AS most FROM candidates, range(1, 3) AS starts(s) WHERE k = 3 GROUP BY ALL),
        cuts AS (
            SELECT c.lang, c.g, c.a, s AS cut, p.f AS l, q.f AS r,
                   (1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * q.f) AS score
            FROM candidates c, range(1, 3) AS places(s)
            JOIN counted p ON p.lang = c.lang AND p.g = list_slice(c.g, 1, s)
            JOIN counted q ON q.lang = c.lang AND q.g = list_slice(c.g, s + 1, c.k)
            WHERE s < c.k),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
        ranked AS (
            SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score,
                   row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
            FROM best LEFT JOIN longer USING (lang, g) WHERE most IS NULL OR 100 * most < 50 * a)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000""",
}
