"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import collocations, decontaminate, html, mixing, pieces, pii, quality, ranking, scoring, sharding, simhash, substrings, tokens
from tessera.llm.common import table


def op1_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"))


def op2_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return pii.find(table(spark, d, "documents"))


def op3_main_text(spark: SparkSession, d: str) -> DataFrame:
    return html.extract(table(spark, d, "pages"))


def op4_cross_entropy_difference(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score(table(spark, d, "documents"), table(spark, d, "labels"))


def op5_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.judge(table(spark, d, "documents"))


def op6_simhash_groups(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def op7_shards(spark: SparkSession, d: str) -> DataFrame:
    return sharding.place(table(spark, d, "documents").select("doc_id"))


def op8_contaminated(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op9_repeated_substrings(spark: SparkSession, d: str) -> DataFrame:
    return substrings.removal_digests(table(spark, d, "documents"))


def op10_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_counts(table(spark, d, "documents"))


def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.mine(table(spark, d, "documents"))


def op12_ranked_search(spark: SparkSession, d: str) -> DataFrame:
    return ranking.search(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op13_sentence_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.digests(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_personal_data, op3_main_text, op4_cross_entropy_difference, op5_quality_rules,
        op6_simhash_groups, op7_shards, op8_contaminated, op9_repeated_substrings, op10_token_counts,
        op11_collocations, op12_ranked_search, op13_sentence_pieces,
    )
}

#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force.
ORACLES: dict[str, str] = {
    "op9_repeated_substrings": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), win AS (
            SELECT r, s, array_to_string(w[s : s + 34], ' ') AS t
            FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS s FROM d)
        ), cover AS (
            SELECT DISTINCT r, unnest(range(s, s + 35)) AS p
            FROM win SEMI JOIN (SELECT t FROM win GROUP BY t HAVING count(*) > 1) AS twice USING (t)
        ), token AS (
            SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
        ), kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY p) AS k, count(*) AS n FROM token ANTI JOIN cover USING (r, p) GROUP BY r
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(k, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)
    """,
    "op11_collocations": r"""
        WITH piece AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS p
            FROM documents
        ), w AS (
            SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
        ), word AS (
            SELECT lang, unnest(w) AS g FROM w
        ), gram AS MATERIALIZED (
            SELECT lang, 1 AS m, g, count(*) AS f FROM word GROUP BY ALL
            UNION ALL
            SELECT lang, m, g, count(*) AS f FROM (
                SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
                       lambda i: array_to_string(w[i : i + m - 1], ' '))) AS g
                FROM w, (VALUES (2), (3)) AS d(m) WHERE len(w) >= m
            ) GROUP BY ALL HAVING count(*) >= 10
        ), total AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE m = 1 GROUP BY lang
        ), cand AS (
            SELECT lang, m, g, f AS a, string_split(g, ' ') AS w FROM gram WHERE m >= 2
        ), cut AS (
            SELECT c.lang, c.g, c.a, k, l.f AS l, r.f AS r,
                   CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) AS c
            JOIN gram AS l ON l.lang = c.lang AND l.g = array_to_string(c.w[: c.k], ' ')
            JOIN gram AS r ON r.lang = c.lang AND r.g = array_to_string(c.w[c.k + 1 :], ' ')
        ), best AS (
            SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
        ), inside AS (
            SELECT lang, g, max(a) AS most FROM (
                SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS g
                FROM cand WHERE m = 3
            ) GROUP BY lang, g
        ), ranked AS (
            SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
            FROM best AS b LEFT JOIN inside USING (lang, g) WHERE most IS NULL OR 100 * most < 50 * a
        )
        SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
    """,
    "op12_ranked_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS t
            FROM documents
        ), q AS (
            SELECT item_id, text, list_distinct(list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), total AS (
            SELECT count(*) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM d WHERE len(t) > 0
        ), asked AS (
            SELECT item_id, text, unnest(t) AS term FROM q
        ), held AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d)
            SEMI JOIN asked USING (term) GROUP BY r, term
        ), weight AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM held, total GROUP BY term
        ), impact AS (
            SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(t) * n_docs) // n_terms))) AS x
            FROM held JOIN weight USING (term) JOIN d USING (r), total
        ), score AS (
            SELECT item_id, text, r, CAST(sum(x) AS BIGINT) AS score FROM asked JOIN impact USING (term) GROUP BY ALL
        ), ranked AS (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
            FROM score JOIN d USING (r) WHERE score > 0
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """,
}
