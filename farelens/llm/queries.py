"""Registered queries of the corpus operators over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farelens.llm import (
    ann_forest, bpe, fill_in_middle, fingerprint, langid, line_dedup, lm_scoring, ngram_join, packing,
    simhash, token_counts, url_filter, vector_codes)
from farelens.llm.common import read

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"), words=5, percent=75)


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(read(spark, sf_dir, "embeddings"), every=20, k=20)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(read(spark, sf_dir, "documents"), BYTE_BPE, capacity=2048)


def cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target: the documents that ``labels`` gives quality 1."""
    good = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_scoring.cross_entropy_difference(read(spark, sf_dir, "documents"), good)


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), PIECE_BPE, limit=4096)


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(read(spark, sf_dir, "documents"), BYTE_BPE)


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(spark, sf_dir, "documents"))


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate(
        read(spark, sf_dir, "documents").select("doc_id", "text"), passage_words=50)


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), words=3, distance=2)


def fill_in_middle_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(read(spark, sf_dir, "documents"), seed=1, percent=90, spm_percent=20)


def vector_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(
        read(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)


def vector_code_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The rounds written out one after the other; every distance is taken anew."""
    steps = [f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, label, [CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        cut AS MATERIALIZED (
            SELECT vec_id, label, CAST(p AS INT) AS p,
                   v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS x
            FROM kept, range({parts}) AS t(p)),
        book_0 AS MATERIALIZED (
            SELECT p, e, x AS c FROM cut JOIN (
                SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS e
                FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id))"""]
    for turn in range(rounds + 1):
        steps.append(f"""
        code_{turn} AS MATERIALIZED (
            SELECT vec_id, p, any_value(label) AS label, any_value(x) AS x,
                   min({{'far': far, 'e': e}}) AS best
            FROM (SELECT vec_id, label, p, x, e, list_sum([CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT)
                                                   FOR z IN list_zip(x, c)]) AS far
                  FROM cut JOIN book_{turn} USING (p))
            GROUP BY vec_id, p)""")
        if turn < rounds:
            steps.append(f"""
        book_{turn + 1} AS MATERIALIZED (
            SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book_{turn} b LEFT JOIN (
                SELECT p, e, list(CAST(floor(total / n) AS BIGINT) ORDER BY i) AS c
                FROM (SELECT p, best.e AS e, i, SUM(x[i]) AS total, COUNT(*) AS n
                      FROM code_{turn}, unnest(range(1, len(x) + 1)) AS t(i) GROUP BY 1, 2, 3)
                GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)""")
    steps.append(f"""
        rows AS (
            SELECT vec_id, any_value(label) AS label, CAST(SUM(best.far) AS BIGINT) AS error,
                   string_agg(lpad(lower(hex(best.e)), 2, '0'), '' ORDER BY p) AS code
            FROM code_{rounds} GROUP BY vec_id),
        digest AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256
            FROM book_{rounds})
        SELECT vec_id, code, error,
               CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM rows, digest""")
    return ",".join(steps[:-1]) + "," + steps[-1]


QUERIES = {
    "op1_ngram_jaccard_join": ngram_jaccard_join,
    "op2_nearest_neighbours": nearest_neighbours,
    "op3_best_fit_packing": best_fit_packing,
    "op4_cross_entropy_difference": cross_entropy_difference,
    "op5_token_counts": token_count,
    "op6_bpe_round_trip": bpe_round_trip,
    "op7_language_id": language_id,
    "op8_fingerprints": fingerprints,
    "op9_url_filters": url_filters,
    "op10_substring_dedup": substring_dedup,
    "op11_simhash_near_dedup": simhash_near_dedup,
    "op12_fill_in_middle": fill_in_middle_digests,
    "op13_vector_codes": vector_code,
}

ORACLE = {
    "op1_ngram_jaccard_join": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)])
                END AS s
            FROM split),
        shingles AS (SELECT doc_id, unnest(s) AS g FROM sets),
        pairs AS (
            SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS both_have
            FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
            WHERE 100 * both_have >= 75 * (len(x.s) + len(y.s) - both_have)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT doc_id AS id, doc_id AS low FROM documents
            UNION SELECT b, low FROM reach JOIN edges ON id = a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id
        FROM sets JOIN (SELECT id, MIN(low) AS component_id FROM reach GROUP BY id) ON id = doc_id""",
    "op9_url_filters": r"""
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0
                                 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1),
                                  '^[^?#]*') AS path
            FROM cut),
        hosts AS (
            SELECT page_id, path, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') AS host
            FROM parts),
        ruled AS (
            SELECT *, CASE
                WHEN (host = 'example.net' OR host LIKE '%.example.net')
                     AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com')
                     AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
                END AS rule
            FROM hosts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM ruled""",
    "op12_fill_in_middle": r"""
        WITH base AS (
            SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents),
        drawn AS (
            SELECT doc_id, t, n, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS c1,
                   CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS c2,
                   CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                             OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
                        WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM base),
        cut AS (
            SELECT doc_id, t, n, form, least(c1, c2) AS a, greatest(c1, c2) AS b FROM drawn),
        parts AS (
            SELECT doc_id, t, n, form, a, b, substring(t, 1, a) AS prefix,
                   substring(t, a + 1, b - a) AS middle, substring(t, b + 1) AS suffix
            FROM cut)
        SELECT doc_id, CAST(n AS BIGINT) AS n, form,
               CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts""",
    "op13_vector_codes": vector_code_sql(),
}
