"""The corpus operators as registered queries, with production parameters, over
whole tables; and their DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txlake.llm import exact_dedup, langid, licenses, mixing, ngram_join, packing, prefix_trie, repetition, substrings, topk, toxicity, url_filter, whitening
from txlake.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("matches")


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("component")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_components(table(spark, sf_dir, "embeddings"))


def op12_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge_quality(table(spark, sf_dir, "documents")).drop("longest_repeat", "spans")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), texts=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_ngram_join, op3_language, op4_mixing, op5_substrings, op6_packing, op7_exact_dedup, op8_topk, op9_licenses, op10_urls,
    op11_whitening, op12_repetition, op13_prefix_trie)}

ORACLES: dict[str, str] = {
    "op7_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents),
             r AS (SELECT *, row_number() OVER w AS nth, first_value(doc_id) OVER w AS keep_id,
                          count(*) OVER (PARTITION BY text_sha256) AS group_size
                   FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id))
        SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM r""",
    "op8_topk": """
        WITH v AS (SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q FROM embeddings
                   WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
                   FROM v a, v b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
             r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    # a text has a repeat of more than 50 words where a run of 51 stands twice
    "op12_repetition": r"""
        WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
             w AS (SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                          list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
             p AS (SELECT rid, k, i, md5(array_to_string(ws[i:i + k - 1], ' ')) AS g
                   FROM w, (VALUES (3), (5), (51)) AS s(k), unnest(range(1, len(ws) - k + 2)) AS u(i)),
             r AS (SELECT *, count(*) OVER (PARTITION BY rid, k, g) AS c FROM p),
             v AS (SELECT rid, k, count(DISTINCT i + j) AS n FROM r, unnest(range(0, k)) AS u(j) WHERE c > 1 GROUP BY rid, k),
             m AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                          len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
                          coalesce(v5.n, 0) AS n_repeat_words, coalesce(v3.n, 0) AS united_words, v51.n IS NULL AS short
                   FROM w LEFT JOIN v AS v3 ON v3.rid = w.rid AND v3.k = 3 LEFT JOIN v AS v5 ON v5.rid = w.rid AND v5.k = 5
                   LEFT JOIN v AS v51 ON v51.rid = w.rid AND v51.k = 51)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, united_words,
               n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * united_words <= 60 * n_words AND short AS kept
        FROM m""",
    # crc32 bit by bit; a node is the list of its turns
    "op13_prefix_trie": """
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
             o AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, left(role, 64), left(text, 64), sha256(role || chr(0) || text)) AS own,
                          xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], [CAST(ascii(c) AS UBIGINT) for c in string_split(CAST(conv_id AS VARCHAR), '')]),
                              lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
                                                       lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1))))) % 6 AS h
                   FROM t GROUP BY conv_id),
             b AS (SELECT o.conv_id, list_concat(coalesce(base.own[1:o.h], []), o.own[o.h + 1:]) AS turns
                   FROM o LEFT JOIN o AS base ON base.conv_id = o.conv_id - o.conv_id % 100),
             p AS (SELECT conv_id, len(turns) AS n, d, turns[1:d] AS prefix FROM b, unnest(range(0, len(turns) + 1)) AS u(d)),
             node AS (SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
                             sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
                      FROM p GROUP BY prefix, d),
             kids AS (SELECT prefix[1:d - 1] AS prefix, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
             one AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (prefix)),
             sums AS (SELECT one.prefix[1:k] AS prefix, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
                             sum(CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(one.prefix[d].t) END) AS saved_tokens
                      FROM one, unnest(range(0, d + 1)) AS u(k) GROUP BY 1)
        SELECT one.conv_id, one.d AS depth, up.conv_id AS parent_conv_id, one.n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
               CAST(saved_tokens AS BIGINT) AS saved_tokens, one.ends_sha256
        FROM one JOIN sums USING (prefix) LEFT JOIN node AS up ON one.d > 0 AND up.prefix = one.prefix[1:one.d - 1]""",
}
