"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatledger.llm import (
    alignment,
    decontaminate,
    learned_partitions,
    mixing,
    prefix_trie,
    quality,
    secrets,
    sharding,
    simhash,
    token_counts,
    topk,
    url_filter,
    warc,
)
from chatledger.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_filter.RULES), "verdict string, host string, path string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive(table(spark, sf_dir, "pages"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at"
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), str(path))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [str(public_tokenizers.path(name)) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align_tokens(table(spark, sf_dir, "documents"), *paths)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return learned_partitions.search(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_secret_scan, op2_url_filter, op3_simhash, op4_quality, op5_decontamination,
        op6_top_k, op7_warc, op8_sharding, op9_token_counts, op10_mixing,
        op11_alignment, op12_prefix_trie, op13_ann, pipeline,
    )
    return {f.__name__: f for f in named}


#: SQL twins of what SQL can express; the other queries are tested against brute force.
ORACLE_SQL = {
    "op2_url_filter": r"""
        WITH parts AS (
            SELECT page_id,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        fits AS (
            SELECT *, CASE
                WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
            END AS rule FROM parts)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
        FROM fits""",
    "op6_top_k": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
            FROM vectors q JOIN vectors d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op7_warc": r"""
        WITH payloads AS (
            SELECT page_id, url, encode(coalesce(html, '')) AS body FROM pages),
        sized AS (
            SELECT page_id, url, body, octet_length(body)::BIGINT AS payload_bytes,
                   max(page_id) OVER (PARTITION BY body) AS response
            FROM payloads)
        SELECT page_id, payload_bytes, sha1(body) AS payload_digest,
               CASE WHEN payload_bytes >= 1000 AND response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND response <> page_id THEN response END AS refers_to,
               coalesce(array_to_string(list_reverse(string_split(
                   lower(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)), '.')), ',') || ')' ||
                   regexp_extract(url, '(?s)^.*?://[^/?#]*(.*)$', 1), '') AS url_key,
               strftime(make_timestamp((1704067200 + page_id % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured_at
        FROM sized""",
    "op12_prefix_trie": """
        WITH bytes AS (
            SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
                lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS crc),
        own AS (
            SELECT conv_id AS c, {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT DISTINCT c, c - c % 100 AS base, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda a: ascii(a)::BIGINT)),
                lambda s, b: xor(crc[(xor(s, b) & 255) + 1], s // 256))) % 6 AS h
            FROM own, bytes),
        rebuilt AS (
            SELECT v.c, 0 AS part, o.pos, o.x FROM convs v JOIN own o ON o.c = v.base AND o.pos <= v.h
            UNION ALL SELECT v.c, 1, o.pos, o.x FROM convs v JOIN own o ON o.c = v.c AND o.pos > v.h),
        paths AS (
            SELECT c, row_number() OVER w AS d, list(x) OVER w AS path FROM rebuilt
            WINDOW w AS (PARTITION BY c ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
            UNION ALL SELECT c, 0, [] FROM convs),
        lasts AS (SELECT c, max(d) AS last FROM paths GROUP BY c),
        nodes AS (
            SELECT path, d, min(c) AS c, count(*) AS n, any_value(CASE WHEN d > 0 THEN length(path[d].t) ELSE 0 END) AS size,
                   coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE last = d), '') AS ended
            FROM paths p JOIN lasts e USING (c) GROUP BY path, d),
        kids AS (
            SELECT parent.c, parent.d, count(*) AS n FROM nodes child JOIN paths up ON up.c = child.c AND up.d = child.d - 1
            JOIN nodes parent ON parent.d = up.d AND parent.path = up.path GROUP BY ALL),
        under AS (
            SELECT top.c, top.d, count(*) FILTER (WHERE k.n IS NULL) AS leaves, sum((b.n - 1) * b.size) AS saved
            FROM nodes b LEFT JOIN kids k ON k.c = b.c AND k.d = b.d
            JOIN paths up ON up.c = b.c AND up.d <= b.d JOIN nodes top ON top.d = up.d AND top.path = up.path
            GROUP BY ALL)
        SELECT a.c AS conv_id, a.d AS depth, parent.c AS parent_conv_id, a.n AS n_convs, coalesce(k.n, 0) AS n_children,
               u.leaves AS n_leaves, u.saved::BIGINT AS saved_tokens, sha256(a.ended) AS ends_sha256
        FROM nodes a LEFT JOIN kids k ON k.c = a.c AND k.d = a.d JOIN under u ON u.c = a.c AND u.d = a.d
        LEFT JOIN paths up ON up.c = a.c AND up.d = a.d - 1
        LEFT JOIN nodes parent ON parent.d = up.d AND parent.path = up.path""",
}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    return ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
