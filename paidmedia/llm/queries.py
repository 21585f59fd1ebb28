"""Every operator over its whole table, by name."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paidmedia.llm import (
    centroids,
    decontaminate,
    licenses,
    line_dedup,
    neighbours,
    packing,
    pii,
    prefix_trie,
    quality,
    sharding,
    simhash,
    toxicity,
    url_filter,
)
from paidmedia.llm.common import table

SHARDS = 40
K = 10
QUERY_EVERY = 100

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size counts the text's bytes and 16 more; a null text has no bytes and checksum 0."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.shuffle_into_shards(docs, SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.RULES).drop("url")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.word_tokenizer())


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = neighbours.Index(table(spark, sf_dir, "embeddings"))
    return index.search(index.rows.where(F.col("vec_id") % QUERY_EVERY == 0), K)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": op1_simhash,
        "op2_sharding": op2_sharding,
        "op3_url_filter": op3_url_filter,
        "op4_decontaminate": op4_decontaminate,
        "op5_quality": op5_quality,
        "op6_packing": op6_packing,
        "op7_neighbours": op7_neighbours,
        "op8_toxicity": op8_toxicity,
        "op9_line_dedup": op9_line_dedup,
        "op10_licenses": op10_licenses,
        "op11_centroids": op11_centroids,
        "op12_pii": op12_pii,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def centroid_sql(k: int, rounds: int, seed: int) -> str:
    """The rounds as common table expressions: nearest centroid, then the floor of each mean."""
    size = centroids.DIMENSIONS
    steps = [
        f"""kept AS MATERIALIZED (
            SELECT row_number() OVER () AS rid, vec_id,
                list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT rid, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM kept),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v AS m
            FROM kept QUALIFY c < {k})"""
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""a{r} AS MATERIALIZED (
            SELECT rid, min(far)::BIGINT AS distance, arg_min(c, far * {k} + c) AS c FROM (
                SELECT rid, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS far
                FROM kept CROSS JOIN c{r}) GROUP BY rid)"""
        )
        if r < rounds:
            steps.append(
                f"""c{r + 1} AS MATERIALIZED (
            SELECT c, coalesce(n.m, o.m) AS m FROM c{r} o LEFT JOIN (
                SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY d) AS m FROM (
                    SELECT c, d, sum(x) AS s, count(*) AS n FROM parts JOIN a{r} USING (rid) GROUP BY c, d)
                GROUP BY c) n USING (c))"""
            )
    return f"""
            WITH {", ".join(steps)}
            SELECT vec_id, c::INT AS cluster, distance,
                (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
                (sum(distance) OVER ())::BIGINT AS inertia,
                sha256(array_to_string(m, ',')) AS centroid_sha256
            FROM kept JOIN a{rounds} USING (rid) JOIN c{rounds} USING (c)"""


#: The checksum bit by bit, over the bytes of a decimal number.
CRC32 = """xor(4294967295::BIGINT, list_reduce(
    list_transform(generate_series(1, length(t)), lambda i: ascii(substring(t, i, 1))::BIGINT),
    lambda crc, byte: list_reduce(generate_series(1, 8),
        lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, xor(crc, byte)),
    4294967295::BIGINT))"""

TRIE_SQL = f"""
            WITH own AS MATERIALIZED (
                SELECT conv_id::BIGINT AS conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
                FROM conversations WHERE conv_id IS NOT NULL),
            convs AS MATERIALIZED (
                SELECT conv_id, conv_id - conv_id % {prefix_trie.GROUP} AS base, {CRC32} % {prefix_trie.HEADS} AS h
                FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS t FROM own)),
            rebuilt AS (
                SELECT c.conv_id, 0 AS part, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base AND o.place <= c.h
                UNION ALL
                SELECT c.conv_id, 1, o.place, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h),
            placed AS MATERIALIZED (
                SELECT conv_id, md5(length(role) || ':' || role || text) AS turn, length(text) AS n,
                    row_number() OVER (PARTITION BY conv_id ORDER BY part, place) AS depth FROM rebuilt),
            prefixes AS MATERIALIZED (
                SELECT conv_id, 0 AS depth, '' AS p, NULL AS above, 0 AS n FROM convs
                UNION ALL
                SELECT conv_id, depth, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth),
                    coalesce(string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), ''), n FROM placed),
            lengths AS (SELECT conv_id, max(depth) AS longest FROM prefixes GROUP BY 1),
            nodes AS MATERIALIZED (
                SELECT p, min(above) AS above, min(conv_id) AS conv_id, any_value(depth) AS depth, count(*) AS n_convs,
                    any_value(n) AS n,
                    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = longest), ''))
                        AS ends_sha256
                FROM prefixes JOIN lengths USING (conv_id) GROUP BY p),
            children AS (SELECT above AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
            marked AS (
                SELECT nodes.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * n AS saves FROM nodes
                LEFT JOIN children USING (p)),
            -- Every node counts in each of its prefixes.
            sums AS (
                SELECT left(p, d * 32) AS p, sum(saves) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
                FROM (SELECT p, saves, n_children, unnest(generate_series(0, depth)) AS d FROM marked) GROUP BY 1)
            SELECT m.conv_id, m.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves,
                saved_tokens::BIGINT AS saved_tokens, m.ends_sha256
            FROM marked m JOIN sums USING (p) LEFT JOIN nodes u ON m.depth > 0 AND u.p = m.above"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that SQL can express; the tests check the others by brute force."""
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
    out = {
        "op3_url_filter": f"""
            WITH located AS (
                SELECT page_id,
                    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
                FROM pages),
            rules(r_host, r_path, r_verdict) AS (VALUES {rules})
            SELECT page_id, host, path,
                (SELECT max_by(r_host || r_path, length(r_host) * 10000 + length(r_path)) FROM rules
                 WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS rule,
                coalesce((SELECT max_by(r_verdict, length(r_host) * 10000 + length(r_path)) FROM rules
                 WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)), 'allow')
                    AS verdict
            FROM located""",
        "op9_line_dedup": rf"""
            WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
            lines AS (
                SELECT rid, source, unnest(generate_series(1, len(string_split(text, chr(10))))) AS place,
                    unnest(string_split(text, chr(10))) AS line
                FROM docs WHERE text IS NOT NULL),
            seen AS (
                SELECT source, trim(line, ' ' || chr(9) || chr(13)) AS bare, count(DISTINCT rid) AS n
                FROM lines WHERE source IS NOT NULL GROUP BY 1, 2),
            pages AS (SELECT source, count(*) AS pages FROM docs WHERE text IS NOT NULL GROUP BY 1),
            boiler AS (
                SELECT source, bare FROM seen JOIN pages USING (source)
                WHERE bare <> '' AND n >= {line_dedup.MIN_PAGES} AND n > {line_dedup.RATIO} * pages),
            judged AS (
                SELECT l.rid, l.place, l.line, b.bare IS NOT NULL AS gone FROM lines l LEFT JOIN boiler b
                ON l.source = b.source AND trim(l.line, ' ' || chr(9) || chr(13)) = b.bare),
            rebuilt AS (
                SELECT rid, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS text,
                    count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped
                FROM judged GROUP BY rid)
            SELECT doc_id, source, r.text AS text, n_lines::INT AS n_lines,
                coalesce(n_dropped, 0)::INT AS n_dropped
            FROM docs LEFT JOIN rebuilt r USING (rid)""",
        "op13_prefix_trie": TRIE_SQL,
        "op11_centroids": centroid_sql(centroids.K, centroids.ROUNDS, centroids.SEED),
    }
    if corpus_pipeline.ORACLE_SQL:
        out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
