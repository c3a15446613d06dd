"""Registered queries of this subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.llm import (conversation_repair, decontaminate, exact_dedup, html_text, language_id, licenses, line_dedup,
                            packing, sharding, simhash, token_alignment, toxicity, url_filter)
from tenderlake.llm.common import table
from tenderlake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

N_SHARDS = 24

RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), tokenizer_path())


@register("op2_benchmark_decontamination")
def benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op3_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op4_exact_dedup", oracle=r"""
    WITH d AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
""")
def exact_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.duplicate_decisions(table(spark, sf, "documents"))


@register("op5_license_scan")
def license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents"))


@register("op6_url_filter", oracle=r"""
    WITH RECURSIVE p AS (
        SELECT page_id, coalesce(url, '') AS u, html FROM pages),
    parts AS (
        SELECT page_id, html, u,
               translate(regexp_extract(u, '(?s)^.*?://([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(u, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM p),
    rules(verdict, h, s) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
        ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
    own AS (
        SELECT page_id, host, path, html, u,
               (SELECT max_by(struct_pack(n := h || s, v := verdict), length(h || s)) FROM rules
                WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)) AS r
        FROM parts),
    node AS (SELECT *, CASE WHEN contains(u, '://') THEN regexp_replace(u, '(?s)#.*$', '') END AS n FROM own),
    link AS (
        SELECT n AS a, regexp_extract(html, '(?is)<link\b[^>]*href="([^"]*)"', 1) AS b FROM node
        WHERE regexp_matches(html, '(?is)<link\b[^>]*rel="canonical"')),
    edge AS (SELECT a, b FROM link WHERE b <> '' UNION SELECT b, a FROM link WHERE b <> ''),
    reach AS (SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
    alias AS (
        SELECT reach.a AS n, min(node.r.v) AS v FROM reach JOIN node ON node.n = reach.b
        WHERE node.r.v IS NOT NULL GROUP BY 1)
    SELECT page_id, host, path, r.n AS rule, coalesce(r.v, alias.v, 'allow') AS verdict,
           CASE WHEN r.v IS NOT NULL THEN 'rule' WHEN alias.v IS NOT NULL THEN 'alias' ELSE 'default' END AS decided_by
    FROM node LEFT JOIN alias USING (n)
""")
def url_filter_query(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(table(spark, sf, "pages"), RULES)


@register("op7_toxicity")
def toxicity_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"), ~toxicity.held_out())
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@register("op8_html_extraction")
def html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return html_text.extract(table(spark, sf, "pages"))


@register("op9_sharding")
def sharding_query(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf, "documents"), N_SHARDS, scratch_path(spark, "slot-map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard",
                         "rebalanced_shard")


@register("op10_language_id")
def language_id_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = language_id.learn(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@register("op11_cross_tokenizer_alignment")
def token_alignment_query(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers
    rows, _ = token_alignment.align(table(spark, sf, "documents"), tokenizer_path(),
                                    public_tokenizers.path("piece_bpe_32k.model"))
    return rows


@register("op12_line_dedup", oracle=r"""
    WITH line AS (
        SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    keyed AS (
        SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM line),
    repeated AS (
        SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    judged AS (
        SELECT keyed.*, repeated.key IS NOT NULL AND doc_id <> top AS dropped FROM keyed LEFT JOIN repeated USING (key))
    SELECT doc_id, count(*) AS n_lines, CAST(count_if(dropped) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
""")
def line_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register("op13_conversation_structure_repair")
def conversation_repair_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations")
    return conversation_repair.report(rows, conversation_repair.damaged(rows))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)


QUERIES["pipeline"] = pipeline
