"""One query per operator over its whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import (
    bpe, contamination, divergence, negatives, packing, paragraphs, pseudonyms, quotes, subwords, urls, whitening, wrappers,
)
from tabwright.llm.neardup import near_duplicates
from tabwright.sources import read_parquet_table


def op10_distribution_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_parquet_table(spark, folder, "documents").select("doc_id", "text", "lang")
    references = divergence.language_references(docs)
    verdict = divergence.quality_verdict(references, F.col("text"), F.col("lang"))
    return docs.select("doc_id", verdict.alias("v")).select(
        "doc_id", *[f"v.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                       "base_failed", "kept", "class_distance", "word_distance")])


# fixed values: the rules of the url query
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
]
KEY = "a key for tests; real ones come from the caller"


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_parquet_table(spark, folder, "documents").select("doc_id", "text", "source")
    return packing.pack(packing.with_clusters(docs), F.col("n_words"), F.col("source"), F.col("cluster"))


def op2_redirect_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_parquet_table(spark, folder, "pages")
    return urls.judge_urls(pages.select("page_id", "url"), urls.page_links(pages), URL_RULES).drop("url")


def op3_wrapper_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_parquet_table(spark, folder, "pages").select("page_id", "url", "html")
    texts = wrappers.extract(pages, urls.host_of(F.col("url")))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_parquet_table(spark, folder, "documents").select("doc_id", "text")
    text = F.col("text")
    return docs.select("doc_id", F.coalesce(F.size(pseudonyms.found_values(text)), F.lit(0)).alias("n_found"),
                       pseudonyms.pseudonymised(text, KEY).alias("text"))


def op5_subword_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_parquet_table(spark, folder, "documents").select("doc_id", "text")
    model = subwords.train(docs, read_parquet_table(spark, folder, "labels"))
    return docs.select("doc_id", subwords.held_out(F.col("doc_id")).alias("held_out"),
                       subwords.score(F.col("text"), model).alias("score")) \
        .withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


def op6_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return quotes.link_quotes(read_parquet_table(spark, folder, "conversations"))


def op7_paragraph_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return paragraphs.all_repeated(read_parquet_table(spark, folder, "documents").select("doc_id", "text"))


def op8_pigeonhole_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_parquet_table(spark, folder, "documents").select("doc_id", "text")
    found = contamination.with_hits(docs, read_parquet_table(spark, folder, "benchmark")).drop("text")
    return found.select("doc_id", F.explode("hits").alias("hit")).select(
        "doc_id", F.col("hit.item").alias("item_id"), "hit.distance", "hit.ends")


def op9_minhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read_parquet_table(spark, folder, "documents").select("doc_id", "text"))


def op11_qd_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows, model = whitening.whiten(read_parquet_table(spark, folder, "embeddings").select("vec_id", "embedding"))
    long = rows.select("vec_id", "whitened.deviation", F.posexplode("whitened.values").alias("at", "whitened"))
    explained = F.array(*[F.lit(e) for e in (model.explained if model else [])]).cast("array<double>")
    return long.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(model.error if model else 0.0).alias("identity_error"))


def op12_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # only this query needs the vocabulary files

    source = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    docs = read_parquet_table(spark, folder, "documents").select("doc_id", "text")
    tokens = bpe.decode(bpe.encode(docs, source).drop("text"), source)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


def op13_cover_tree_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_parquet_table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows, F.col("id") % 100 == 0, label=label)


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_redirect_rules, op3_wrapper_extraction, op4_feistel_pseudonyms, op5_subword_classifier,
    op6_quotation_linking, op7_paragraph_minhash, op8_pigeonhole_decontamination, op9_minhash_neardup, op10_distribution_rules,
    op11_qd_whitening, op12_bpe_round_trip, op13_cover_tree_negatives,
)}

ORACLES = {
    "op2_redirect_rules": r"""
        WITH RECURSIVE rules(action, rule, name, start) AS (
            SELECT action, rule, split_part(rule, '/', 1), substr(rule, strpos(rule, '/')) FROM (VALUES ('allow', 'com/'),
                ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')) v(action, rule)),
        rests AS (SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        own AS (
            SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS query FROM rests),
        tags AS (SELECT host, path, query, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM own WHERE host <> ''),
        links AS (
            SELECT host, path, query, replace(CASE
                WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*["'']?\s*canonical\b')
                    THEN regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
                WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
                    THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?[^"''>]*?\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)
                ELSE '' END, '&amp;', '&') AS link FROM tags),
        targets AS (
            SELECT host || CASE WHEN path = '' THEN '/' ELSE path END || query AS a, CASE
                WHEN regexp_matches(link, '(?i)^https?://') THEN substr(link, strpos(link, '://') + 3)
                WHEN link LIKE '//%' THEN substr(link, 3) WHEN link LIKE '/%' THEN host || link
                ELSE host || CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '^.*/') ELSE '/' END || link END AS rest
            FROM links WHERE link <> '' AND (regexp_matches(link, '(?i)^https?://') OR NOT regexp_matches(link, '(?i)^[a-z][a-z0-9+.-]*:'))),
        edges AS (
            SELECT a, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                || CASE WHEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END
                || regexp_extract(rest, '^[^?#]*(\?[^#]*)', 1) AS b FROM targets WHERE regexp_matches(rest, '^[^/?#]')),
        both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
        reach AS (SELECT a, a AS b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
        actions AS (
            SELECT n.node, arg_max(action, length(rule)) AS action FROM (SELECT DISTINCT b AS node FROM reach) n JOIN rules
                ON (split_part(node, '/', 1) = name OR ends_with(split_part(node, '/', 1), '.' || name))
                AND starts_with(split_part(substr(node, strpos(node, '/')), '?', 1), start) GROUP BY n.node),
        blocked AS (SELECT DISTINCT reach.a AS node FROM reach JOIN actions ON reach.b = actions.node AND action = 'block'),
        judged AS (
            SELECT page_id, any_value(host) AS host, any_value(path) AS path, any_value(query) AS query,
                arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
            FROM own LEFT JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY page_id)
        SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule,
            coalesce(action, CASE WHEN node IS NULL THEN 'allow' ELSE 'block' END) AS verdict
        FROM judged LEFT JOIN blocked ON host || CASE WHEN path = '' THEN '/' ELSE path END || query = node""",
    "op9_minhash_neardup": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
        reach AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
        least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)""",
}
