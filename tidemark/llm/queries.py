"""The queries of the training-data operators, over the tables in a folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, quality, toxicity
from .common import scratch_path, shipped
from .minhash import minhash_classes
from .mixing import mix_sizes
from .packing import PackSpec, packed
from .prefixtrie import numbered_turns, prefix_trie, rebuilt
from .simhash import hex_fingerprint, near_duplicate_classes
from .spotsigs import edited_fingerprints
from .tokenbin import TokenFileSpec, read_token_files, write_token_files
from .tokencount import CountSpec, counted
from .urlfilter import UrlRules, judged_urls
from .whitening import whitened

URL_RULES = UrlRules(
    rules=(("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")),
    block_globs=("*casino*", "*pills*", "*free-bets*", "*ads-track*"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mix_sizes(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate")


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_table(spark, sf_dir, "documents"), PackSpec(public_tokenizers.path("word_bpe_49k.json")))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), path, TokenFileSpec(public_tokenizers.path("word_bpe_49k.json")))
    return read_token_files(spark, path)


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    found = docs.select("doc_id", langid.held_out(docs["doc_id"]).alias("held_out"), langid.language_of(model, docs).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.share").alias("share"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, so that each call counts every distinct text."""
    spec = CountSpec(public_tokenizers.path("piece_bpe_32k.model"))
    return counted(_table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"), spec)


OP4_SQL = r"""WITH cut AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (SELECT page_id, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT parts.page_id, host, path, rule, CASE WHEN rule IS NOT NULL THEN verdict
    WHEN regexp_matches(host || path, 'casino|pills|free-bets|ads-track') THEN 'block' ELSE 'allow' END AS verdict
FROM parts LEFT JOIN fits ON parts.page_id = fits.page_id AND place = 1"""

ORACLE_SQL = {"op4_url_filter": OP4_SQL}


def op8_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(_table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(labels["doc_id"])))
    scored = docs.select("doc_id", toxicity.held_out(docs["doc_id"]).alias("held_out"), toxicity.toxicity_of(model, docs).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", *quality.STATISTICS, "base_failed", "kept", "anomaly")


OP13_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda v: v <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM w),
t AS (SELECT doc_id, unnest(s) AS shingle FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * n >= 80 * (len(a.s) + len(b.s) - n)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS seen FROM s UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.seen)
SELECT doc_id, len(any_value(s))::BIGINT AS n_shingles, min(seen) AS component_id, doc_id = min(seen) AS kept FROM s JOIN r USING (doc_id) GROUP BY doc_id"""

ORACLE_SQL["op13_minhash_near_dedup"] = OP13_SQL

# The inner lambda is a step of crc32 for one bit, the outer one for a digit of the id.
OP11_SQL = r"""WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS idx, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda a, d: list_reduce(list_prepend(xor(a, d), range(8)), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
b AS (SELECT c.conv_id, 0 AS own, idx, role, text FROM c JOIN t ON t.conv_id = c.base AND idx <= h UNION ALL SELECT c.conv_id, 1, idx, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND idx > h),
p AS (SELECT conv_id, 0 AS depth, '' AS node, 0 AS bytes FROM c
    UNION ALL SELECT conv_id, row_number() OVER w, to_json(list([role, text]) OVER w)::VARCHAR, strlen(text) FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY own, idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
q AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM p),
n AS (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM q GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY 1),
s AS (SELECT q.node, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves FROM n LEFT JOIN k ON k.node = n.node JOIN q ON q.conv_id = n.conv_id AND q.depth <= n.depth GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN s ON s.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n u ON u.node = n.parent"""

ORACLE_SQL["op11_prefix_trie"] = OP11_SQL


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(numbered_turns(_table(spark, sf_dir, "conversations"))))


def op12_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(_table(spark, sf_dir, "embeddings"))


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = minhash_classes(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_pack_sequences, op3_token_files, op4_url_filter, op5_simhash_near_dedup, op6_language_id, op7_token_counts, op8_spot_fingerprints, op9_toxicity, op10_quality_rules, op11_prefix_trie, op12_whiten_embeddings, op13_minhash_near_dedup)}
