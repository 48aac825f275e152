"""One registered query per operator, each over its whole table with production parameters."""

from pyspark.sql import DataFrame, SparkSession

from usagelens.llm import conversations, filter_audit, line_rules, topk
from usagelens.llm.common import table
from usagelens.llm.decontaminate import contaminated_documents
from usagelens.llm.html_text import extract_pages
from usagelens.llm.licenses import document_licenses
from usagelens.llm.mixing import mix_documents
from usagelens.llm.near_dup import near_duplicate_classes
from usagelens.llm.quality import quality_scores
from usagelens.llm.repeats import without_repeats
from usagelens.llm.sharding import shard_documents
from usagelens.llm.token_files import tokenized_documents


def op1_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op3_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized_documents(table(spark, sf_dir, "documents"))


def op4_threshold_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(table(spark, sf_dir, "documents"))


def op5_block_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest_embeddings(table(spark, sf_dir, "embeddings"))


def op6_interval_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op7_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_nb_svm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_licenses(table(spark, sf_dir, "documents"))


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_verdicts(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_target_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.conversation_repairs(table(spark, sf_dir, "conversations"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_jump_shards,
        op2_dart_minhash,
        op3_huffman_ids,
        op4_threshold_mix,
        op5_block_topk,
        op6_interval_tree,
        op7_wu_manber,
        op8_site_templates,
        op9_nb_svm,
        op10_patience_licenses,
        op11_line_rules,
        op12_filter_audit,
        op13_target_alignment,
    )
}

_WINDOWS = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate({text}, '{upper}', '{lower}'), '{word}') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(translate({text}, '{upper}', '{lower}'), '{word}') AS w FROM benchmark
), wi AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS t
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM wi), dw AS (
    SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
    FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
), m AS (SELECT r, i, wi.n, item_id FROM dw JOIN wi ON dw.n = wi.n AND dw.t = wi.t), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY r
), it AS (
    SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
""".format(
    text="coalesce(text, '')",
    upper="ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    lower="abcdefghijklmnopqrstuvwxyz",
    word=r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
)

# the others need hashes, models, alignments or formats that SQL does not have; tests compare them with brute force
ORACLES: dict[str, str] = {
    "op5_block_topk": topk.ORACLE,
    "op7_wu_manber": _WINDOWS,
    "op11_line_rules": line_rules.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_target_alignment": conversations.ORACLE,
}
