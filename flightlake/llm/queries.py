"""One query per operator over the driver tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm.embedding_dedup import embedding_links
from flightlake.llm.exact_dedup import exact_groups
from flightlake.llm.fingerprints import fingerprint_pairs
from flightlake.llm.line_dedup import deduplicated
from flightlake.llm.mixing import mix_sources
from flightlake.llm.ngram_join import ngram_components
from flightlake.llm.pieces import encode_documents
from flightlake.llm.pii import find_personal_data, fit_tagger
from flightlake.llm.prefix_trie import prefix_nodes
from flightlake.llm.quality import quality_table
from flightlake.llm.sql import EMBEDDING_LINKS, EXACT_DEDUP, NGRAM_JOIN, PREFIX_TRIE, SUBSTRING_DEDUP, TURN_REPAIR
from flightlake.llm.substring_dedup import remove_repeats
from flightlake.llm.turn_repair import repair_report
from flightlake.llm.url_filter import LISTED_LABELS, filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(_table(spark, sf_dir, "documents"))


def op2_url_filter_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return find_personal_data(docs, fit_tagger(docs))


def op4_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(_table(spark, sf_dir, "documents"))


def op5_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_table(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).drop("text_key")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = deduplicated(_table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


def op9_embedding_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(_table(spark, sf_dir, "embeddings"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_nodes(_table(spark, sf_dir, "conversations"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(_table(spark, sf_dir, "conversations"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_weighted_fingerprints": op1_weighted_fingerprints,
    "op2_url_filter_cascade": op2_url_filter_cascade,
    "op3_personal_data": op3_personal_data,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_quality_trees": op5_quality_trees,
    "op6_source_mixing": op6_source_mixing,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_line_dedup": op8_line_dedup,
    "op9_embedding_pivots": op9_embedding_pivots,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_turn_repair": op12_turn_repair,
    "op13_exact_dedup": op13_exact_dedup,
    "pipeline": pipeline,
}
SQL: dict[str, str] = {
    "op7_ngram_jaccard_join": NGRAM_JOIN,
    "op9_embedding_pivots": EMBEDDING_LINKS,
    "op10_substring_dedup": SUBSTRING_DEDUP,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_turn_repair": TURN_REPAIR,
    "op13_exact_dedup": EXACT_DEDUP,
    "op2_url_filter_cascade": f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
    list_has_any(string_split(host, '.'), {list(LISTED_LABELS)}) AS listed
  FROM parsed
)
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
}
