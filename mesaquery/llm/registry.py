"""The contract queries: each runs its operator over whole tables and derives the asked columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mesaquery.llm import chat, decontaminate, embedding_dedup, html_extract, jaccard_join, language_id, lm_scoring, merkle, packing, quality, token_files, url_filter, vector_codes
from mesaquery.llm.common import table

#: The public tokenizer of the two token queries.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


#: Rules of the URL query.
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: A conversation whose texts are themselves control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_query(spark, table(spark, sf_dir, "documents"), TOKENIZER, end_id=2)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_trees(chat.chains(rows.union(control))))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages_of(table(spark, sf_dir, "documents")).drop("spans")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_scoring.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scores.withColumns({c: F.round(c, 6) for c in ("target_loss", "background_loss", "score")})


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"), n=4, percent=85)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, end_id=0, capacity=2048)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes_query(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audited(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_query(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline  # noqa: F401  the pipeline is part of this subpackage: no import, no queries

    return {f.__name__: f for f in (op1_url_filter, op2_token_files, op3_decontaminate, op4_html_extraction, op5_chat_format, op6_language_id, op7_lm_scoring, op8_embedding_dedup, op9_jaccard_join, op10_packing, op11_vector_codes, op12_merkle_manifest, op13_quality_rules, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": decontaminate.ORACLE_SQL, "op5_chat_format": chat.ORACLE_SQL, "op7_lm_scoring": lm_scoring.ORACLE_SQL, "op8_embedding_dedup": embedding_dedup.ORACLE_SQL, "op9_jaccard_join": jaccard_join.ORACLE_SQL, "op11_vector_codes": vector_codes.ORACLE_SQL, "op12_merkle_manifest": merkle.ORACLE_SQL, "op13_quality_rules": quality.ORACLE_SQL}
