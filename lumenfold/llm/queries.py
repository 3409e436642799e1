"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import decontaminate, fm_dedup, html_extract, jaccard_join, language_id, lm_scoring, media, periodic_runs, quality, sp_codec, suffix_dedup, url_filter, whitening
from lumenfold.llm.common import table
from lumenfold.llm.oracles import ORACLES

#: Folder of public tokenizer files; none of them is part of this repository.
TOKENIZERS = "/opt/tokenizers"


def vocabulary(name: str = "piece_bpe_32k.model") -> str:
    return f"{TOKENIZERS}/{name}"


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store_payload(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages")).drop("score")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.find_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_codec.digest(table(spark, sf_dir, "documents"), sp_codec.codec(vocabulary()))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        *(op1_lm_scoring, op2_media_columns, op3_url_filters, op4_jaccard_join, op5_suffix_dedup, op6_language_id, op7_sentencepiece),
        *(op8_decontamination, op9_substring_dedup, op10_quality_classifier, op11_html_extraction, op12_periodic_runs, op13_embedding_whitening),
    )
}
__all__ = ["ORACLES", "QUERIES"]
