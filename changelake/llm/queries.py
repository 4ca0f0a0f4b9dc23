"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import langid, quality_model
from changelake.llm.ann_search import nearest_neighbours
from changelake.llm.bpe import bpe_round_trip
from changelake.llm.collocations import collocations
from changelake.llm.common import held_out, table
from changelake.llm.embedding_dedup import embedding_dedup
from changelake.llm.html_text import extract_text
from changelake.llm.line_dedup import line_dedup
from changelake.llm.mixing import mix_sources
from changelake.llm.oracle import ORACLES
from changelake.llm.quality_rules import clean_lines
from changelake.llm.simhash import simhash_dedup
from changelake.llm.token_align import align_tokenizers
from changelake.llm.token_files import token_output

__all__ = ["ORACLES", "QUERIES"]


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix_sources(docs).select("doc.doc_id", "doc.source", "component", "q", "block", "release", "deadline", "slot", "offset")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs.select("doc_id", "text"), model).select(
        F.col("doc.doc_id").alias("doc_id"), held_out("doc.doc_id").alias("held_out"), "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc.doc_id", "n_lines", "n_dropped",
                                   F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op11_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_dedup, op2_mix_sources, op3_token_files, op4_quality_model, op5_quality_rules,
        op6_byte_bpe, op7_language_id, op8_html_text, op9_line_dedup, op10_embedding_dedup, op11_ann_search,
        op12_collocations, op13_token_alignment)
}
