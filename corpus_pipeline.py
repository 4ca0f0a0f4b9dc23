"""A training corpus from ``documents``: five stages, each written and read again.

quality classifier -> line dedup -> SimHash near-dedup -> mixing -> BPE.
The first four return the columns of ``documents``; the last one returns the
token ids of each document and its position in the mixture.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.llm import quality_model
from changelake.llm.bpe import bpe_round_trip
from changelake.llm.common import materialize, numbered, table
from changelake.llm.line_dedup import line_dedup
from changelake.llm.mixing import mixed_rows
from changelake.llm.simhash import simhash_dedup

# The stages are fitted models, hashing and byte-pair encoding, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives class 1 with at least its threshold."""
    model = quality_model.train(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).where(F.col("score") >= quality_model.THRESHOLD).select("doc.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents keep; ``n_chars`` follows the text."""
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("kept_text").cast(kind)).otherwise(F.col("doc.n_chars"))
    return line_dedup(docs).select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id (of a repeated id, the row written first).
    Rows without an id, which no result can name, all stay."""
    rows = numbered(docs, "pipeline-rows")
    named = rows.where("doc.doc_id is not null")
    # a row's position stands for its id, which need not be unique, so a group is never taken for another
    found = simhash_dedup(named.select(F.col("position").alias("doc_id"), "doc.text"), shingle=3, radius=3)
    ids = named.select("position", F.col("doc.doc_id").alias("own_id"))
    first = (found.join(ids, found.doc_id == ids.position).groupBy("component_id")
             .agg(F.min(F.struct("own_id", "position"))["position"].alias("first")).select("first"))
    kept = named.join(first, named.position == first["first"], "left_semi").select("doc.*")
    return kept.unionByName(docs.where("doc_id is null"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture."""
    return mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and of the decoded text, and its ``position``
    from 0 in the order that the stage before wrote: the order in which training reads the corpus."""
    placed = numbered(docs, "pipeline-ordered").select("doc.doc_id", "doc.text", "position")
    encoded = bpe_round_trip(placed, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
                             with_ids=True, keep=("position",))
    return encoded.drop("decoded")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_copies),
    ("mixing sources to target weights", mix),
    ("byte-level BPE encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
