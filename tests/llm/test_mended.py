"""Cases that failed once: clashing columns, texts without a letter, ids too wide, folders without a scheme."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm import quality_model
from changelake.llm.langid import has_letter, identify, train
from changelake.llm.token_files import EliasFano, _qualified, pack, unpack

NAMES = ("y", "label_id", "n", "n1", "gram", "grams", "f", "doc", "score", "held_out", "own_id", "own_text", "lang_pred", "nth", "draw", "bytes")


def clashing(docs):
    for name in NAMES:
        docs = docs.withColumn(name, F.lit("x"))
    return docs


def test_quality_model_with_clashing_columns(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    plain, extra = (quality_model.train(d, labels) for d in (docs, clashing(docs)))
    assert plain.weights == extra.weights and plain.bias == extra.bias
    scored = quality_model.score(clashing(docs), extra)
    assert scored.columns == ["doc", "score"] and scored.count() == docs.count()


def test_language_with_clashing_columns_and_without_letters(spark, docs_of):
    docs = docs_of([(i, f"some words in a language {i}", "en") for i in range(40)]
                   + [(100, "½ ² ① 12", None), (101, "١٢٣ _", None), (102, "漢", None), (103, "é", None)])
    got = {r["doc_id"]: r["lang_pred"] for r in identify(clashing(docs), train(clashing(docs))).collect()}
    assert got[100] == got[101] == "und" and got[102] == got[103] == "en"
    assert not has_letter("½²①") and has_letter("½a")


def test_quality_scores_against_a_plain_refit(spark, sf_dir):
    """Scores are the logistic of the model's sum over the distinct indicators of a text; held-out documents of class 0 score lower."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.train(docs, labels)
    rows = quality_model.score(docs, model).join(labels.withColumnRenamed("doc_id", "labelled"), F.col("doc.doc_id") == F.col("labelled")).select(
        "score", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == k] for k in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc >= 0.95


def test_ids_too_wide_for_the_file_are_refused():
    ids = np.array([1, 70_000], "<u4").tobytes()
    with pytest.raises(ValueError, match="id_width=4"):
        pack([1], [2], ids, 2)
    assert unpack(pack([1], [2], ids, 4))[2].tolist() == [1, 70_000]


def test_select_gives_every_end():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 5000, 2000))
    ef = EliasFano.of(ends, int(ends[-1]))
    assert [ef.select(i) for i in range(ef.n)] == ends.tolist()


def test_folder_without_a_scheme_gets_the_one_of_spark(spark, tmp_path):
    assert _qualified(spark, str(tmp_path)).startswith("file:/") and _qualified(spark, "file:/x/y") == "file:/x/y"
