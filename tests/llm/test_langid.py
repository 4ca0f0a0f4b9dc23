"""Languages beyond a few hundred; the network against a loop; recall of each language."""

import numpy as np
from pyspark.sql import functions as F

from changelake.llm.common import held_out
from changelake.llm.langid import FILTERS, SPAN, ByteNet, identify, train, training_sample, windows


def test_every_language_is_learned(docs_of):
    docs = docs_of([(i, f"some words of language number {i % 230}", f"l{i % 230}") for i in range(2300)])
    langs, rows, numbers = training_sample(docs, 3, 1)
    assert len(langs) == 230 == len(set(numbers.tolist())) and len(rows) == len(numbers)


def test_prediction_is_the_plain_convolution():
    """The frozen network's sums of byte pairs against a loop over filters, places and bytes."""
    net = ByteNet(["a", "b", "c"], seed=3)
    rows = np.concatenate([windows("Straße und Haus, 漢字 " * 20), windows("x"), windows("")])
    want = []
    for row in rows:
        pooled = []
        for w, table in net.tables.items():
            for f in range(FILTERS):
                pooled.append(max(sum(float(table[j, row[at + j], f]) for j in range(w)) for at in range(SPAN)))
        hidden = np.maximum(np.array(pooled) + net.bias, 0)
        z = np.exp(hidden @ net.out + net.out_bias)
        want.append(z / z.sum())
    assert np.allclose(net.frozen().predict(rows), want, atol=1e-4)


def test_held_out_recall_of_each_language(spark):
    """Fitted on the given rows that may be learned from; each language is found among the held-out ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = identify(docs, train(docs)).join(docs.select(F.col("doc_id"), "lang"), "doc_id").where(held_out() & F.col("lang").isNotNull()).collect()
    recall = {lang: np.mean([r.lang_pred == lang for r in got if r.lang == lang]) for lang in {r.lang for r in got}}
    print("recall", {k: (round(float(v), 3), sum(r.lang == k for r in got)) for k, v in sorted(recall.items())})
    assert len(recall) >= 3 and min(recall.values()) >= 0.9
