"""Collocations against a count of every n-gram."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changelake.llm.collocations import collocations, parse

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def pieces(text):
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
        words = re.findall("[^ \t]+", piece)
        if words:
            yield words


def brute(rows, max_words=3, min_count=10, cover_pct=50, top=2000):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i:i + n])) for n in range(1, max_words + 1) for i in range(len(words) - n + 1))
    found = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= min_count}
    longer = Counter()
    for (lang, words), f in found.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                key = (lang, words[i:i + n])
                longer[key] = max(longer[key], f)
    out = {}
    for (lang, words), a in found.items():
        if longer[lang, words] and 100 * longer[lang, words] >= cover_pct * a:
            continue
        score, _, l, r = min((1_000_000 * a * a // (counts[lang, words[:k]] * counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]])
                             for k in range(1, len(words)))
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), " ".join(words), a, l, r, totals[lang], score))
    return sorted((lang, rank, *x[3:]) for lang, xs in out.items() for rank, x in enumerate(sorted(xs)[:top], 1))


def sample():
    rnd = random.Random(5)
    words = ["New", "York", "is", "the", "of", "city", "big", "é", "漢", "A\x85B", "x\x1cy", "tea", "cup", "ÀB"]
    rows = []
    for _ in range(300):
        text = "".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?", "\x0c"]) for _ in range(rnd.randint(0, 40)))
        rows.append((rnd.choice(["en", "en", "fr", None, "und"]), text + "New York city " * rnd.randint(0, 3)))
    return rows + [("en", None), (None, ""), ("fr", " \t "), ("en", "copy of copies " * 30)] * 6


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "lang string, text string").repartition(parts)


@pytest.mark.parametrize("max_words,every,bits", [(3, 16, 1 << 27), (3, 1, 64), (2, 3, 1 << 20), (4, 2, 1 << 20)])
def test_against_brute_force(spark, max_words, every, bits):
    rows = sample()
    out = collocations(frame(spark, rows), max_words=max_words, every=every, table_bits=bits)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == brute(rows, max_words)


def test_top_and_counts_are_parameters(spark):
    rows = sample()
    got = collocations(frame(spark, rows), min_count=25, cover_pct=90, top=7)
    assert sorted(map(tuple, got.collect())) == brute(rows, min_count=25, cover_pct=90, top=7)


def test_chunks_hold_every_word_once(spark):
    rows = sample()
    words = Counter()
    for r in parse(frame(spark, rows), every=2).collect():
        chunk = bytes(r["chunk"]).decode().split(" ")
        words.update({(r["lang"], x): 0 for x in chunk})
        for x in chunk if r["last"] else chunk[:-2]:
            words[r["lang"], x] += r["n"]
    expected = Counter(("und" if lang is None else lang, w) for lang, text in rows for p in pieces(text) for w in p)
    assert +words == expected


def test_large_products_are_exact(spark):
    """Counts whose products pass 64 bits."""
    from changelake.llm import collocations as module
    big = 3_000_000_017
    chunks = spark.createDataFrame([("en", True, bytearray(b"a b"), big, 2), ("en", True, bytearray(b"a"), 5 * big, 1), ("en", True, bytearray(b"b"), 7, 1)],
                                   "lang string, last boolean, chunk binary, n long, owned long")
    found = {(r["n"], r["phrase"]): r["f"] for r in module.frequent_phrases(chunks).collect()}
    assert found == {(1, "a"): 6 * big, (1, "b"): big + 7, (2, "a b"): big}


def test_hot_word_pair_and_long_text(spark):
    rows = [("en", "hot pair " * 20_000), ("en", ("hot pair " * 50 + ". ") * 40)] + [("en", "hot pair")] * 300
    assert sorted(map(tuple, collocations(frame(spark, rows)).collect())) == brute(rows)


def test_odd_documents(spark, odd_docs):
    docs = odd_docs
    for name in ("chunk", "last", "n", "phrase", "rank", "a", "words", "total", "segment"):
        docs = docs.withColumn(name, F.lit(1))
    rows = [(r["lang"], r["text"]) for r in odd_docs.collect()]
    assert sorted(map(tuple, collocations(docs).collect())) == brute(rows)
    assert collocations(docs.limit(0)).collect() == []
