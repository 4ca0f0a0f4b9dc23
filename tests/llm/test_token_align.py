"""Cross-tokenizer alignment against a token-by-token brute force."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from changelake.llm.token_align import align_tokenizers, byte_tokens, piece_tokens, same_bytes

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    return *byte_tokens(A), *piece_tokens(B)


def spans(ids, tokens):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(tokens[i]), i))
        at += len(tokens[i])
    return out


def one(text, tokenizers):
    """``(n_a, n_b, groups, links)`` of a text, every token pair compared."""
    a_model, a_tokens, b_model, b_tokens = tokenizers
    if not text:
        return 0, 0, [], []
    a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
    raw = (" " + text).encode()
    if b"".join(a_tokens[i] for i in a) != raw or b"".join(b_tokens[i] for i in b) != raw:
        return 0, 0, [], []
    sa, sb = spans(a, a_tokens), spans(b, b_tokens)
    links = [(x, y) for p, q, x in sa for r, s, y in sb if p < s and r < q]
    cuts = sorted({q for _, q, _ in sa} & {s for _, s, _ in sb})
    groups, low = [], 0
    for cut in cuts:
        groups.append(",".join(str(x) for p, q, x in sa if low <= p < cut) + "|" + ",".join(str(y) for r, s, y in sb if low <= r < cut))
        low = cut
    return len(a), len(b), groups, links


def brute(rows, tokenizers):
    each = [(doc_id, *one(text, tokenizers)) for doc_id, text in rows]
    count = Counter(pair for *_, links in each for pair in set(links))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return sorted(((d, n_a, n_b, len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "") for d, n_a, n_b, groups, links in each), key=str)


def texts():
    rnd = random.Random(7)
    alphabet = "ab cd\n\t ..,!?:;'é²½漢字 　  \r\x0b\x1c\x85 <s>▁</s>😀0129 don't I'm the of tion"
    out = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(150)]
    return out + ["", None, " ", "\n", "  ", "a", "a² .b².", "x.y z.", "hello, world.", "\r\n a;\r\n", "a <|endoftext|> b", "\x00", "aaa aa aaa",
                  "The quick brown fox jumps over the lazy dog"] * 2


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_against_brute_force(spark, tokenizers, limit):
    rows = [(k if k % 9 else None, t) for k, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = align_tokenizers(docs, A, B, broadcast_pairs=limit)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows, tokenizers)


def test_many_slices_give_the_same(spark, tokenizers, monkeypatch):
    from changelake.llm import token_align
    monkeypatch.setattr(token_align, "SLICE_DOCS", 7)
    rows = list(enumerate(texts()[:60]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    for limit in (1 << 20, 0):
        assert sorted(map(tuple, align_tokenizers(docs, A, B, broadcast_pairs=limit).collect()), key=str) == brute(rows, tokenizers)


def test_groups_text(spark, tokenizers):
    rows = [(1, "Hello tokenizers"), (2, None)]
    out = {r["doc_id"]: r for r in align_tokenizers(spark.createDataFrame(rows, "doc_id long, text string"), A, B, with_groups=True).collect()}
    assert out[1]["groups"] == ";".join(one(rows[0][1], tokenizers)[2]) and out[2]["groups"] == ""


def test_identity_prefers_whole_pieces(tokenizers):
    _, a_tokens, b_model, b_tokens = tokenizers
    identity = same_bytes(a_tokens, b_tokens, b_model.is_byte)
    a = a_tokens.index(b"a")
    assert b_tokens[identity[a]] == b"a" and not b_model.is_byte(int(identity[a]))
    assert all(a_tokens[i] == b_tokens[b] for i, b in enumerate(identity) if b >= 0)


def test_odd_documents(spark, odd_docs, tokenizers):
    docs = odd_docs
    for name in ("slice", "code", "codes", "docs", "n", "same", "pairs", "times", "groups", "a"):
        docs = docs.withColumn(name, F.lit("x"))
    out = align_tokenizers(docs, A, B)
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    short = [r for r in rows if not r[1] or len(r[1]) < 1000]
    expected = brute(short, tokenizers)
    got = sorted(map(tuple, out.collect()), key=str)
    assert len(got) == len(rows)
    # the long text has counts of its own; the others keep their tokens and groups
    assert {(*g[:5], g[7]) for g in expected} <= {(*g[:5], g[7]) for g in got}
    assert align_tokenizers(docs.limit(0), A, B).collect() == []
