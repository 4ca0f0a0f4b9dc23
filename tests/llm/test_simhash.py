import random

import pytest
import xxhash
from pyspark.sql import functions as F

from changelake.llm import simhash as sh


def brute_fingerprint(text):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, radius=3):
    """rows (doc_id, fp) -> sorted (doc_id, component)."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    first = {}
    for d, f in rows:
        if d is not None:
            first[find(f)] = min(first.get(find(f), d), d)
    return sorted(((d, first.get(find(f))) for d, f in rows), key=str)


def test_fingerprint_matches_definition():
    for t in [None, "", "  ", "a", "A b", "a b c", "A  B\tc\nd", "é É ß", "x " * 300, "a b c\x1fd e f g"]:
        assert sh.fingerprint(t) == brute_fingerprint(t)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(str(i * i % 101) for i in range(500))
    whole = sh.fingerprint(text)
    monkeypatch.setattr(sh, "HASH_BLOCK", 7)
    assert sh.fingerprint(text) == whole


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_difference(radius):
    masks = sh.covering_masks(radius)
    rnd = random.Random(1)
    for _ in range(3000):
        diff = sum(1 << b for b in rnd.sample(range(64), radius))
        assert any(diff & m == 0 for m in masks)


def test_odd_documents(odd_docs):
    got = sh.simhash_dedup(odd_docs.withColumn("fingerprint", F.lit("clash"))).collect()
    assert len(got) == odd_docs.count()
    want = [(r.doc_id, brute_fingerprint(r.text)) for r in odd_docs.collect()]
    assert sorted((r.fingerprint for r in got)) == sorted(f"{f:016x}" for _, f in want)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == brute_components(want)


def test_empty_table(docs_of):
    out = sh.simhash_dedup(docs_of([]))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.collect() == []


def test_dense_buckets_are_split_without_losing_links(spark):
    """One cluster of thousands of fingerprints: bucket_rows forces the exact splitting."""
    rnd = random.Random(3)
    base = rnd.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rnd.sample(range(64), k)) for k in (1, 2, 3, 4, 5) for _ in range(120)}
    fps |= {rnd.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    df = spark.createDataFrame([(sh._signed(f),) for f in fps], "fp long")
    edges = sh.near_edges(df, 3, bucket_rows=8)
    from changelake.llm.components import connected_components
    roots = {r.v: r.root for r in connected_components(edges).collect()}
    want = brute_components(list(enumerate(fps)))
    groups = {}
    for i, f in enumerate(fps):
        groups.setdefault(roots.get(sh._signed(f), sh._signed(f)), []).append(i)
    got = sorted(((i, min(g)) for g in groups.values() for i in g), key=str)
    assert got == want


def test_query_against_brute_force(spark, sf_dir):
    from changelake.llm.queries import QUERIES
    got = QUERIES["op1_simhash_dedup"](spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = [(r.doc_id, brute_fingerprint(r.text)) for r in docs]
    assert sorted((r.doc_id, r.fingerprint) for r in got) == sorted((d, f"{f:016x}") for d, f in want)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=str) == brute_components(want)
