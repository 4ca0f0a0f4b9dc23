"""Every operator on odd documents, empty tables and clashing columns, and against brute force."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from changelake.llm import bpe, embedding_dedup, html_text, langid, line_dedup, mixing, quality_model, quality_rules, token_files
from changelake.llm.pretokens import Memory

BLANK = " \t\n\x0b\x0c\r"
RANKS, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD_TEXTS = ["", " ", "a  b", "  x", "x  ", "\n a", "a \n b\n\nc", "a   b", "a \n", "a\n ", "   ", "x  y", "it's we'll.",
             "漢字 かな 😀 \x85 z", "\x1c a \x1d", "<|endoftext|> x", "A" * 3000 + " " + "ab" * 900, "ǅ ʰ ª ² ½ Ⅷ ٣ 〇"]


def ids_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ------------------------------------------------------------------ mixing

def test_mixing_keeps_all_rows_within_one_block(docs_of):
    rows = [(i, "t", "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(900)] + [(None, None, None, None), (5, "t", "en", "hot")]
    out = mixing.mix_sources(docs_of(rows).withColumn("slot", F.lit(1)), block_rows=4, bucket_rows=50, period=64, max_components=16).collect()
    assert Counter((r.doc.doc_id, r.doc.source) for r in out) == Counter((r[0], r[3]) for r in rows)
    slots = sorted({(r.slot, r.component, r.block, r.release, r.deadline, r.q) for r in out})
    assert len({s[0] for s in slots}) == len(slots)
    assert all(release <= slot < deadline for slot, _, _, release, deadline, _ in slots)
    assert len({(r.slot, r.offset) for r in out}) == len(out)
    last = {c: max(s[0] for s in slots if s[1] == c) for c in {s[1] for s in slots}}
    quota, run = {s[1]: s[5] for s in slots}, Counter()
    for t in range(min(last.values()) + 1):
        run.update(s[1] for s in slots if s[0] == t)
        assert all(abs(run[c] - (t + 1) * quota[c] / 256) < 1 for c in quota)
    assert sum(quota.values()) == 256  # 16 slots each of 9 sources


def test_mixing_weights_pooled_sources_and_empty(docs_of):
    rows = [(i, "t", "en", f"s{i % 40}") for i in range(400)]
    out = mixing.mix_sources(docs_of(rows), weights={"s1": 3.0, "s2": 1.0}, other_weight=4.0, period=64, max_components=8).collect()
    assert {(r.doc.source if r.doc.source in ("s1", "s2") else "*", r.q) for r in out} == {("s1", 24), ("s2", 8), ("*", 32)}
    assert len(out) == 400
    assert len(mixing.mix_sources(docs_of(rows), period=32, max_components=8).collect()) == 400
    assert mixing.mix_sources(docs_of([])).collect() == []
    assert mixing.mixed_rows(docs_of(rows)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


# ------------------------------------------------------------- token files

def test_elias_fano_select():
    for values, universe in [([1], 1), ([3, 3, 9, 1000], 1000), (list(np.cumsum(np.arange(1, 700) % 13 + 1)), 10**6)]:
        ef = token_files.EliasFano.of(np.array(values), universe)
        assert ef.values().tolist() == values and [ef.select(i) for i in range(len(values))] == values


def test_token_files(odd_docs, docs_of):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = True
    extra = docs_of([(100 + i, t) for i, t in enumerate(ODD_TEXTS)])
    docs = odd_docs.unionByName(extra).withColumn("start", F.lit("clash"))
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.token_output(docs, JSON, shard_ids=500).collect())
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((at, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    assert token_files.token_output(docs_of([]), JSON).collect() == []


def test_memory_is_bounded_and_exact():
    memory = Memory(lambda pieces: [p.encode() for p in pieces], pieces=5)
    texts = ["one two three four five six seven.", "one two\nthree four, five", "", "x  y   z", "seven. six. one," * 3]
    for _ in range(3):
        assert [c.decode() for c in memory.codes(texts)] == texts
    assert len(memory.old) < 40


# --------------------------------------------------------------------- BPE

def test_bpe_is_tiktoken_and_round_trips(odd_docs, docs_of):
    import tiktoken
    tokens = bpe.read_ranks(RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    docs = odd_docs.unionByName(docs_of([(100 + i, t) for i, t in enumerate(ODD_TEXTS)]))
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    for r in bpe.bpe_round_trip(docs, RANKS, P.PATTERN, with_ids=True).collect():
        text = bytes(r.decoded).decode()
        assert texts[(r.doc_id, text)]
        assert r.ids == enc.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(r.ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.bpe_round_trip(docs_of([]), RANKS, P.PATTERN).collect() == []


# ---------------------------------------------------------- quality, language

@pytest.mark.parametrize("name, column", [("op4_quality_model", "predicted"), ("op7_language_id", "lang_pred")])
def test_held_out_accuracy(spark, sf_dir, name, column):
    from changelake.llm.queries import QUERIES
    got = QUERIES[name](spark, sf_dir).where("held_out")
    truth = (spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("want")) if name.startswith("op4")
             else spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("lang").alias("want")))
    rows = got.join(truth.where("want is not null"), "doc_id").select(column, "want", "score").collect()
    assert rows and all(0 <= r.score <= 1 for r in rows)
    assert sum(r[0] == r[1] for r in rows) >= 0.9 * len(rows)


def test_models_on_odd_documents(odd_docs, docs_of, spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (8, None, None)], "doc_id long, quality int, toxic int")
    model = quality_model.train(odd_docs, labels)
    out = quality_model.score(odd_docs.withColumn("score", F.lit("clash")), model).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    nothing = quality_model.train(docs_of([]), labels.limit(0))
    assert [r.score for r in quality_model.score(docs_of([(1, "a")]), nothing).collect()] == [0.5]
    assert quality_model.score(docs_of([]), nothing).collect() == []
    assert {r.lang_pred for r in langid.identify(odd_docs, langid.train(docs_of([]))).collect()} == {"und"}
    pred = {r.doc_id: r.lang_pred for r in langid.identify(odd_docs, langid.train(odd_docs)).collect()}
    assert pred[3] == pred[2] == pred[4] == "und" and pred[1] in {"en", "de", "fr"}
    assert langid.identify(docs_of([]), None).collect() == []


def test_hinge_dual_separates():
    rnd = np.random.default_rng(1)
    y = np.where(np.arange(200) % 2, 1, -1)
    rows = [np.unique(np.append(rnd.integers(2, 50, 5), 1 if v > 0 else 0)) for v in y]
    w, b = quality_model.hinge_dual(rows, np.ones(50), y, 50)
    assert all((sum(w[r]) + b) * v > 0 for r, v in zip(rows, y))


# ------------------------------------------------------------------- rules

def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {p for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(BLANK)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_quality_rules(odd_docs, docs_of):
    extra = docs_of([(50, "a a a a a a a\nb\nb\n b"), (51, "one two three four five x one two three four five"),
                     (52, "Home | About | Contact | News | Terms\n" + "A plain sentence with enough words to stay here. " * 3),
                     (53, "WOW!! BUY!! NOW!! " * 5), (54, "All rights reserved.\n" + "Some good words in a line of text here."),
                     (55, "\n\n\x85!!\x85\n")])
    docs = odd_docs.unionByName(extra).withColumn("kept", F.lit("clash"))
    out = quality_rules.clean_lines(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_base(r.doc.text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    clean = {r.doc.doc_id: r for r in out}
    assert clean[52].clean_text.startswith("A plain") and not clean[53].kept and "reserved" not in clean[54].clean_text
    assert clean[3].clean_text is None
    assert quality_rules.clean_lines(docs_of([])).collect() == []


# -------------------------------------------------------------------- HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class="no-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">A menu entry, long</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad-banner">Buy this now, it is good.</div><div class="cookie notice">We use cookies, of course.</div>
<article><h1>Title &amp; more</h1><p>First  paragraph, with <b>bold</b> text and&nbsp;words; enough of them to count.
<p>Second paragraph &lt;here&gt;, also long enough to be the text of an article.<ul><li>A point, in a list.</ul></article>
<aside>Sidebar text, not wanted.</aside><form>Name, please: <input></form>
<section id="comments"><p>I am a reader, and this is my comment, a long one, longer than most of the article itself is.</p></section>
<footer>&copy; nobody, ever.</footer>"""


def test_html_extraction(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "plain words"), (4, "u", "<p>a<br>b &amp c"),
            (5, "u", "<" * 2000 + "<p x='" + "y" * 1000), (1, "u", PAGE), (6, "u", "<div>" * 3000 + "deep text, here" + "</div>" * 10)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = html_text.extract_text(pages).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    text = {r.page_id: r.text for r in out}
    assert text[1].split("\n") == [
        "Title & more", "First paragraph, with bold text and words; enough of them to count.",
        "Second paragraph <here>, also long enough to be the text of an article.", "A point, in a list."]
    assert text[2] == text[3] == "" and text[None] == "plain words" and text[4] == "a b & c" and text[6] == "deep text, here"
    assert html_text.extract_text(pages.limit(0)).collect() == []


# ------------------------------------------------------------------- lines

def brute_lines(rows, min_chars, min_docs):
    low = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(BLANK))
    held = {}
    for n, (d, t) in enumerate(rows):
        for line in (t or "").split("\n"):
            if len(low(line)) >= min_chars:
                held.setdefault(low(line), {})[n] = d
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            who = held.get(low(x), {})
            ids = [i for i in who.values() if i is not None]
            if len(who) < min_docs or d == (max(ids) if ids else None):
                kept.append(x)
        out.append((d, "\n".join(kept) if t is not None else None, len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("twice_bits", [1 << 20, 64])
def test_line_dedup(odd_docs, docs_of, twice_bits):
    common, other = "This LINE is common to many documents, é!", "And this one is shared by a few documents only"
    extra = [(200 + i, f"{common.lower() if i % 2 else common}\n own line {i}\n\t{other if i < 3 else 'short'} \n{common}") for i in range(8)]
    docs = odd_docs.unionByName(docs_of([*extra, (207, extra[7][1]), (None, common)])).withColumn("gone", F.lit("clash"))
    want = brute_lines([(r.doc_id, r.text) for r in docs.collect()], 20, 4)
    out = line_dedup.line_dedup(docs, min_chars=20, min_docs=4, twice_bits=twice_bits)
    got = sorted(((r.doc.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in out.collect()), key=str)
    assert got == want and sum(w[3] for w in want) > 0
    assert line_dedup.line_dedup(docs_of([])).collect() == []


# -------------------------------------------------------------- embeddings

def brute_vectors(rows):
    """rows (vec_id, vector, label) -> (vec_id, n_links, component_id)."""
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float64)
        return v / np.linalg.norm(v)
    units = [unit(v) if label is not None else None for _, v, label in rows]
    near = [[j for j in range(len(rows)) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
             and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids, default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [512, 16])
def test_embedding_dedup(spark, block):
    rnd = np.random.default_rng(5)
    centre = rnd.normal(size=(6, 16))
    rows = [(i, [float(x) for x in (centre[i % 6] + rnd.normal(0, 0.06, 16)).astype(np.float32)], i % 2) for i in range(150)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(20)] + [(0, rows[0][1], 0), (2000, rows[0][1], None), (2001, None, 0), (2002, [], 0),
             (2003, [0.0] * 16, 0), (2004, [float("nan")] + [1.0] * 15, 0), (2005, [None] + [1.0] * 15, 0), (2006, [1.0, 2.0], 0),
             (2007, [2.0, 4.0], 0), (None, rows[3][1], 1), (2008, [float("inf")] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("kept", F.lit("clash")).repartition(3)
    out = embedding_dedup.embedding_dedup(df, block=block).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=str) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert embedding_dedup.embedding_dedup(df.limit(0)).collect() == []
