"""Phrase collocations counted over a prefix-free parse.

A piece's words are cut where ``max_words - 1`` words in a row hash to a
trigger.  A chunk runs from one trigger to the next and holds both, so
chunks overlap by the trigger's words; equal chunks become one row of the
dictionary with their number.  An n-gram belongs to the chunk that holds its
first word outside the closing trigger: every occurrence lies in exactly one
chunk, whole.  n-grams are counted inside the distinct chunks, weighted.

Only phrases found ``min_count`` times matter.  A first pass over the
dictionary deals 32-bit hashes of all n-grams, with counts cut at
``min_count``, to segments; a segment marks the hashes that reach it in its
part of a bit table of bounded size.  A second pass counts, by their exact
words, the n-grams whose bit is set.  A bit set by chance costs a row, and no
phrase is lost; counts are whole.

Scores and the test on longer phrases are joins of the exact counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelake.llm.common import map_arrow, materialize, slices

MAX_WORDS = 3
MIN_COUNT = 10
COVER_PCT = 50
TOP = 2000
NO_LANG = "und"
SCALE = 1_000_000
SEED = 42
# A trigger ends a chunk after this many words on average.
CHUNK_WORDS = 16
CHUNKS_AT_ONCE = 1 << 18
WORDS_AT_ONCE = 1 << 18
BLOCK_BYTES = 1 << 22
HASHES_AT_ONCE = 1 << 21
WINDOW_CHUNKS = 1 << 15
PHRASES_AT_ONCE = 1 << 18
MEMORY_WORDS = 1 << 19
SEGMENT_CHUNKS = 1 << 16
MIN_SEGMENTS = 64
TABLE_BITS = 1 << 27
BITS_PER_CHUNK = 64

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + SEPARATORS, b"abcdefghijklmnopqrstuvwxyz " + b"\n" * len(SEPARATORS))
ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, order kept."""
    x = (a ^ (a >> np.uint64(29))) * ODD + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words(dict):
    """Numbers of words, given in the order met, and their hashes; 0 is the line end."""

    def __init__(self):
        super().__init__({b"\n": 0})
        self.list = [b"\n"]
        self.hashes = np.zeros(1 << 12, np.uint64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.list)
        self.list.append(word)
        if n == len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(n, np.uint64)])
        self.hashes[n] = xxhash.xxh64_intdigest(word, SEED)
        return n

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _blocks(texts: list[str | None]) -> Iterator[list[bytes]]:
    """The words of texts, a line end between pieces; a text is cut between pieces only."""
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE)
        at = 0
        while at < len(raw):
            stop = len(raw) if len(raw) - at <= BLOCK_BYTES else raw.rfind(b"\n", at, at + BLOCK_BYTES)
            if stop < at:
                stop = raw.find(b"\n", at + BLOCK_BYTES)
                stop = len(raw) if stop < 0 else stop
            yield list(filter(None, raw[at:stop].replace(b"\n", b" \n ").split(b" ")))
            at = stop + 1


def _cut(words: list[bytes], memory: Words, w: int, every: int) -> tuple[list[bytes], list[bytes]]:
    """Chunks that a trigger of ``w`` words closes, and last chunks of their piece."""
    ids = memory.numbers(words)
    inside = ids != 0
    first = inside & np.concatenate([[True], ~inside[:-1]])
    h, whole = memory.hashes[ids], inside
    for k in range(1, w):
        h = _mix(h[:-1], memory.hashes[ids[k:]])
        whole = whole[:-1] & inside[k:]
    trigger = np.zeros(len(ids), bool)
    trigger[:len(whole)] = whole & (h % np.uint64(every) == 0)
    starts = np.flatnonzero(first | trigger)
    # where each start's piece ends
    ends = np.flatnonzero(~inside)
    ends = np.concatenate([ends, [len(ids)]])
    end = ends[np.searchsorted(ends, starts)]
    following = np.concatenate([starts[1:], [len(ids) + w]])
    closed = following < end
    stop = np.where(closed, following + w, end)
    closed_out, last_out = [], []
    for a, b, c in zip(starts.tolist(), stop.tolist(), closed.tolist()):
        (closed_out if c else last_out).append(b" ".join(words[a:b]))
    return closed_out, last_out


def parse(docs: DataFrame, max_words: int = MAX_WORDS, every: int = CHUNK_WORDS) -> DataFrame:
    """``docs(lang, text)`` -> the dictionary ``(lang, last, chunk, n, owned)``: distinct chunks, how often each occurs, and of how many n-grams
    of each length it holds the first word."""
    w = max_words - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Words()
        held: dict[tuple[str, bool], Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, last), chunks in held.items():
                if chunks:
                    n, more = len(chunks), 1 if last else 1 - w
                    yield pa.record_batch([pa.array([lang] * n, pa.string()), pa.array([last] * n), pa.array(list(chunks), pa.binary()),
                                           pa.array(list(chunks.values()), pa.int64()), pa.array([c.count(b" ") + more for c in chunks], pa.int64())],
                                          ["lang", "last", "chunk", "n", "owned"])
            held.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lang in dict.fromkeys(langs):
                block: list[bytes] = []
                mine = batch.column(1).filter(pa.array([x == lang for x in langs])) if len(batch) > 1 else batch.column(1)
                for words in _blocks_of(mine):
                    block += words
                    block.append(b"\n")
                    if len(block) >= WORDS_AT_ONCE:
                        _count(block, lang, memory, held, w, every)
                        block = []
                _count(block, lang, memory, held, w, every)
                if len(memory) > MEMORY_WORDS:
                    memory = Words()
                if sum(map(len, held.values())) > CHUNKS_AT_ONCE:
                    yield from flush()
        yield from flush()

    narrow = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    cut = map_arrow(narrow, run, "lang string, last boolean, chunk binary, n long, owned long")
    return cut.groupBy("lang", "last", "chunk").agg(F.sum("n").alias("n"), F.first("owned").alias("owned"))


def _blocks_of(texts: pa.Array) -> Iterator[list[bytes]]:
    for k in range(len(texts)):
        yield from _blocks([texts[k].as_py()])


def _count(block: list[bytes], lang: str, memory: Words, held: dict, w: int, every: int) -> None:
    if block:
        for last, chunks in zip((False, True), _cut(block, memory, w, every)):
            held.setdefault((lang, last), Counter()).update(chunks)


class Grams:
    """The n-grams of a batch of chunks: ids, first words owned, weights."""

    def __init__(self, chunks: pa.Table, memory: Words):
        texts = chunks["chunk"].to_pylist()
        self.words = b" ".join(texts).split(b" ")
        self.ids = memory.numbers(self.words)
        sizes = np.fromiter((c.count(b" ") for c in texts), np.int64, len(texts)) + 1
        self.langs, lang = np.unique(chunks["lang"].to_numpy().astype(str), return_inverse=True)
        place = np.arange(len(self.ids)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.left = np.repeat(sizes, sizes) - place
        self.owned = place < np.repeat(chunks["owned"].to_numpy(), sizes)
        self.weight = np.repeat(chunks["n"].to_numpy(), sizes)
        self.lang = np.repeat(lang, sizes)
        seeds = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"), SEED) for x in self.langs], np.uint64)
        self.seed, self.memory = seeds[self.lang], memory

    def hashes(self, max_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each n: the places where an owned n-gram starts, and its hash."""
        single = self.memory.hashes[self.ids]
        h = _mix(self.seed, single)
        for n in range(1, max_words + 1):
            if n > 1:
                h = _mix(h[:-1], single[n - 1:])
            at = np.flatnonzero(self.owned[:len(h)] & (self.left[:len(h)] >= n))
            yield n, at, h[at]


    def distinct(self, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the n-grams at ``places``, the first place of each different one, by its words, and its weight."""
        key = self.lang[places] << 32 | self.ids[places]
        for k in range(1, n):
            key = np.unique(key, return_inverse=True)[1] << 32 | self.ids[places + k]
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        counts = np.zeros(len(first), np.int64)
        np.add.at(counts, inverse, self.weight[places])
        return places[first], counts


def _windows(batches: Iterator[pa.RecordBatch], chunks: int) -> Iterator[pa.Table]:
    """Batches gathered to tables of about ``chunks`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= chunks:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _split(h: np.ndarray, n: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash's segment and the 32 bits kept in it."""
    h = _mix(h, np.full(len(h), n, np.uint64))
    return (h >> np.uint64(32)) % np.uint64(segments), h & np.uint64(0xFFFFFFFF)


def _repeats(chunks: DataFrame, max_words: int, min_count: int, segments: int, bits: int) -> DataFrame:
    """``(n, segment, marked)``: bits of the hashes that reach ``min_count``; a segment has ``bits / segments`` of them for each n."""
    own = bits // segments

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Words()
        held: dict[int, list] = {n: [] for n in range(1, max_words + 1)}

        def flush(n: int) -> pa.RecordBatch:
            keys, counts = _sums(np.concatenate([k for k, _ in held[n]]), np.concatenate([c for _, c in held[n]]), min_count)
            held[n] = []
            segment, low = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype("<u4")
            found, at = np.unique(segment, return_index=True)
            stops = [*at[1:].tolist(), len(keys)]
            return pa.record_batch([pa.array([n] * len(found), pa.int32()), pa.array(found, pa.int32()),
                                    pa.array([low[a:b].tobytes() for a, b in zip(at.tolist(), stops)], pa.binary()),
                                    pa.array([counts[a:b].tobytes() for a, b in zip(at.tolist(), stops)], pa.binary())], ["n", "segment", "low", "counts"])

        for window in _windows(batches, 1):
            grams = Grams(window, memory)
            for n, places, h in grams.hashes(max_words):
                segment, low = _split(h, n, segments)
                held[n].append(_sums(segment << np.uint64(32) | low, np.minimum(grams.weight[places], min_count), min_count))
                if sum(len(k) for k, _ in held[n]) > HASHES_AT_ONCE:
                    yield flush(n)
            if len(memory) > MEMORY_WORDS:
                memory = Words()
        for n in held:
            if held[n]:
                yield flush(n)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low, counts = np.frombuffer(b"".join(row["low"]), "<u4"), np.frombuffer(b"".join(row["counts"]), np.uint8)
                keys, counts = _sums(low.astype(np.uint64), counts.astype(np.int64), min_count)
                marked = np.zeros(own, bool)
                marked[(keys[counts >= min_count] * np.uint64(own)) >> np.uint64(32)] = True
                yield pa.record_batch([pa.array([row["n"]], pa.int32()), pa.array([row["segment"]], pa.int32()),
                                       pa.array([np.packbits(marked).tobytes()], pa.binary())], ["n", "segment", "marked"])

    dealt = map_arrow(chunks, deal, "n int, segment int, low binary, counts binary")
    # a flush has one row for each segment, so a frequent n-gram is one hash a flush
    by_segment = dealt.groupBy("n", "segment").agg(F.collect_list(F.struct("low", "counts")).alias("rows"))
    return map_arrow(by_segment.select("n", "segment", "rows.low", "rows.counts"), mark, "n int, segment int, marked binary")


def _sums(keys: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their counts, cut at ``most`` (at most 255)."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order].astype(np.int64)
    if not len(keys):
        return keys, counts.astype(np.uint8)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.minimum(np.add.reduceat(counts, first), most).astype(np.uint8)


def frequent_phrases(chunks: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, table_bits: int = TABLE_BITS) -> DataFrame:
    """The dictionary -> ``(lang, n, phrase, f)``: all phrases of 1 to ``max_words`` words found ``min_count`` times, with exact counts."""
    spark = chunks.sparkSession
    most = min(min_count, 255)
    n_chunks = chunks.count()
    segments = max(MIN_SEGMENTS, 1 << (n_chunks // SEGMENT_CHUNKS).bit_length())
    bits = max(min(table_bits, 1 << (BITS_PER_CHUNK * n_chunks).bit_length()), 8 * segments)
    own = bits // segments
    tables = {n: np.zeros((segments, own // 8), np.uint8) for n in range(1, max_words + 1)}
    # table_bits of each n in all, whatever the input
    for row in materialize(_repeats(chunks, max_words, most, segments, bits), "phrase-repeats").toLocalIterator():
        tables[row["n"]][row["segment"]] = np.frombuffer(row["marked"], np.uint8)
    shared = spark.sparkContext.broadcast(tables)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        memory = Words()
        held: dict[tuple[str, int], dict[bytes, int]] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, n), counts in held.items():
                dealt: dict[int, list[bytes]] = {}
                for phrase in counts:
                    dealt.setdefault(xxhash.xxh32_intdigest(phrase) % segments, []).append(phrase)
                k = len(dealt)
                yield pa.record_batch([pa.array([lang] * k, pa.string()), pa.array([n] * k, pa.int32()), pa.array(list(dealt), pa.int32()),
                                       pa.array([b"\n".join(p) for p in dealt.values()], pa.binary()),
                                       pa.array([np.array([counts[x] for x in p], "<i8").tobytes() for p in dealt.values()], pa.binary())],
                                      ["lang", "n", "segment", "phrases", "counts"])
            held.clear()

        for window in _windows(batches, WINDOW_CHUNKS):
            grams = Grams(window, memory)
            words = grams.words
            for n, places, h in grams.hashes(max_words):
                segment, low = _split(h, n, segments)
                bit = (low * np.uint64(own)) >> np.uint64(32)
                hit = tables[n][segment, bit >> np.uint64(3)] >> (np.uint8(7) - (bit & np.uint64(7)).astype(np.uint8)) & 1
                places, counts = grams.distinct(places[hit.astype(bool)], n)
                mine = [held.setdefault((lang, n), {}) for lang in grams.langs.tolist()]
                for i, lang, f in zip(places.tolist(), grams.lang[places].tolist(), counts.tolist()):
                    phrase, sums = words[i] if n == 1 else b" ".join(words[i:i + n]), mine[lang]
                    sums[phrase] = sums.get(phrase, 0) + f
            if sum(map(len, held.values())) > PHRASES_AT_ONCE:
                yield from flush()
            if len(memory) > MEMORY_WORDS:
                memory = Words()
        yield from flush()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            sums: dict[bytes, int] = {}
            for phrases, counts in zip(row["phrases"], row["counts"]):
                for phrase, f in zip(phrases.split(b"\n"), np.frombuffer(counts, "<i8").tolist()):
                    sums[phrase] = sums.get(phrase, 0) + f
            kept = [p for p, f in sums.items() if f >= min_count]
            yield pa.record_batch([pa.array([row["lang"]] * len(kept), pa.string()), pa.array([row["n"]] * len(kept), pa.int32()),
                                   pa.array(kept, pa.binary()), pa.array([sums[p] for p in kept], pa.int64())], ["lang", "n", "phrase", "f"])

    dealt = map_arrow(chunks, count, "lang string, n int, segment int, phrases binary, counts binary")
    # as above, a phrase is told once a flush
    grouped = dealt.groupBy("lang", "n", "segment").agg(F.collect_list(F.struct("phrases", "counts")).alias("rows"))
    counted = map_arrow(grouped.select("lang", "n", "rows.phrases", "rows.counts"), total, "lang string, n int, phrase binary, f long")
    return counted.withColumn("phrase", F.col("phrase").cast("string"))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, cover_pct: int = COVER_PCT,
                 top: int = TOP, every: int = CHUNK_WORDS, table_bits: int = TABLE_BITS) -> DataFrame:
    """``docs(lang, text, ...)`` -> ``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and into words at blanks and tabs.

    * a phrase has 2 to ``max_words`` words of one piece and ``a >= min_count`` occurrences; its score is the lowest
      ``floor(10^6 a a / (l r))`` over the cuts into a first part found ``l`` and a rest found ``r`` times (ties: shorter first part);
    * it goes if a longer phrase that qualifies holds its words and ``100 f >= cover_pct * a`` for that phrase's ``f``;
    * ties of score are ordered by ``a`` descending, then the phrase's UTF-8 bytes; ``n`` counts the language's words;
    * a NULL language counts as ``und``, a NULL text as empty; repeated rows count as rows; other columns are ignored;
      an empty table gives an empty result.
    """
    chunks = materialize(parse(docs, max_words, every), "phrase-chunks")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("n") * F.col("owned")).alias("total"))
    counts = materialize(frequent_phrases(chunks, max_words, min_count, table_bits), "phrase-counts")
    found = counts.where("n > 1").withColumn("words", F.split("phrase", " "))
    cuts = found.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"), "n", "words").select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("right"))
    part = counts.select(F.col("lang").alias("part_lang"), F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(part, (cuts["lang"] == part["part_lang"]) & (cuts[side] == part["part"])).withColumnRenamed("part_f", name).drop("part_lang", "part", side)
    # 38 digits hold every product; the quotient is at most 10^6
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "l", "r")}
    cuts = cuts.withColumn("top", (wide["a"] * wide["a"] * F.lit(SCALE).cast("decimal(7,0)")).cast("decimal(38,0)"))
    cuts = cuts.withColumn("low", (wide["l"] * wide["r"]).cast("decimal(38,0)")).withColumn("score", F.expr("top div low"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")
    inner = (found.where("n > 2").select("lang", "f", "words", "n", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("k"))
             .select("lang", "f", "words", "k", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("k") + 1)).alias("i"))
             .select("lang", "f", F.array_join(F.slice("words", F.col("i"), F.col("k")), " ").alias("phrase")))
    covered = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(covered, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < cover_pct * F.col("a"), F.lit(True)))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
