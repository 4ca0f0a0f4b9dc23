"""Cross-tokenizer alignment: byte-level BPE (A) against a sentencepiece model (B).

Token ends that both tokenizers have in common cut a text's tokens into
groups; inside a group every A token is linked with each B token that shares
a byte with it.  A table made once gives for each A id the B id of the same
bytes.  A link that follows this table, as every one-to-one group does, is
counted in a vector as long as A's vocabulary; only other links enter the
shuffle that counts id pairs.

Both tokenizers start anew where white space follows other characters, so a
text is cut there and each piece's alignment is remembered.  Pieces not met
before are encoded together and aligned with array operations.

Pass 1 writes per document its distinct links, packed, and per slice of
documents the number of documents that hold each pair.  The counts are summed
by pair.  Pass 2 reads the packed links and looks their counts up, in a
broadcast of the pair table if that is at most ``broadcast_pairs`` long, else
in the counts of the slice's own pairs, which are joined to it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.bpe import byte_characters
from changelake.llm.common import map_arrow, ship_package, slices
from changelake.session import scratch_path

SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
PIECE = re.compile(r"\s+\S*")
WORD = re.compile(r" \S+")
MARKS = frozenset(".,!?;:")
LAST_PLAIN = "ɏ"
BARE = "\n"
RUN_WORDS = 2048
MEMORY_PIECES = 200_000
LONG_PIECE = 64
PIECES_AT_ONCE = 1 << 17
SLICE_DOCS = 4096
SLICE_LINKS = 1 << 21
BROADCAST_PAIRS = 1 << 21

NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
Piece = tuple[int, int, int, int, bytes, bytes]


def byte_tokens(path: str):
    """The byte-level tokenizer of a file and the bytes of each of its ids."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are plain text
    back = {c: b for b, c in enumerate(byte_characters())}
    vocab = tokenizer.get_vocab()
    tokens = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        tokens[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
    return tokenizer, tokens


def piece_tokens(path: str):
    """The sentencepiece model of a file and the bytes of each of its ids (none for control and unknown pieces)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            tokens.append(bytes([int(BYTE_PIECE.fullmatch(piece)[1], 16)]))
        else:
            tokens.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(SPACE_MARK, " ").encode())
    return model, tokens


def same_bytes(a_tokens: list[bytes], b_tokens: list[bytes], is_byte) -> np.ndarray:
    """For each A id the B id of the same bytes, a whole piece before a byte piece; -1 if there is none."""
    found: dict[bytes, int] = {}
    for i, token in enumerate(b_tokens):
        if token and (token not in found or is_byte(found[token])):
            found[token] = i
    return np.array([found.get(t, -1) if t else -1 for t in a_tokens], np.int64)


def overlaps(a_len: np.ndarray, b_len: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token lengths of A and B over the same bytes -> links as positions ``(i, j)``, and for each group the ends
    of its A and B tokens (exclusive positions)."""
    a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
    first = np.searchsorted(b_end, a_end - a_len, "right")
    last = np.searchsorted(b_end, a_end, "left")
    many = last - first + 1
    i = np.repeat(np.arange(len(a_end)), many)
    j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    return i, j, np.searchsorted(a_end, common) + 1, np.searchsorted(b_end, common) + 1


class Aligner:
    """Both tokenizers and the remembered alignments of pieces."""

    def __init__(self, a_path: str, b_path: str, pieces: int = MEMORY_PIECES):
        self.a, self.a_tokens = byte_tokens(a_path)
        self.b, self.b_tokens = piece_tokens(b_path)
        self.a_len = np.array([len(t) for t in self.a_tokens])
        self.b_len = np.array([len(t) for t in self.b_tokens])
        self.n_a, self.n_b = len(self.a_tokens), len(self.b_tokens)
        self.identity = same_bytes(self.a_tokens, self.b_tokens, self.b.is_byte)
        whole = [t.decode() for i, t in enumerate(self.b_tokens) if t and not self.b.is_byte(i)]
        # blanks that some piece of B holds after another character: texts with one are not cut
        self.joiners = {y for t in whole for x, y in zip(t, t[1:]) if y.isspace() and not x.isspace()}
        self.marks = {m for m in MARKS if not any(x.isalpha() and y == m for t in whole for x, y in zip(t, t[1:]))}
        start = self.b.encode(BARE)
        self.cuts = len(start) == 2 and self.b.is_byte(start[1]) and not any(BARE in t for t in whole)
        self.bound = pieces
        self.new: dict[str, Piece | None] = {}
        self.old: dict[str, Piece | None] = {}

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, texts: list[str], a: list[list[int]], b: list[list[int]]) -> list[bool]:
        """Whether the bytes of both token lists are the text's."""
        return [b"".join(map(self.a_tokens.__getitem__, x)) == (raw := t.encode()) == b"".join(map(self.b_tokens.__getitem__, y))
                for t, x, y in zip(texts, a, b)]

    def _align(self, texts: list[str], a: list[list[int]], b: list[list[int]], parts: list[list[str]]) -> list[Piece]:
        """Alignments of each text's parts, which end where tokens of both end."""
        ia = np.array([i for x in a for i in x], np.int64)
        ib = np.array([i for x in b for i in x], np.int64)
        if not len(ia):
            return [(0, 0, 0, 0, b"", b"")] * sum(map(len, parts))
        i, j, a_stop, b_stop = overlaps(self.a_len[ia], self.b_len[ib])
        codes = (ia[i] << 32 | ib[j]).astype("<u8")
        sa, sb = list(map(str, ia.tolist())), list(map(str, ib.tolist()))
        groups, at, bt = [], 0, 0
        for p, q in zip(a_stop.tolist(), b_stop.tolist()):
            groups.append(f"{sa[at] if p == at + 1 else ','.join(sa[at:p])}|{sb[bt] if q == bt + 1 else ','.join(sb[bt:q])}")
            at, bt = p, q
        part_end = np.cumsum([len(p.encode()) for each in parts for p in each])
        a_at = np.searchsorted(np.cumsum(self.a_len[ia]), part_end, "right")
        b_at = np.searchsorted(np.cumsum(self.b_len[ib]), part_end, "right")
        g_at = np.searchsorted(a_stop, a_at, "right").tolist()
        l_at = np.searchsorted(i, a_at, "left").tolist()
        out, last = [], (0, 0, 0, 0)
        for now in zip(a_at.tolist(), b_at.tolist(), g_at, l_at):
            out.append((*(x - y for x, y in zip(now, last)), ";".join(groups[last[2]:now[2]]).encode(), codes[last[3]:now[3]].tobytes()))
            last = now
        return out

    def _encode(self, pieces: list[str]) -> dict[str, Piece | None]:
        """Alignments of pieces; None for a piece whose bytes a tokenizer does not keep."""
        known: dict[str, Piece | None] = {}
        words = [p for p in pieces if WORD.fullmatch(p)]
        runs = [words[i:i + RUN_WORDS] for i in range(0, len(words), RUN_WORDS)]
        texts = ["".join(run) for run in runs]
        if texts:
            # the model puts a blank before its text
            a, b = self._ids_a(texts), self.b.encode([t[1:] for t in texts], num_threads=1)
            whole = self._joined(texts, a, b)
            good = [k for k, fits in enumerate(whole) if fits]
            known.update(zip((p for k in good for p in runs[k]),
                             self._align([texts[k] for k in good], [a[k] for k in good], [b[k] for k in good], [runs[k] for k in good])))
        rest = [p for p in pieces if p not in known]
        if rest:
            a = self._ids_a(rest)
            b = [ids[2:] for ids in self.b.encode([BARE + p for p in rest], num_threads=1)]
            fits = self._joined(rest, a, b)
            known.update((p, None) for p, fit in zip(rest, fits) if not fit)
            good = [k for k, fit in enumerate(fits) if fit]
            known.update(zip((rest[k] for k in good), self._align([rest[k] for k in good], [a[k] for k in good],
                                                                  [b[k] for k in good], [[rest[k]] for k in good])))
        return known

    def _marked(self, piece: str) -> bool:
        """A mark after a letter is a token of its own in both."""
        return piece[-1] in self.marks and piece[-2:-1].isalpha() and piece[-2] <= LAST_PLAIN

    def _learn(self, missing: set[str]) -> dict[str, Piece | None]:
        known = {k: self.old[k] for k in missing if k in self.old}
        unknown = missing.difference(known)
        marked = [k for k in unknown if self._marked(k)]
        parts = {part for k in marked for part in (k[:-1], k[-1])}.difference(known)
        held = {k: self.new[k] for k in parts if k in self.new}
        known.update(self._encode([*unknown.difference(marked).union(parts.difference(held))]))
        for k in marked:
            x, y = (held[part] if part in held else known[part] for part in (k[:-1], k[-1]))
            known[k] = None if x is None or y is None else (*(p + q for p, q in zip(x[:4], y[:4])), x[4] + b";" + y[4], x[5] + y[5])
        kept = {k: v for k, v in known.items() if len(k) <= LONG_PIECE}
        if len(self.new) + len(kept) > self.bound:
            self.old, self.new = self.new, {}
        self.new.update(kept)
        return known

    def _whole(self, text: str) -> Piece | None:
        a, b = self._ids_a([" " + text]), [self.b.encode(text)]
        if not self._joined([" " + text], a, b)[0]:
            return None
        return self._align([" " + text], a, b, [[" " + text]])[0]

    def texts(self, texts: list[str]) -> list[Piece | None]:
        """The alignment of each text; None where it has no tokens."""
        out: list[Piece | None] = [None] * len(texts)
        block: list[tuple[int, list[str]]] = []
        held = 0
        for k, text in enumerate(texts):
            if not text or SPACE_MARK in text:
                continue
            if not self.cuts or any(c in text for c in self.joiners):
                out[k] = self._whole(text)
                continue
            pieces = PIECE.findall(" " + text)
            for at in range(0, len(pieces), PIECES_AT_ONCE):
                part = pieces[at:at + PIECES_AT_ONCE]
                if block and held + len(part) > PIECES_AT_ONCE:
                    self._block(block, out)
                    block, held = [], 0
                block.append((k, part))
                held += len(part)
        self._block(block, out)
        return out

    def _block(self, block: list[tuple[int, list[str]]], out: list[Piece | None]) -> None:
        found = [list(map(self.new.get, pieces)) for _, pieces in block]
        learnt = self._learn({p for (_, pieces), got in zip(block, found) for p, x in zip(pieces, got) if x is None})
        for (k, pieces), got in zip(block, found):
            got = [learnt[p] if x is None else x for p, x in zip(pieces, got)]
            if None in got or out[k] is False:
                out[k] = False  # a later block of the text must not bring it back
                continue
            parts = [out[k], *got] if out[k] else got
            cols = list(zip(*parts))
            out[k] = (*map(sum, cols[:4]), b";".join(cols[4]), b"".join(cols[5]))


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of two files, kept by a worker for its later tasks."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, slice long, "
           "same binary, same_times binary, pairs binary, times binary, codes array<long>, docs array<long>")
COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _distinct(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(codes), return_counts=True) if codes else (np.empty(0, np.int64),) * 2


def align(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> a row per document with its packed links, and per slice of documents
    rows with ``codes`` and the number of ``docs`` that hold each; an identity link of A id ``a`` has the code -1 - a,
    another pair ``a * (B's size) + b``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = _aligner(a_path, b_path)
        identity, size_b = aligner.identity, aligner.n_b
        vector = np.zeros(aligner.n_a, np.int64)
        part, seq, n_docs, n_links = TaskContext.get().partitionId(), 0, 0, 0
        held: list[np.ndarray] = []
        schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in NUMBERS], ("groups_sha256", pa.string()), ("groups", pa.string()),
                            ("slice", pa.int64()), ("same", pa.binary()), ("same_times", pa.binary()), ("pairs", pa.binary()),
                            ("times", pa.binary()), ("codes", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])

        def counts(codes: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
            row = dict.fromkeys(schema.names) | {"slice": part << 32 | seq, "codes": codes, "docs": docs}
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in slices(batches):
            rows = []
            for doc_id, found in zip(batch.column(0).to_pylist(), aligner.texts(batch.column(1).to_pylist())):
                row = dict.fromkeys(schema.names) | {"doc_id": doc_id, "slice": part << 32 | seq}
                links = np.frombuffer(found[5] if found else b"", "<u8").astype(np.int64)
                row |= dict(zip(NUMBERS, found[:4] if found else (0, 0, 0, 0)))
                row["groups_sha256"] = hashlib.sha256(found[4]).hexdigest() if found else ""
                if with_groups:
                    row["groups"] = found[4].decode() if found else ""
                links, times = np.unique(links, return_counts=True)
                a, b = links >> 32, links & 0xFFFFFFFF
                fast = identity[a] == b
                same, codes = a[fast], a[~fast] * size_b + b[~fast]
                vector[same] += 1
                held.append(codes)
                n_docs += 1
                n_links += len(codes)
                # a rising sequence, kept as its steps
                steps = np.diff(codes, prepend=0)
                row |= {"same": same.astype("<u4").tobytes(), "same_times": times[fast].astype("<u4").tobytes(),
                        "pairs": steps.astype("<u4" if len(identity) * size_b <= 1 << 32 else "<u8").tobytes(), "times": times[~fast].astype("<u4").tobytes()}
                rows.append(row)
                if n_docs >= SLICE_DOCS or n_links >= SLICE_LINKS:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    yield counts(*_distinct(held))
                    rows, held, seq, n_docs, n_links = [], [], seq + 1, 0, 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        if n_links:
            yield counts(*_distinct(held))
        used = np.flatnonzero(vector)
        if len(used):
            seq += 1
            yield counts(-1 - used, vector[used])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(narrow, run, ALIGNED)


def _tell(batch: pa.RecordBatch, lookup, vector: np.ndarray, best: np.ndarray, size_b: int) -> pa.RecordBatch:
    """Documents with packed links -> the result's rows."""
    wide = np.dtype("<u4" if len(vector) * size_b <= 1 << 32 else "<u8")
    n_best, count_sum = [], []
    for row in range(batch.num_rows):
        same, same_times, pairs, times = (np.frombuffer(batch.column(c)[row].as_py(), kind)
                                          for c, kind in (("same", "<u4"), ("same_times", "<u4"), ("pairs", wide), ("times", "<u4")))
        codes = np.cumsum(pairs.astype(np.int64))
        n, m = lookup(codes), vector[same]
        times, same_times = times.astype(np.int64), same_times.astype(np.int64)
        n_best.append(int(times[n == best[codes // size_b]].sum() + same_times[m == best[same]].sum()))
        count_sum.append(int((n * times).sum() + (m * same_times).sum()))
    columns = [batch.column(c) for c in ("doc_id", *NUMBERS)] + [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())]
    return pa.record_batch(columns + [batch.column("groups_sha256"), batch.column("groups")],
                           ["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256", "groups"])


def _found(keys: np.ndarray, counts: np.ndarray):
    def lookup(codes: np.ndarray) -> np.ndarray:
        return counts[np.searchsorted(keys, codes)] if len(codes) else np.empty(0, np.int64)
    return lookup


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False,
                     broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Align A (a ``tokenizers`` byte-level file) and B (a ``sentencepiece`` model) on ``docs(doc_id, text, ...)``.

    Returns per row ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` and, with
    ``with_groups``, ``groups`` (``a1,a2|b1;a3|b2,b3``).  A encodes a blank and the text, B the text.

    * a text that is NULL or empty, or whose bytes a tokenizer does not keep, has no tokens: zeros and ``''``;
    * a pair's count is the number of rows that hold it linked: repeated rows count as rows;
    * one row per input row, also for a NULL or repeated doc_id; other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-links")
    found = align(docs, a_path, b_path, with_groups)
    found.write.option("compression", "zstd").parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    size_a, size_b = len(byte_tokens(a_path)[1]), len(piece_tokens(b_path)[1])
    told = found.where("codes is not null").select("slice", F.explode(F.arrays_zip("codes", "docs")).alias("c")).select("slice", "c.codes", "c.docs")
    path = scratch_path(spark, "token-pairs")
    told.groupBy(F.col("codes").alias("code")).agg(F.sum("docs").alias("n")).write.parquet(path)
    counted = spark.read.schema("code long, n long").parquet(path)
    a_of = F.when(F.col("code") < 0, -1 - F.col("code")).otherwise(F.expr(f"code div {size_b}"))
    vector, best = np.zeros(size_a, np.int64), np.zeros(size_a, np.int64)
    # at most one row for each A id
    for row in counted.groupBy(a_of.alias("a")).agg(F.max("n").alias("n"), F.max(F.when(F.col("code") < 0, F.col("n"))).alias("same")).toLocalIterator():
        vector[row["a"]], best[row["a"]] = row["same"] or 0, row["n"]
    pairs = counted.where("code >= 0")
    rows = found.where("codes is null").select("doc_id", *NUMBERS, "groups_sha256", "groups", "slice", "same", "same_times", "pairs", "times")
    if pairs.count() <= broadcast_pairs:
        table = pairs.sort("code").toArrow()
        shared = spark.sparkContext.broadcast((table["code"].to_numpy(), table["n"].to_numpy(), vector, best))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, counts, vector, best = shared.value
            for batch in slices(batches):
                yield _tell(batch, _found(keys, counts), vector, best, size_b)

        out = map_arrow(rows, run, COUNTED)
    else:
        shared = spark.sparkContext.broadcast((vector, best))
        ship_package(spark)

        def meet(left: pa.Table, right: pa.Table) -> pa.Table:
            vector, best = shared.value
            right = right.sort_by("code")
            lookup = _found(right["code"].to_numpy(), right["n"].to_numpy())
            batches = [_tell(b, lookup, vector, best, size_b) for b in slices(iter(left.to_batches()))]
            return pa.Table.from_batches(batches) if batches else _nothing()

        asked = told.where("codes >= 0").select("slice", F.col("codes").alias("code")).join(pairs, "code").select(
            F.col("slice").alias("part"), "code", "n")
        out = rows.groupBy("slice").cogroup(asked.groupBy("part")).applyInArrow(meet, COUNTED)
    return out if with_groups else out.drop("groups")


def _nothing() -> pa.Table:
    kinds = [("doc_id", pa.int64()), *[(c, pa.int64()) for c in (*NUMBERS, "n_best", "count_sum")], ("groups_sha256", pa.string()), ("groups", pa.string())]
    return pa.schema(kinds).empty_table()
