"""Token-id files: one concatenated id array a file, with Elias-Fano coded document ends.

File layout, little-endian:

    8 bytes   magic
    6 x u64   documents, ids, bytes per id, low bits, bytes of the high part, leading NULL document ids
    i64[]     document ids, ascending (0 stands for a leading NULL)
    bytes     low bits of the document ends, packed
    bytes     high bits in unary: the i-th one stands at (end >> low bits) + i
    u64[]     place of every SAMPLE-th one, for select
    ids       u16 or u32

An end is the number of ids of the file up to and including that document, so
document i covers ids select(i-1) .. select(i); this takes about
2 + log2(ids / documents) bits a document.

Files are written under the shared folder by the tasks that encode; a task
attempt uses names of its own and only the names that its committed output
lists are read, so a repeated attempt leaves nothing behind in the result.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelake.llm.common import map_arrow, materialize, slices
from changelake.llm.pretokens import Memory
from changelake.session import scratch_path

MAGIC = b"CLTOKEN1"
HEAD = struct.Struct("<8s6Q")
SAMPLE = 256
SHARD_IDS = 1 << 22
END_ID = 0
# A blank and a word; the pieces of this form are encoded together.
WORD = re.compile(r" \S+")
WORDS_AT_ONCE = 2048
BLANK = "\u0120"  # the character that stands for a blank in a byte-level vocabulary


class EliasFano:
    """A rising sequence of numbers up to ``universe``, with select."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        lows = values & np.uint64((1 << low_bits) - 1)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((lows[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        bits = np.zeros((universe >> low_bits) + n + 1, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u8"))

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        first = at // 8
        window = int.from_bytes(self.low[first:(at + self.low_bits + 7) // 8], "little")
        return window >> (at - 8 * first) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: from the nearest sampled one, byte by byte."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        byte, bit = divmod(place, 8)
        word = self.high[byte] >> bit << bit
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        place = 8 * byte + (word & -word).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        """All values."""
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        highs = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return highs
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), count=self.n * self.low_bits, bitorder="little")
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return highs | bits.reshape(self.n, self.low_bits).astype(np.uint64) @ weights


def pack(doc_ids: list[int | None], lengths: list[int], ids: bytes, width: int) -> bytes:
    """A file of documents in ascending id order (NULLs first); ``ids``: u32 of all of them."""
    values = np.frombuffer(ids, "<u4")
    if width == 2 and len(values) and values.max() > 0xFFFF:
        raise ValueError(f"id {values.max()} does not fit 2 bytes: use id_width=4")
    values = values.astype("<u2" if width == 2 else "<u4")
    ends = np.cumsum(np.array(lengths, np.int64))
    ef = EliasFano.of(ends, len(values))
    nulls = sum(d is None for d in doc_ids)
    head = HEAD.pack(MAGIC, len(doc_ids), len(values), width, ef.low_bits, len(ef.high), nulls)
    return b"".join([head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), ef.low, ef.high, ef.samples.tobytes(), values.tobytes()])


def unpack(data: bytes) -> tuple[list[int | None], EliasFano, np.ndarray]:
    """Document ids, their ends and the ids of a file."""
    magic, n, n_ids, width, low_bits, high_len, nulls = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size
    doc_ids: list[int | None] = np.frombuffer(data, "<i8", n, at).tolist()
    doc_ids[:nulls] = [None] * nulls
    at += 8 * n
    low = data[at:at + (n * low_bits + 7) // 8]
    at += len(low)
    high = data[at:at + high_len]
    at += high_len
    samples = np.frombuffer(data, "<u8", -(-n // SAMPLE), at)
    at += 8 * len(samples)
    return doc_ids, EliasFano(n, low_bits, low, high, samples), np.frombuffer(data, f"<u{width}", n_ids, at)


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the file system that Spark takes it to be on, so that tasks write where Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)  # noqa: SLF001
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()  # noqa: SLF001


def _filesystem(folder: str) -> tuple[pa.fs.FileSystem, str]:
    if folder.startswith("file:"):
        return pa.fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    if "://" in folder:
        return pa.fs.FileSystem.from_uri(folder)
    return pa.fs.LocalFileSystem(), folder


_memories: dict[str, Memory] = {}


def _tokenizer_memory(path: str) -> Memory:
    """The encoder of a tokenizer file, kept by a worker for its later tasks."""
    if path not in _memories:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text

        opens = np.zeros(max(tokenizer.get_vocab().values(), default=0) + 1, bool)
        opens[[i for token, i in tokenizer.get_vocab().items() if token.startswith(BLANK)]] = True

        def batch(texts: list[str]) -> list[array]:
            return [array("I", e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        def encode(pieces: list[str]) -> list[bytes]:
            # a word's only blank is its first byte, so in a run of words each one begins at a token that opens with a blank
            words = [p for p in pieces if WORD.fullmatch(p)]
            runs = ["".join(words[i:i + WORDS_AT_ONCE]) for i in range(0, len(words), WORDS_AT_ONCE)]
            codes: list[bytes] = []
            for ids in batch(runs):
                at = np.flatnonzero(opens[np.frombuffer(ids, np.uint32)]) * 4
                raw = ids.tobytes()
                stops = [*at[1:].tolist(), len(raw)]
                codes.extend(raw[a:b] for a, b in zip(at.tolist(), stops))
            known = dict(zip(words, codes, strict=True))
            rest = [p for p in pieces if p not in known]
            known.update(zip(rest, (ids.tobytes() for ids in batch(rest))))
            return [known[p] for p in pieces]

        _memories[path] = Memory(encode)
    return _memories[path]


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = END_ID,
                      id_width: int = 2, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``docs(doc_id, text)`` in ascending doc_id order into files under
    ``folder``; returns their list ``(file, part, seq, n_docs, n_ids, start)``,
    start being the number of ids in all files before."""
    folder = _qualified(docs.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        fs, root = _filesystem(folder)
        memory = _tokenizer_memory(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        part, attempt, seq = TaskContext.get().partitionId(), uuid.uuid4().hex[:8], 0
        doc_ids, lengths, codes, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"part-{part:06d}-{seq:05d}-{attempt}.tok"
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/{name}") as out:
                out.write(pack(doc_ids, lengths, b"".join(codes), id_width))
            return pa.record_batch([[name], [part], [seq], [len(doc_ids)], [held]], ["file", "part", "seq", "n_docs", "n_ids"])

        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, code in zip(batch.column(0).to_pylist(), memory.codes(texts)):
                code += end
                doc_ids.append(doc_id)
                lengths.append(len(code) // 4)
                codes.append(code)
                held += lengths[-1]
                if held >= shard_ids:
                    yield flush()
                    doc_ids, lengths, codes, held, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield flush()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = materialize(map_arrow(ordered, run, "file string, part long, seq long, n_docs long, n_ids long"), "token-files")
    # one row per file of shard_ids ids
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Per document of the listed files: ``(doc_id, start, n_tokens, ids_crc32)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            doc_ids, ends, ids = unpack(batch.column(1)[0].as_py())
            stops = np.fromiter(map(ends.select, range(ends.n)), np.int64, ends.n)
            starts = np.concatenate([[0], stops[:-1]])
            crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), stops.tolist())]
            yield pa.record_batch([pa.array([batch.column(0)[0].as_py()] * len(doc_ids)), pa.array(doc_ids, pa.int64()), pa.array(starts),
                                   pa.array(stops - starts), pa.array(crcs, pa.int64())],
                                  ["file", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    each = map_arrow(found, run, "file string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return each.join(files.select("file", F.col("start").alias("before")), "file").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_width: int = 2,
                 shard_ids: int = SHARD_IDS, folder: str | None = None) -> DataFrame:
    """Write ``docs(doc_id, text, ...)`` as token files and describe each document from the files.

    * a NULL or empty text is only the end id;
    * order is doc_id, NULL first; rows with one doc_id follow by text;
    * ``id_width`` is 2 where the vocabulary has at most 65,536 ids, else 4;
    * other columns are ignored; an empty table writes no file and gives an empty result.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "token-ids")
    files = write_token_files(docs, tokenizer_path, folder, end_id, id_width, shard_ids)
    if files.isEmpty():
        return files.select(*[F.lit(None).cast("long").alias(c) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])
    return read_token_files(spark, folder, files)
