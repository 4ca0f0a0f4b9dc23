"""Byte-level BPE through a sentencepiece model written from the vocabulary.

Every byte stands for one printable character, so each token of a rank file
is a piece; its score is minus its rank, hence the best-scored merge is the
lowest-ranked one.  The model is serialised here field by field (identity
normaliser, no dummy prefix, nothing trained).  A text is cut by the public
pattern, each pre-token encoded by the model, and ids decoded by the inverse
of the byte mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changelake.llm.common import map_arrow, slices
from changelake.llm.pretokens import Memory

UNKNOWN_PIECE = "<unk>"
# Field numbers and enum values of the public sentencepiece model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE, VOCAB_SIZE, BPE_MODEL = 3, 4, 2
NORMALIZER_NAME, DUMMY_PREFIX, EXTRA_WHITESPACE, ESCAPE_WHITESPACE = 1, 3, 4, 5


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on, in byte order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank."""
    with open(path, "rb") as lines:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    return [ranked[i] for i in range(len(ranked))]


def _varint(n: int) -> bytes:
    out = b""
    while n > 0x7F:
        out += bytes([n & 0x7F | 0x80])
        n >>= 7
    return out + bytes([n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _float(field: int, value: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", value)


def piece_model(tokens: list[bytes]) -> bytes:
    """The serialised model: piece i is token i, the unknown piece comes last."""
    chars = byte_characters()
    pieces = [("".join(chars[b] for b in t), -float(i), NORMAL) for i, t in enumerate(tokens)]
    pieces.append((UNKNOWN_PIECE, 0.0, UNKNOWN))
    body = b"".join(_bytes(PIECES, _bytes(PIECE_TEXT, p.encode()) + _float(PIECE_SCORE, s) + _number(PIECE_TYPE, k)) for p, s, k in pieces)
    trainer = _number(MODEL_TYPE, BPE_MODEL) + _number(VOCAB_SIZE, len(pieces))
    normalizer = (_bytes(NORMALIZER_NAME, b"identity") + _number(DUMMY_PREFIX, 0)
                  + _number(EXTRA_WHITESPACE, 0) + _number(ESCAPE_WHITESPACE, 0))
    return body + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, normalizer)


class PieceCodec:
    """Encoder and decoder over a serialised model."""

    def __init__(self, model: bytes, pattern: str):
        import regex
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.chars = str.maketrans({chr(b): c for b, c in enumerate(byte_characters())})
        back = {c: b for b, c in enumerate(byte_characters())}
        size = self.model.get_piece_size() - 1
        self.tokens = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(size)]
        self.whole = {self.model.id_to_piece(i): i for i in range(size)}
        self.find = regex.compile(pattern).findall
        self.memory = Memory(self._encode)

    def _encode(self, pieces: list[str]) -> list[bytes]:
        cut = [[t.encode().decode("latin-1").translate(self.chars) for t in self.find(p)] for p in pieces]
        unknown = list({t for ts in cut for t in ts if t not in self.whole})
        ids = dict(zip(unknown, self.model.encode(unknown, out_type=int, num_threads=1))) if unknown else {}
        return [np.array([i for t in ts for i in ((self.whole[t],) if t in self.whole else ids[t])], "<u4").tobytes() for ts in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian u32."""
        return self.memory.codes(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[bytes, PieceCodec] = {}


def _codec(model: bytes, pattern: str) -> PieceCodec:
    """The codec of a model, kept by a worker for its later tasks."""
    key = hashlib.sha256(model + pattern.encode()).digest()
    if key not in _codecs:
        _codecs[key] = PieceCodec(model, pattern)
    return _codecs[key]


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = False,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, n_tokens, ids_sha256, decoded_sha256)``,
    with ``with_ids`` also ``ids array<int>`` and ``decoded binary``; ``keep`` names long columns that are returned too.

    NULL counts as an empty text (no ids); one row per input row; other
    columns are ignored; an empty table gives an empty result.  The rank file
    is read by the driver and travels with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(piece_model(read_ranks(ranks_path)))  # the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in slices(batches):
            n, ids_sha, back_sha, ids, back = [], [], [], [], []
            for code in codec.encode([t or "" for t in batch.column(1).to_pylist()]):
                decoded = codec.decode(code)
                n.append(len(code) // 4)
                ids_sha.append(hashlib.sha256(code).hexdigest())
                back_sha.append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    ids.append(np.frombuffer(code, "<u4").astype(np.int32))
                    back.append(decoded)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string())]
            if with_ids:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.binary())]
            yield pa.record_batch(columns + [batch.column(2 + i) for i in range(len(keep))], schema.names)

    schema = T.StructType().add("doc_id", "long").add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "binary")
    for name in keep:
        schema = schema.add(name, "long")
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                                 *[F.col(c).cast("long") for c in keep]), run, schema)
