"""Operator 4: byte-level BPE through a sentencepiece model.

A tiktoken rank file becomes a sentencepiece BPE model, written as its
protobuf message directly: piece ``i`` is the byte string of rank ``i`` with
every byte mapped to a printable character, its score is ``-i``, and the
normaliser is the identity. The model merges the pair of highest score first,
as the rank order asks. A pre-token that is itself in the vocabulary is one
token, as in the original library. Decoding is the inverse mapping.
"""

from __future__ import annotations

import base64
import struct

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from recsift.llm.pieces import ODD, Memo, plain_split, read_bytes
from recsift.llm.token_counts import _byte_chars
from recsift.llm.words import slices


def load_ranks(path: str) -> list[bytes]:
    """Tokens of a tiktoken file by rank (ranks from 0 on, without gaps)."""
    pairs = [line.split() for line in read_bytes(path).splitlines() if line]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return [tokens[i] for i in range(len(tokens))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float) -> bytes:
    """One protobuf field: bytes (length-delimited), int (varint), float (32 bits)."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece model message with these tokens as pieces 0 .. n-1 and
    the unknown piece after them (never used: every byte is a piece)."""
    chars = _byte_chars()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(chars[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, float(-rank)) + _field(3, 1))  # NORMAL
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))  # UNKNOWN
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))  # BPE, size, unk_id
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))  # no begin, end, padding
    normal = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normal))


class Codec:
    """Encoder and decoder of one vocabulary; ids are ranks."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        chars = _byte_chars()
        self.chars = {b: chars[b] for b in range(256)}
        self.pattern = regex.compile(pattern)
        self.memo = Memo(self._tokens, self._split, b"".join)

    def _split(self, piece: str) -> list[str]:
        return plain_split(piece) or self.pattern.findall(piece)

    def _tokens(self, pretokens: list[str]) -> list[bytes]:
        out, rest = [], []
        for t in pretokens:
            raw = t.encode()
            rank = self.rank.get(raw)
            if rank is None:
                rest.append(raw.decode("latin-1").translate(self.chars))
            out.append(rank)
        merged = iter(self.model.encode(rest, num_threads=1) if rest else [])
        return [np.array(next(merged) if r is None else [r], dtype="<u4").tobytes() for r in out]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        odd = [ODD.search(t) is not None for t in texts]
        plain = iter(self.memo.values([t for t, o in zip(texts, odd, strict=True) if not o]))
        return [b"".join(self._tokens(self.pattern.findall(t))) if o else next(plain)
                for t, o in zip(texts, odd, strict=True)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _code(tokens: list[bytes], model: bytes, pattern: str):
    def run(batches):
        codec = Codec(tokens, model, pattern)
        for batch in (part for batch in batches for part in slices(batch, batch.num_columns - 1)):
            ids = codec.encode([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()])
            arrays = [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                      pa.array(map(codec.decode, ids), pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays],
                                             names=[*batch.schema.names[:-1], "n_tokens", "ids", "decoded"])
    return run


def byte_bpe(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``(id_col, n_tokens, ids, decoded)`` for every row of ``docs``: the
    whole text's ids (little-endian unsigned 32-bit integers), each match of
    ``pattern`` encoded by itself, without special tokens, and the bytes they
    decode to.

    Null or empty text: no tokens. Rows are coded one by one, so null and
    repeated ids need no rule; other columns are not read. A very long
    pre-token takes time in proportion to its length (times its logarithm).
    An empty table gives an empty result.
    """
    tokens = load_ranks(ranks_path)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        _code(tokens, serialise_model(tokens), pattern),
        f"`{id_col}` {kind}, n_tokens long, ids binary, decoded binary")
