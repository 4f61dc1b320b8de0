"""Operator 10: token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded by the tokenizer itself; those
that are one pre-token and come out as one token are proved. Counting looks
each pre-token of a text up in that set first (one token); only the others go
through the merges, and their counts are remembered.
"""

from __future__ import annotations

import json
import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recsift.llm.pieces import ODD, PIECE, Memo, plain_split, read_bytes
from recsift.llm.words import slices

TOKEN_LIMIT = 512


def _byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the
    others, in order, for the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def proved_tokens(tokenizer: str) -> frozenset[str]:
    """Vocabulary strings that the tokenizer encodes alone as one token and
    that are one piece."""
    own = Tokenizer.from_str(tokenizer)
    back = {c: b for b, c in _byte_chars().items()}
    special = {t["content"] for t in json.loads(tokenizer)["added_tokens"]}
    texts = []
    for token in own.get_vocab(with_added_tokens=False):
        try:
            text = bytes(back[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if PIECE.fullmatch(text) and not ODD.search(text) and text not in special:
            texts.append(text)
    coded = own.encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, coded, strict=True) if len(e.ids) == 1)


def _count(tokenizer: str, proved: frozenset[str]):
    out = pa.schema([("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        own = Tokenizer.from_str(tokenizer)
        own.no_truncation()
        own.no_padding()
        special = [t["content"] for t in json.loads(tokenizer)["added_tokens"]]

        def merged(texts: list[str]) -> list[int]:
            return [len(e.ids) for e in own.encode_batch_fast(texts, add_special_tokens=False)]

        def count(pieces: list[str]) -> list[int]:
            rest = [p for p in pieces if p not in proved]
            counts = dict(zip(rest, merged(rest), strict=True))
            return [counts.get(p, 1) for p in pieces]

        memo = Memo(count, lambda piece: plain_split(piece) or [piece], sum)
        for batch in (part for batch in batches for part in slices(batch, batch.num_columns - 1)):
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            odd = [bool(ODD.search(t)) or any(s in t for s in special) for t in texts]
            plain = iter(memo.values([t for t, o in zip(texts, odd, strict=True) if not o]))
            tokens = [merged([t])[0] if o else next(plain) for t, o in zip(texts, odd, strict=True)]
            sizes = [len(t.encode()) for t in texts]
            got = pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], schema=out)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *got.columns],
                                             names=[*batch.schema.names[:-1], *out.names])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id_col, n_bytes, n_tokens, over_limit)`` for every row of ``docs``:
    UTF-8 bytes and tokens of the whole text as the tokenizer file's library
    counts them, without begin, end or padding; special strings inside a text
    are handled as by default.

    The file must be of a byte-level tokenizer without a normaliser. Null or
    empty text: no bytes, no tokens. Rows are counted one by one, so null and
    repeated ids need no rule; other columns are not read. An empty table
    gives an empty result.
    """
    tokenizer = read_bytes(tokenizer_path).decode()
    spec = json.loads(tokenizer)
    if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("token_counts needs a byte-level tokenizer without normaliser and prefix space")
    kind = docs.schema[id_col].dataType.simpleString()
    counted = docs.select(id_col, text_col).mapInArrow(
        _count(tokenizer, proved_tokens(tokenizer)), f"`{id_col}` {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
