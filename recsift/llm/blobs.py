"""Hashes of many rows packed into one binary per bucket, for the shuffle.

A task writes, for each chunk of text and each bucket, one row: the hashes
that fall into the bucket, grouped by the document they belong to. Spark
shuffles these rows by bucket; a bucket holds about ``BUCKET_BYTES`` of text's
hashes whatever the input's size, so the number of buckets grows with it.
What a bucket finds goes back packed alike, by parts of the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.words import U64, mix

# Text whose window hashes go to one bucket: under 2 million 8-byte hashes.
BUCKET_BYTES = 8 << 20


def n_buckets(rows: DataFrame, text_col: str = "text") -> int:
    """Buckets for the hashes of all words of ``rows`` (one aggregate row)."""
    size = rows.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return max(8, -(-int(size) // BUCKET_BYTES))


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Bucket by the hash's high 32 bits (multiply and shift)."""
    return ((h >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def narrow(x: np.ndarray) -> np.ndarray:
    """Non-negative integers in the narrowest of 1, 2, 4 and 8 bytes."""
    top = int(x.max()) if len(x) else 0
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else \
        np.uint32 if top < 1 << 32 else np.uint64
    return x.astype(kind)


def pack(x: np.ndarray) -> bytes:
    """Narrowed integers after a byte that tells their width."""
    x = narrow(x)
    return bytes([x.itemsize]) + x.tobytes()


def unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=f"<u{b[0]}", offset=1).astype(np.int64)


def by_bucket(bucket: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(bucket, positions)`` for every bucket that has any, positions ascending."""
    kind = np.uint16 if n <= 1 << 16 else np.uint32
    order = np.argsort(bucket.astype(kind), kind="stable")  # radix sort for 16 bits
    counts = np.bincount(bucket, minlength=1)
    used = np.flatnonzero(counts)
    ends = np.cumsum(counts[used])
    for b, lo, hi in zip(used.tolist(), (ends - counts[used]).tolist(), ends.tolist(), strict=True):
        yield b, order[lo:hi]


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal neighbours."""
    if not len(values):
        empty = np.empty(0, dtype=np.int64)
        return empty, empty
    start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return start, np.diff(np.r_[start, len(values)])


def names_of(r: dict, counts: str = "counts") -> tuple[np.ndarray, np.ndarray]:
    """``_k`` and ``_sub`` of every hash of a packed row."""
    k = np.frombuffer(r["docs"], dtype=np.int64)
    s = np.frombuffer(r["subs"], dtype=np.int64) if r["subs"] else np.zeros(len(k), dtype=np.int64)
    n = unpack(r[counts])
    return np.repeat(k, n), np.repeat(s, n)


def pack_names(keys: np.ndarray, subs: np.ndarray, counts: np.ndarray) -> dict:
    return {"docs": keys.tobytes(), "subs": subs.tobytes() if subs.any() else b"", "counts": pack(counts)}


REPLY = "part int, docs binary, subs binary, counts binary, hashes binary"
REPLY_ARROW = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("docs", "subs", "counts", "hashes"))])


def part_of(keys: np.ndarray, subs: np.ndarray, n: int) -> np.ndarray:
    """The part, of ``n``, that a document's replies go to."""
    return bucket_of(mix(mix(keys.view(U64)) + subs.view(U64)), n)


def deal(parts: int):
    """mapInArrow function: rows with ``_k`` and ``_sub`` get their ``part`` as first column."""
    def run(batches):
        for batch in batches:
            part = part_of(batch.column("_k").to_numpy(zero_copy_only=False),
                           batch.column("_sub").to_numpy(zero_copy_only=False), parts)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *batch.columns],
                                             names=["part", *batch.schema.names])
    return run


def reply(keys: np.ndarray, subs: np.ndarray, values: np.ndarray, n: int) -> pa.Table:
    """Values to send back to their documents: one row for each part that any go to."""
    order = np.lexsort((values, subs, keys))
    keys, subs, values = keys[order], subs[order], values[order]
    rows = []
    for part, i in by_bucket(part_of(keys, subs, n), n):
        change = (np.diff(keys[i]) != 0) | (np.diff(subs[i]) != 0)
        head = np.flatnonzero(np.r_[True, change])
        rows.append({"part": part, "hashes": values[i].tobytes(),
                     **pack_names(keys[i][head], subs[i][head], np.diff(np.r_[head, len(i)]))})
    return pa.Table.from_pylist(rows, schema=REPLY_ARROW)


def received(table: pa.Table) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(_k, _sub, values ascending)`` of every document in the replies to one part."""
    rows = table.to_pylist()
    if not rows:
        return
    names = [names_of(r) for r in rows]
    keys, subs = (np.concatenate([x[j] for x in names]) for j in (0, 1))
    values = np.concatenate([np.frombuffer(r["hashes"], dtype=np.int64) for r in rows])
    order = np.lexsort((values, subs, keys))
    keys, subs, values = keys[order], subs[order], values[order]
    head = np.flatnonzero(np.r_[True, (np.diff(keys) != 0) | (np.diff(subs) != 0)])
    for a, b in zip(head.tolist(), [*head[1:].tolist(), len(keys)], strict=True):
        yield int(keys[a]), int(subs[a]), values[a:b]
