"""Operator 2: substring dedup by Rabin-Karp window hashes.

Every window of ``n`` consecutive words is hashed and counted: windows go,
packed by document, to the bucket their hash names, and a bucket's task
finds those that more than one document holds. The documents that do not hold
a window's first occurrence (smallest document id, then earliest start) are
told its hash. Each document then marks the windows it was told and those it
has already had itself; they merge into maximal removal intervals.

A window has 64 bits of one hash and its bucket from a second one, so the
width grows with the number of buckets (71 bits at 128 of them).
Skew: a chunk sends each different window once, for its first document, and
only names the others, so a window that a third of all documents hold reaches
its bucket once for each chunk of text, not once for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recsift.llm.blobs import (
    REPLY,
    bucket_of,
    by_bucket,
    deal,
    n_buckets,
    names_of,
    pack,
    pack_names,
    received,
    reply,
    runs,
    unpack,
)
from recsift.llm.rows import id_of, keyed
from recsift.llm.words import U64, WINDOW_BASES, Chunk, chunks, window_hashes

WINDOW = 20
# again: documents of the chunk that hold a sent window too, by its place among the hashes
_SENT = "bucket int, docs binary, subs binary, counts binary, hashes binary, again_counts binary, again binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), *((c, pa.binary()) for c in (
    "docs", "subs", "counts", "hashes", "again_counts", "again"))])


def _windows(chunk: Chunk, keys: np.ndarray, subs: np.ndarray, n: int, buckets: int) -> Iterator[dict]:
    """The chunk's rows for the shuffle: its different windows by bucket."""
    words = chunk.hashes()
    at = chunk.windows_inside(n)
    if not len(at):
        return
    h = window_hashes(words, n)[at]
    bucket = bucket_of(window_hashes(words, n, WINDOW_BASES[1])[at], buckets)
    row = np.searchsorted(chunk.word_off, at, "right") - 1
    # rows in the order in which a window's first one stays
    rank = np.empty(chunk.n_rows, dtype=np.int64)
    rank[np.lexsort((subs, keys))] = np.arange(chunk.n_rows)
    order = np.argsort(rank[row], kind="stable")
    h, bucket, row = h[order], bucket[order], row[order]
    by_hash = np.argsort(h, kind="stable")
    head, length = runs(h[by_hash])
    first = np.empty(len(h), dtype=np.int64)  # the window's first occurrence in the chunk
    first[by_hash] = np.repeat(by_hash[head], length)
    own = np.arange(len(h))
    # a row's later occurrences need no word from others
    twice = np.zeros(len(h), dtype=bool)
    twice[by_hash[1:]] = (h[by_hash][1:] == h[by_hash][:-1]) & (row[by_hash][1:] == row[by_hash][:-1])
    place = np.empty(len(h), dtype=np.int64)
    at_row = np.empty(chunk.n_rows, dtype=np.int64)
    for b, i in by_bucket(bucket, buckets):
        sent, again = i[first[i] == own[i]], i[(first[i] != own[i]) & ~twice[i]]
        docs = row[np.concatenate([sent, again])]
        docs = docs[np.sort(np.unique(docs, return_index=True)[1])]
        at_row[docs] = np.arange(len(docs))
        place[sent] = np.arange(len(sent))
        counts = [np.bincount(at_row[row[x]], minlength=len(docs)) for x in (sent, again)]
        # rows in order of at_row, as the counts are
        sent = sent[np.argsort(at_row[row[sent]], kind="stable")]
        place[sent] = np.arange(len(sent))
        again = again[np.argsort(at_row[row[again]], kind="stable")]
        yield {"bucket": b, "hashes": h[sent].tobytes(), "again_counts": pack(counts[1]),
               "again": pack(place[first[again]]), **pack_names(keys[docs], subs[docs], counts[0])}


def _send(n: int, buckets: int):
    def run(batches):
        for batch in batches:
            keys = batch.column("_k").to_numpy(zero_copy_only=False)
            subs = batch.column("_sub").to_numpy(zero_copy_only=False)
            for chunk in chunks(batch.column("text")):
                rows = list(_windows(chunk, keys[chunk.rows], subs[chunk.rows], n, buckets))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SENT_ARROW)
    return run


def _find(parts: int):
    """One bucket: each window's documents but its first, told its hash."""
    def run(table: pa.Table) -> pa.Table:
        hashes, keys, subs, told = [], [], [], [[], [], []]
        for r in table.to_pylist():
            k, s = names_of(r)
            h = np.frombuffer(r["hashes"], dtype=U64)
            hashes.append(h)
            keys.append(k)
            subs.append(s)
            for to, x in zip(told, (*names_of(r, "again_counts"), h[unpack(r["again"])]), strict=True):
                to.append(x)
        h = np.concatenate(hashes)
        order = np.argsort(h)
        _, length = runs(h[order])
        order = order[np.repeat(length > 1, length)]  # windows that several chunks sent
        k, s, h = np.concatenate(keys)[order], np.concatenate(subs)[order], h[order]
        order = np.lexsort((s, k, h))
        k, s, h = k[order], s[order], h[order]
        later = np.ones(len(h), dtype=bool)
        later[runs(h)[0]] = False
        k, s, h = (np.concatenate([*t, x[later]]) for t, x in zip(told, (k, s, h), strict=True))
        # the documents a chunk has named come after its first one, which comes
        # after the window's first one or is it
        return reply(k, s, h.view(np.int64), parts)
    return run


def _intervals(words: np.ndarray, told: np.ndarray, n: int) -> np.ndarray:
    """Maximal ``[from, to)`` ranges of the windows told or had before; ``(m, 2)``."""
    h = window_hashes(words, n).view(np.int64)
    gone = np.isin(h, told)
    order = np.argsort(h, kind="stable")
    gone[order[1:]] |= h[order][1:] == h[order][:-1]
    at = np.flatnonzero(gone)
    if not len(at):
        return np.empty((0, 2), dtype=np.int64)
    gap = np.diff(at) > n
    return np.column_stack([at[np.r_[True, gap]], at[np.r_[gap, True]] + n])


_MERGED = "_k long, _sub long, n_words long, n_removed long, intervals array<array<long>>, kept string"
_MERGED_ARROW = pa.schema([("_k", pa.int64()), ("_sub", pa.int64()), ("n_words", pa.int64()),
                           ("n_removed", pa.int64()), ("intervals", pa.list_(pa.list_(pa.int64()))),
                           ("kept", pa.string())])


def _remove(n: int):
    """One part of the documents with the hashes that they were told."""
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        told = {(k, s): v for k, s, v in received(replies)}
        none = np.empty(0, dtype=np.int64)
        out = [[] for _ in _MERGED_ARROW]
        docs = docs.combine_chunks()
        keys, subs = docs.column("_k").to_pylist(), docs.column("_sub").to_pylist()
        for chunk in chunks(docs.column("text")):
            hashes = chunk.hashes()
            for i in range(chunk.n_rows):
                name = keys[chunk.rows.start + i], subs[chunk.rows.start + i]
                words = chunk.buf[chunk.off[i]:chunk.off[i + 1]].tobytes().split()
                spans = _intervals(hashes[chunk.word_off[i]:chunk.word_off[i + 1]], told.get(name, none), n).tolist()
                n_words, kept, last = len(words), [], 0
                for a, b in spans:
                    kept += words[last:a]
                    last = b
                kept += words[last:]
                row = (*name, n_words, n_words - len(kept), spans, b" ".join(kept).decode())
                for column, x in zip(out, row, strict=True):
                    column.append(x)
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, _MERGED_ARROW, strict=True)],
                                    schema=_MERGED_ARROW)
    return run


def substring_dedup(docs: DataFrame, n: int = WINDOW, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Words that repeat an earlier window of ``n`` words, removed from every text.

    Returns one row per row of ``docs``: ``(id_col, n_words, n_removed,
    intervals, kept)``; ``intervals`` are maximal ``[from, to)``
    word ranges removed and ``kept`` the other words joined by one space.
    Windows are judged on the input, not on what is left.

    Null text: no words. Fewer than ``n`` words: nothing removed. Null ids
    come last in the order. Equal rows (same id and text) count as one
    document, each with its result; different texts of one id are ordered by
    digest. Other columns are not read. An empty table gives an empty result.
    """
    rows, every_row = keyed(docs, id_col, text_col)
    buckets = n_buckets(rows)
    told = rows.mapInArrow(_send(n, buckets), _SENT).groupBy("bucket").applyInArrow(_find(buckets), REPLY)
    dealt = rows.mapInArrow(deal(buckets), "part int, _k long, _sub long, text string")
    merged = dealt.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_remove(n), _MERGED)
    return every_row(merged).select(id_of().alias(id_col), "n_words", "n_removed", "intervals", "kept")
