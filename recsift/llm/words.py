"""Words and their hashes, vectorised over the UTF-8 buffer of an Arrow column.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. None of those
bytes occurs inside a multi-byte UTF-8 character, so bytes and code points
give the same words. Hashes are 64-bit polynomials modulo 2**64 (Rabin-Karp),
computed for all words, or all windows, of a chunk from one prefix sum:
``H(s, e) = (P[e] - P[s]) * a**s`` with ``P[i] = sum(x[k] * a**-k, k < i)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
WORD_BASE = 0x9E3779B97F4A7C15
WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
# Text per chunk, and bytes per prefix sum: the arrays of a chunk stay within some tens of MB.
CHUNK_BYTES = 2 << 20
SEGMENT_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** [0, n)`` modulo 2**64 (kept and extended)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SEGMENT_BYTES + 1), base, dtype=U64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (splitmix64): spreads entropy over all 64 bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _prefix(x: np.ndarray, base: int) -> np.ndarray:
    """``P`` of the module docstring, one longer than ``x``."""
    p = np.zeros(len(x) + 1, dtype=U64)
    np.multiply(x, powers(pow(base, -1, 1 << 64), len(x)), out=p[1:])
    np.cumsum(p[1:], out=p[1:])
    return p


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False,
                base: int = WORD_BASE) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans in order, not overlapping.
    ``fold``: with A-Z as a-z."""
    out = np.empty(len(starts), dtype=U64)
    i = 0
    while i < len(starts):
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + SEGMENT_BYTES, "right")))
        seg = buf[lo:ends[j - 1]]
        p = _prefix((LOWER[seg] if fold else seg).astype(U64) + U64(1), base)
        s, e = starts[i:j] - lo, ends[i:j] - lo
        h = (p[e] - p[s]) * powers(base, len(seg) + 1)[s]
        out[i:j] = mix(h + (e - s).astype(U64) * U64(0x8CB92BA72F3D8DD7))
        i = j
    return out


def window_hashes(words: np.ndarray, n: int, base: int = WINDOW_BASES[0]) -> np.ndarray:
    """Rabin-Karp hash of every ``n`` consecutive word hashes (``len - n + 1`` of them)."""
    if len(words) < n:
        return np.empty(0, dtype=U64)
    p = _prefix(words, base)
    m = len(words) - n + 1
    return mix((p[n:] - p[:m]) * powers(base, m))


class Chunk:
    """Some rows of an Arrow batch: their text as one byte buffer and its words.

    ``rows``: slice of the batch; ``buf``: bytes; ``off``: byte offset of each
    row (one more than rows); ``starts``/``ends``: byte spans of the words;
    ``word_off``: word offset of each row (one more than rows).
    """

    def __init__(self, rows: slice, buf: np.ndarray, off: np.ndarray):
        self.rows, self.buf, self.off = rows, buf, off
        self.n_rows = len(off) - 1
        solid = ~SPACE[buf]
        first, last = solid.copy(), solid.copy()
        if len(buf):
            first[1:] &= ~solid[:-1]
            last[:-1] &= ~solid[1:]
            inner = off[(off > 0) & (off < len(buf))]  # rows touch without a space between
            first[inner] = solid[inner]
            last[inner - 1] = solid[inner - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.word_off = np.searchsorted(self.starts, off)

    def hashes(self, fold: bool = False) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends, fold)

    def windows_inside(self, n: int) -> np.ndarray:
        """Word positions where an ``n``-word window lies within one row."""
        total = len(self.starts)
        if total < n:
            return np.empty(0, dtype=np.int64)
        ok = np.ones(total - n + 1, dtype=bool)
        for cut in self.word_off[1:-1]:
            ok[max(0, cut - n + 1):cut] = False
        return np.flatnonzero(ok)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None \
        else np.empty(0, dtype=np.uint8)
    return buf, off - off[0]


def slices(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ``limit`` bytes of text in ``column`` (a
    longer row alone), so that what a task makes of a part stays small."""
    _, off = utf8(batch.column(column))
    i, n = 0, len(off) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1))
        yield batch.slice(i, j - i)
        i = j


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The column in chunks of at most ``limit`` bytes of text (a longer row alone)."""
    buf, off = utf8(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield Chunk(slice(i, j), buf[off[i]:off[j]], off[i:j + 1] - off[i])
        i = j
