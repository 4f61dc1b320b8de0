"""Operator 13: cross-tokenizer alignment with an identity-map fast path.

Two tokenizers cut the same bytes, a space and the text, into tokens. Offsets
at which tokens of both end cut the bytes into groups, and all tokens of one
group are linked. A pair of ids is counted by the documents that link it.

Offline, every id of the first vocabulary gets the id of the second one that
stands for the same bytes, if there is one. A group of one token each, these
two, is regular: it is counted in a vector as long as the vocabulary, by its
first id alone. Pairs of all other groups are counted as pairs, and only they
are shuffled.

1. One pass encodes and aligns the texts and writes, per document, the figures
   of its groups and its links in packed form: regular ids and irregular pairs
   with their multiplicities. A text's words are aligned once and remembered:
   neither tokenizer has a token that goes on into the next word.
2. A second pass adds up vectors and pairs over all documents.
3. A third looks the counts of each document's links up. What regular groups
   need, the count of each id's own pair and the largest count of each id, are
   two vectors of the vocabulary's length. The pairs are looked up in a sorted
   array while there are at most ``max_pairs`` of them, else by a shuffle join.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recsift.llm.byte_bpe import _field
from recsift.llm.pieces import ODD, read_bytes
from recsift.llm.rows import saved
from recsift.llm.token_counts import _byte_chars
from recsift.llm.words import slices

# Pairs of ids that are looked up in one array (8 + 8 bytes each) in every task.
MAX_PAIRS = 4_000_000
# Words remembered at most and their characters, and pairs added up in a task before they are sent.
MEMO_WORDS = 400_000
MEMO_CHARS = 16 << 20
PAIRS_AT_ONCE = 2_000_000
# Both tokenizers always cut where a space or a line feed follows something else than
# white space. A word ends there; where a text has other white space, the first pattern finds it.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_WORD = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER = re.compile(r"[^\S \n]")
_INSIDE = re.compile(rb"[^ \n][ \n]")


def first_vocabulary(tokenizer: str) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer file; special tokens: none."""
    back = {c: b for b, c in _byte_chars().items()}
    vocab = json.loads(tokenizer)["model"]["vocab"]
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(back[c] for c in token)
    return out


def second_vocabulary(model: bytes) -> list[bytes]:
    """Bytes of each id of a sentencepiece model; controls and unknown: none."""
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    out = []
    for i in range(own.get_piece_size()):
        piece = own.id_to_piece(i)
        if own.is_control(i) or own.is_unknown(i):
            out.append(b"")
        elif own.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(piece.replace("▁", " ").encode())
    return out


def identity_map(first: list[bytes], second: list[bytes]) -> np.ndarray:
    """For each id of the first vocabulary the id of the same bytes in the
    second (a whole piece before a byte's), or -1."""
    of = {b: i for i, b in reversed(list(enumerate(second))) if b}
    for i, b in enumerate(second):  # of one byte there may be two: the later is the piece
        if len(b) == 1:
            of[b] = i
    return np.array([of.get(b, -1) if b else -1 for b in first], dtype=np.int32)


def without_prefix(model: bytes) -> bytes:
    """The model message with ``add_dummy_prefix`` (field 3 of field 3) off."""
    return model + _field(3, _field(3, 0))


def _varied(x: np.ndarray) -> bytes:
    return x.astype("<u4").tobytes()


class Table:
    """A numpy array that grows at its end."""

    def __init__(self):
        self.data, self.n = np.zeros(1024, dtype=np.int64), 0

    def add(self, x) -> None:
        x = np.asarray(x, dtype=np.int64)
        if self.n + len(x) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(x), len(self.data)), dtype=np.int64)])
        self.data[self.n:self.n + len(x)] = x
        self.n += len(x)

    def __getitem__(self, i):
        return self.data[i]


class Aligner:
    """Both tokenizers, and the alignment of the words met so far.

    Word ``i`` has ``sizes[3 * i:3 * i + 3]`` tokens of both kinds and groups,
    ``groups[i]`` as text, and its linked pairs in ``links`` from ``first[i]`` to
    ``first[i + 1]``, each ``a << 17 | b << 1 | regular``. Words that a tokenizer
    changes are in ``bad``.
    """

    def __init__(self, tokenizer: str, model: bytes, a_bytes: list[bytes], b_bytes: list[bytes], same: np.ndarray):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(tokenizer)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=without_prefix(model))
        self.a_bytes, self.b_bytes, self.same = a_bytes, b_bytes, same.tolist()
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.held, self.bad, self.groups = 0, set(), []
        self.sizes, self.first, self.links = Table(), Table(), Table()
        self.first.add([0])

    def _groups(self, raw: bytes, a: list[int], b: list[int]) -> tuple[list[str], list[int]] | None:
        a_bytes, b_bytes, same = self.a_bytes, self.b_bytes, self.same
        own, other = [a_bytes[i] if i < len(a_bytes) else b"" for i in a], [b_bytes[j] for j in b]
        if b"".join(own) != raw or b"".join(other) != raw:
            return None
        if len(a) == 1 and len(b) == 1:
            return [f"{a[0]}|{b[0]}"], [a[0] << 17 | b[0] << 1 | (same[a[0]] == b[0])]
        groups, links, p, q, i, j = [], [], 0, 0, 0, 0
        a_end, b_end = len(own[0]), len(other[0])
        while True:
            if a_end < b_end:
                p += 1
                a_end += len(own[p])
            elif b_end < a_end:
                q += 1
                b_end += len(other[q])
            else:
                p, q = p + 1, q + 1
                if p - i == 1 and q - j == 1:
                    groups.append(f"{a[i]}|{b[j]}")
                    links.append(a[i] << 17 | b[j] << 1 | (same[a[i]] == b[j]))
                else:
                    groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
                    links += [x << 17 | y << 1 for x in a[i:p] for y in b[j:q]]
                if a_end == len(raw):
                    return groups, links
                i, j = p, q
                a_end, b_end = a_end + len(own[p]), b_end + len(other[q])

    def learn(self, words: list[str]) -> None:
        """Aligns words that are not known yet."""
        if not words:
            return
        a_ids = [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]
        b_ids = self.b.encode(words, num_threads=1)
        sizes, ends, links, end = [], [], [], self.links.n
        for w, a, b in zip(words, a_ids, b_ids, strict=True):
            found = self._groups(w.encode(), a, b)
            if found is None:
                self.bad.add(len(self.groups))
                found = [], []
            sizes += [len(a), len(b), len(found[0])]
            links += found[1]
            end += len(found[1])
            ends.append(end)
            self.at[w] = len(self.groups)
            self.groups.append(";".join(found[0]))
            self.held += len(w)
        self.sizes.add(sizes)
        self.links.add(links)
        self.first.add(ends)

    def texts(self, texts: list[str | None]) -> list[tuple | None]:
        """For each text ``(n_a, n_b, n_groups, n_links, groups' digest, links,
        multiplicities)``; None for a text without tokens."""
        if len(self.groups) > MEMO_WORDS or self.held > MEMO_CHARS:
            self.forget()
        cut = [[] if not t else [" " + t] if ODD.search(t) else _CUT.split(" " + t) if _OTHER.search(t)
               else _WORD.findall(" " + t) for t in texts]
        self.learn([w for w in set().union(*cut) if w not in self.at])
        numbers = [list(map(self.at.__getitem__, words)) for words in cut]
        if self.bad:
            numbers = [[] if not self.bad.isdisjoint(n) else n for n in numbers]
        doc = np.repeat(np.arange(len(texts)), [len(n) for n in numbers])
        word = np.array([i for n in numbers for i in n], dtype=np.int64)
        sizes = [np.bincount(doc, self.sizes[3 * word + c], len(texts)).astype(np.int64).tolist() for c in range(3)]
        # each document's different words, then the pairs that these link
        (doc, word), times = _different(doc << 32 | word, np.ones(len(word), dtype=np.int64), 32)
        length = self.first[word + 1] - self.first[word]
        at = np.repeat(self.first[word] - np.cumsum(length) + length, length) + np.arange(length.sum())
        (doc, link), times = _different(np.repeat(doc, length) << 33 | self.links[at], np.repeat(times, length), 33)
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        out = []
        for i, n in enumerate(numbers):
            if not n:
                out.append(None)
                continue
            lo, hi = cuts[i], cuts[i + 1]
            digest = hashlib.sha256(";".join(map(self.groups.__getitem__, n)).encode()).hexdigest()
            out.append((sizes[0][i], sizes[1][i], sizes[2][i], int(times[lo:hi].sum()), digest, link[lo:hi], times[lo:hi]))
        return out


def _different(keys: np.ndarray, times: np.ndarray, bits: int) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """The different keys, cut in two at ``bits``, and the sum of ``times`` of each."""
    order = np.argsort(keys)
    keys, times = keys[order], times[order]
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
    keys = keys[head]
    return (keys >> bits, keys & ((1 << bits) - 1)), np.add.reduceat(times, head) if len(head) else times


_FIGURES = [("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
            ("groups_sha256", pa.string())]
_LINKS = [("regular", pa.binary()), ("regular_n", pa.binary()), ("pairs", pa.binary()), ("pairs_n", pa.binary())]


def _encode(*parts):
    kinds = [*_FIGURES, *_LINKS]

    def run(batches):
        own = Aligner(*parts)
        for batch in (part for batch in batches for part in slices(batch, batch.num_columns - 1)):
            rows = []
            for r in own.texts(batch.column(batch.num_columns - 1).to_pylist()):
                if r is None:
                    rows.append((0, 0, 0, 0, "", b"", b"", b"", b""))
                    continue
                *figures, links, n = r
                is_regular = (links & 1) == 1
                rows.append((*figures, (links[is_regular] >> 17).astype("<u2").tobytes(), _varied(n[is_regular]),
                             _varied(links[~is_regular] >> 1), _varied(n[~is_regular])))
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True))],
                names=[*batch.schema.names[:-1], *(name for name, _ in kinds)])
    return run


def _added(parts: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    ids, at = np.unique(np.concatenate(parts), return_inverse=True)
    return ids, np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)


_COUNTS_ARROW = pa.schema([("pair", pa.int64()), ("docs", pa.int64())])


def _count(same: np.ndarray):
    """Documents of each pair in a task: one vector for the regular groups'
    ids, and the other pairs, sent when there are many. ``pair``: ``a << 16 | b``."""
    def out(ids, n):
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], schema=_COUNTS_ARROW)

    def run(batches):
        vector = np.zeros(len(same), dtype=np.int64)
        parts, counts, held = [], [], 0
        for batch in batches:
            for regular, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a = np.frombuffer(regular, dtype="<u2")
                vector[a] += 1
                pair = np.frombuffer(pairs, dtype="<u4").astype(np.int64)
                # a document that links a regular pair in another group as well counts once
                known = np.isin(pair >> 16, a) & (same[np.minimum(pair >> 16, len(same) - 1)] == (pair & 0xFFFF))
                pair = pair[~known]
                parts.append(pair)
                counts.append(np.ones(len(pair), dtype=np.int64))
                held += len(pair)
            if held > PAIRS_AT_ONCE:
                ids, n = _added(parts, counts)
                parts, counts, held = [ids], [n], len(ids)
                if held > PAIRS_AT_ONCE // 2:
                    yield out(ids, n)
                    parts, counts, held = [], [], 0
        a = np.flatnonzero(vector)
        yield out(a << 16 | same[a], vector[a])
        if parts:
            yield out(*_added(parts, counts))
    return run


def _look_up(own: np.ndarray, best: np.ndarray, pairs: np.ndarray | None, docs: np.ndarray | None):
    """Per document: links whose pair has the largest count of its first id,
    and the sum of counts over its links."""
    def run(batches):
        for batch in batches:
            take = lambda name: batch.column(batch.schema.get_field_index(name)).to_pylist()
            n_best, count_sum = [], []
            for a, n, pair, m in zip(*map(take, ("regular", "regular_n", "pairs", "pairs_n")), strict=True):
                a, n = np.frombuffer(a, dtype="<u2"), np.frombuffer(n, dtype="<u4").astype(np.int64)
                c = own[a]
                top, total = int(n[c == best[a]].sum()), int((n * c).sum())
                if pairs is not None and pair:
                    pair, m = (np.frombuffer(x, dtype="<u4").astype(np.int64) for x in (pair, m))
                    c = docs[np.searchsorted(pairs, pair)]
                    top += int(m[c == best[pair >> 16]].sum())
                    total += int((m * c).sum())
                n_best.append(top)
                count_sum.append(total)
            keep = [i for i, name in enumerate(batch.schema.names) if name not in dict(_LINKS)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                names=[*(batch.schema.names[i] for i in keep), "n_best", "count_sum"])
    return run


def _unpack(batches):
    """Rows ``(_row, pair, times)`` of the irregular links."""
    schema = pa.schema([("_row", pa.int64()), ("pair", pa.int64()), ("times", pa.int64())])
    for batch in batches:
        for row, pairs, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pair = np.frombuffer(pairs, dtype="<u4").astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pair), row)), pa.array(pair),
                 pa.array(np.frombuffer(n, dtype="<u4").astype(np.int64))], schema=schema)


def align_tokens(docs: DataFrame, tokenizer_path: str, model_path: str, id_col: str = "doc_id",
                 text_col: str = "text", max_pairs: int = MAX_PAIRS) -> tuple[DataFrame, DataFrame]:
    """``(id_col, n_a, n_b, n_groups, n_links, groups_sha256, n_best,
    count_sum)`` for every row of ``docs``, and the links' counts over all of
    them, ``(a, b, docs)``.

    ``tokenizer_path``: a byte-level tokenizer file without normaliser and
    prefix space; ``model_path``: a sentencepiece BPE model that adds a space
    before the text. Both vocabularies have at most 65,536 ids. Special strings
    inside texts are plain text.

    Null and empty texts, and those that a tokenizer changes, have no tokens:
    zeros and ``''``. Rows are handled one by one, each counting as a document,
    so null and repeated ids need no rule; other columns are not read. A
    very long word is aligned as a whole. An empty table gives empty results.
    """
    tokenizer, model = read_bytes(tokenizer_path).decode(), read_bytes(model_path)
    spec = json.loads(tokenizer)
    if spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError("align_tokens needs a byte-level tokenizer without normaliser and prefix space")
    first, second = first_vocabulary(tokenizer), second_vocabulary(model)
    if max(len(first), len(second)) > 1 << 16:
        raise ValueError("align_tokens packs ids in 16 bits")
    if any(map(_INSIDE.search, second)):
        raise ValueError("align_tokens needs pieces without a space or line feed after another character")
    same = identity_map(first, second)
    kind = docs.schema[id_col].dataType.simpleString()
    sql = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    told = ", ".join(f"{name} {sql[t]}" for name, t in [*_FIGURES, *_LINKS])
    coded = saved(docs.select(id_col, text_col).mapInArrow(
        _encode(tokenizer, model, first, second, same), f"`{id_col}` {kind}, {told}"))
    counts = saved(coded.select("regular", "pairs").mapInArrow(_count(same), "pair long, docs long")
                   .groupBy("pair").agg(F.sum("docs").alias("docs")))
    # one row per id of the vocabulary at most
    best, own = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64)
    a = F.shiftright("pair", 16)
    for r in counts.groupBy(a.alias("a")).agg(F.max("docs").alias("docs")).collect():
        best[r["a"]] = r["docs"]
    twins = docs.sparkSession.createDataFrame(
        [(int(i) << 16 | int(same[i]),) for i in np.flatnonzero(same >= 0)], "pair long")
    for r in counts.join(F.broadcast(twins), "pair").collect():
        own[r["pair"] >> 16] = r["docs"]
    names = f"`{id_col}` {kind}, " + ", ".join(f"{n} {sql[t]}" for n, t in _FIGURES) + ", n_best long, count_sum long"
    pair_counts = counts.select(F.shiftright("pair", 16).cast("int").alias("a"),
                                F.col("pair").bitwiseAND(0xFFFF).cast("int").alias("b"), "docs")
    if counts.count() <= max_pairs:
        table = counts.orderBy("pair").toArrow()
        pairs, held = (table.column(c).to_numpy() for c in ("pair", "docs"))
        return coded.mapInArrow(_look_up(own, best, pairs, held), names), pair_counts
    rows = saved(coded.withColumn("_row", F.monotonically_increasing_id()))
    tops = counts.groupBy(a.alias("_a")).agg(F.max("docs").alias("_top"))
    known = counts.join(tops, F.shiftright("pair", 16) == F.col("_a")).select("pair", "docs", "_top")
    links = rows.select("_row", "pairs", "pairs_n").mapInArrow(_unpack, "_row long, pair long, times long")
    irregular = links.join(known, "pair").groupBy("_row").agg(
        F.sum(F.when(F.col("docs") == F.col("_top"), F.col("times")).otherwise(0)).alias("_best"),
        F.sum(F.col("docs") * F.col("times")).alias("_sum"))
    regular = rows.mapInArrow(_look_up(own, best, None, None), f"{names.replace(', n_best', ', _row long, n_best')}")
    joined = regular.join(irregular, "_row", "left")
    return joined.select(
        id_col, *[n for n, _ in _FIGURES], (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum")), pair_counts
