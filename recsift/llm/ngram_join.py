"""Operator 9: exact n-gram Jaccard join in size-banded tiles.

1. Every document's set of hashed shingles gives its size and a digest;
   documents with equal sets are one class, and the smallest stands for it.
2. The shingles, packed by document, go to buckets by hash, which find those
   that more than one document holds and send them back, marked with how
   common they are (:mod:`recsift.llm.blobs`). A document that links has at
   least ``sim`` of its shingles in common with others; the rest is done.
3. Two linked documents share one of their ``n - ceil(sim * n) + 1`` rarest
   shingles. Documents that share such a shingle form a candidate group.
4. A group too large for one tile first meets some of its own documents, picked
   by hash, in tiles. What these link is one component, inside which nothing is
   left to find: shingles that only one component holds no longer make candidates,
   and groups are formed again from the others, while that halves the large ones.
   A group of near copies thus takes time in proportion to its size.
5. A group is cut into tiles by size band (a linked pair's sizes are within
   1 : ``sim``, so it lies in one band or two neighbouring ones) and, where a
   band is large, by hash. In a tile every document gets a hashed bitmap; the
   bits it has and another lacks bound their overlap from above, and pairs
   that pass are decided by exact intersection of their sorted arrays.

No pair leaves a tile: it returns at most one link per document (a spanning
forest of the links it found), from which components are formed.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.blobs import (
    REPLY,
    bucket_of,
    by_bucket,
    deal,
    n_buckets,
    names_of,
    pack_names,
    received,
    reply,
    runs,
)
from recsift.llm.components import components
from recsift.llm.links import Forest
from recsift.llm.rows import NULL_KEY, _repeated_ids, keyed, packed_once, saved
from recsift.llm.words import U64, Chunk, chunks, mix, window_hashes

SHINGLE = 5
SIMILARITY = Fraction(3, 4)
# Documents and shingles in one side of a tile.
TILE_DOCS = 1024
TILE_SHINGLES = 1 << 20
LEADERS = 64  # documents that a large group meets first, about
_BLOCK = 256  # rows of a tile compared at once

_SETS = "_k long, _sub long, n long, d1 long, d2 long"
_SETS_ARROW = pa.schema([("_k", pa.int64()), ("_sub", pa.int64()), ("n", pa.int64()),
                         ("d1", pa.int64()), ("d2", pa.int64())])
_SENT = "bucket int, docs binary, subs binary, counts binary, hashes binary"
_SENT_ARROW = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("subs", pa.binary()),
                         ("counts", pa.binary()), ("hashes", pa.binary())])
_CAND = "class long, n long, tokens array<long>"
_CAND_ARROW = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))])


def shingle_sets(chunk: Chunk, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different shingle hashes of every row of the chunk, one after the
    other, and their offsets. A row of fewer words has its sequence as one."""
    words = chunk.hashes(fold=True)
    h = window_hashes(words, size)
    parts, off = [], np.zeros(chunk.n_rows + 1, dtype=np.int64)
    for i in range(chunk.n_rows):
        lo, hi = chunk.word_off[i], chunk.word_off[i + 1]
        if hi - lo >= size:
            x = np.sort(h[lo:hi - size + 1])
            x = x[np.r_[True, x[1:] != x[:-1]]]
        elif hi > lo:
            x = mix(window_hashes(words[lo:hi], int(hi - lo)) + U64(hi - lo))
        else:
            x = h[:0]
        parts.append(x)
        off[i + 1] = off[i] + len(x)
    return np.concatenate(parts) if parts else h[:0], off


def _batches(batches):
    for batch in batches:
        keys = batch.column("_k").to_numpy(zero_copy_only=False)
        subs = batch.column("_sub").to_numpy(zero_copy_only=False)
        for chunk in chunks(batch.column("text")):
            yield chunk, keys[chunk.rows], subs[chunk.rows]


def _sets(size: int):
    def run(batches):
        for chunk, keys, subs in _batches(batches):
            h, off = shingle_sets(chunk, size)
            sums = [np.r_[U64(0), np.cumsum(mix(h + U64(c)))] for c in (0, 0x632BE59BD9B4E019)]
            d = [(s[off[1:]] - s[off[:-1]]).view(np.int64) for s in sums]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (keys, subs, np.diff(off), *d)], schema=_SETS_ARROW)
    return run


def _pack56(h: np.ndarray) -> bytes:
    """The low 56 bits of each hash; the bucket comes from the high 32."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7].tobytes()


def _unpack56(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 7, 8), dtype=np.uint8)
    out[:, :7] = np.frombuffer(b, dtype=np.uint8).reshape(-1, 7)
    return out.view("<u8").ravel()


def _send(size: int, buckets: int):
    def run(batches):
        for chunk, keys, subs in _batches(batches):
            h, off = shingle_sets(chunk, size)
            row = np.repeat(np.arange(chunk.n_rows), np.diff(off))
            rows = []
            for b, i in by_bucket(bucket_of(h, buckets), buckets):
                docs, counts = runs(row[i])
                docs = row[i][docs]
                rows.append({"bucket": b, "hashes": _pack56(h[i]),
                             **pack_names(keys[docs], subs[docs], counts)})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SENT_ARROW)
    return run


def _find(parts: int):
    """One bucket: the shingles of each document that others hold too, as
    ``commonness << 56 | hash``: ascending from rare to common, the same value
    in every document that holds the shingle."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        names = [names_of(r) for r in rows]
        h = np.concatenate([_unpack56(r["hashes"]) for r in rows])
        order = np.argsort(h)
        _, length = runs(h[order])
        held = np.repeat(length, length)
        twice = held > 1
        order, held = order[twice], held[twice]
        level = np.minimum(127, 4 * np.log2(held)).astype(U64)
        token = (level << U64(56) | h[order]).view(np.int64)
        keys, subs = (np.concatenate([x[j] for x in names])[order] for j in (0, 1))
        return reply(keys, subs, token, parts)
    return run


def _gather(sim: Fraction):
    """One part of the documents: classes whose first row has enough shared
    shingles to link, with these."""
    def run(heads: pa.Table, replies: pa.Table) -> pa.Table:
        of = {(k, s): (c, n) for k, s, c, n in zip(*(heads.column(c).to_pylist() for c in (
            "_k", "_sub", "class", "n")), strict=True)}
        out = [[], [], []]
        for k, s, tokens in received(replies):
            name, n = of.get((k, s), (None, 0))
            if name is not None and len(tokens) * sim.denominator >= n * sim.numerator:
                for column, x in zip(out, (name, n, tokens), strict=True):
                    column.append(x)
        return pa.table([pa.array(c, type=f.type) for c, f in zip(out, _CAND_ARROW, strict=True)],
                        schema=_CAND_ARROW)
    return run


def _bitmaps(parts: list[np.ndarray]) -> np.ndarray:
    """One hashed bitmap per set, about four bits to an element of the largest."""
    longest = max(len(p) for p in parts)
    bits = 64 * max(1, 1 << math.ceil(math.log2(max(1, 4 * longest / 64))))
    out = np.zeros((len(parts), bits // 64), dtype=U64)
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    bit = mix(np.concatenate(parts).view(U64)) & U64(bits - 1)
    np.bitwise_or.at(out, (row, (bit >> U64(6)).astype(np.int64)), U64(1) << (bit & U64(63)))
    return out


def _overlap_at_least(x: np.ndarray, y: np.ndarray, need: int) -> bool:
    """Whether two sorted arrays of different values share ``need`` of them."""
    if min(len(x), len(y)) < need:
        return False
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int(np.count_nonzero(y[at] == x)) >= need


def _need(a: np.ndarray, b: np.ndarray, sim: Fraction) -> np.ndarray:
    """Least overlap of sets of these sizes: ``ceil(sim * (a + b) / (1 + sim))``."""
    p, q = sim.numerator, sim.denominator
    return -(-(p * (a + b)) // (p + q))


def _same(comp: np.ndarray) -> tuple[list[int], list[int]]:
    """Every row that is not the first of its component, and that first row."""
    _, first, of = np.unique(comp, return_index=True, return_inverse=True)
    later = np.flatnonzero(first[of] != np.arange(len(comp)))
    return first[of][later].tolist(), later.tolist()


def tile_links(n: np.ndarray, tokens: list[np.ndarray], left: np.ndarray, right: np.ndarray,
               sim: Fraction, comp: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links between the rows ``left`` and ``right``
    of a tile (the same rows: all pairs among them). ``n``: set sizes;
    ``tokens``: each row's shared shingles, sorted; ``comp``: components known
    before, whose rows need no further link to each other."""
    if not len(left) or not len(right):
        return []
    maps, held = _bitmaps(tokens), np.array([len(t) for t in tokens])
    forest, links = Forest(len(n)), []
    for head, i in zip(*_same(comp), strict=True) if comp is not None else ():
        forest.join(head, i)
    right = right[np.argsort(n[right], kind="stable")]
    for b in range(0, len(left), _BLOCK):
        for i in left[b:b + _BLOCK].tolist():
            # sizes within sim of each other, and not yet in one component
            lo = np.searchsorted(n[right], -(-sim.numerator * int(n[i]) // sim.denominator))
            hi = np.searchsorted(n[right], int(n[i]) * sim.denominator // sim.numerator, "right")
            js = right[lo:hi]
            js = js[js != i]
            if not len(js):
                continue
            js = js[forest.roots()[js] != forest.root(i)]
            need = _need(n[i], n[js], sim)
            lacks = np.bitwise_count(maps[i] & ~maps[js]).sum(axis=1, dtype=np.int64)
            extra = np.bitwise_count(maps[js] & ~maps[i]).sum(axis=1, dtype=np.int64)
            ok = np.minimum(held[i] - lacks, held[js] - extra) >= need
            for j, m in zip(js[ok].tolist(), need[ok].tolist(), strict=True):
                if forest.root(i) != forest.root(j) and _overlap_at_least(tokens[i], tokens[j], m):
                    forest.join(i, j)
                    links.append((i, j))
    return links


def _tile(sim: Fraction):
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("class", "ascending"), ("side", "ascending")])
        n = table.column("n").to_numpy().astype(np.int64)
        ids = table.column("class").to_numpy()
        side = table.column("side").to_numpy()
        flat = table.column("tokens").combine_chunks()
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        off, values = flat.offsets.to_numpy(), flat.values.to_numpy()
        tokens = [values[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)  # 2: both
        links = tile_links(n, tokens, left, right, sim, table.column("comp").to_numpy())
        a = np.array([ids[i] for i, _ in links], dtype=np.int64)
        b = np.array([ids[j] for _, j in links], dtype=np.int64)
        return pa.table([pa.array(a), pa.array(b)], schema=out)
    return run


def _tiles(cand: DataFrame, sim: Fraction) -> DataFrame:
    """Candidates ``(class, grp, comp, n, held)`` dealt to tiles: ``(group, band_a,
    part_a, band_b, part_b)`` with a row's ``side`` in it (0 left, 1 right, 2 both)."""
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / sim) + 1e-9).cast("int")
    cand = cand.withColumn("band", band)
    parts = (cand.groupBy("grp", "band")
             .agg(F.count("*").alias("docs"), F.sum("held").alias("held"))
             .select("grp", "band", F.greatest(
                 F.ceil(F.col("docs") / TILE_DOCS), F.ceil(F.col("held") / TILE_SHINGLES))
                 .cast("int").alias("parts")))
    above = parts.select("grp", (F.col("band") - 1).alias("band"), F.col("parts").alias("above"))
    below = parts.select("grp", (F.col("band") + 1).alias("band"), F.col("parts").alias("below"))
    shape = parts.join(above, ["grp", "band"], "left").join(below, ["grp", "band"], "left")
    mine = F.pmod(F.xxhash64("class"), "parts").cast("int")
    cand = cand.join(shape, ["grp", "band"]).withColumn("part", mine)
    none = F.array().cast("array<struct<ba:int,pa:int,bb:int,pb:int,side:int>>")

    def tile(band_a, part_a, band_b, part_b, side):
        return F.struct(band_a.alias("ba"), part_a.cast("int").alias("pa"), band_b.alias("bb"),
                        part_b.cast("int").alias("pb"), side.alias("side"))

    b, p, i32 = F.col("band"), F.col("part"), lambda x: F.lit(x).cast("int")
    upto = lambda top: F.sequence(F.lit(0), top - 1)
    same = F.transform(upto(F.col("parts")), lambda q: tile(
        b, F.least(p, q), b, F.greatest(p, q),
        F.when(q == p, i32(2)).when(p < q, i32(0)).otherwise(i32(1))))
    up = F.when(F.col("above").isNull(), none).otherwise(F.transform(
        upto(F.col("above")), lambda q: tile(b, p, (b + 1).cast("int"), q, i32(0))))
    down = F.when(F.col("below").isNull(), none).otherwise(F.transform(
        upto(F.col("below")), lambda q: tile((b - 1).cast("int"), q, b, p, i32(1))))
    return cand.select("grp", "class", "comp", "n", F.explode(F.concat(same, up, down)).alias("t")) \
        .select("grp", "t.*", "class", "comp", "n")


def _leader_tiles(members: DataFrame, large: DataFrame, seed: int) -> DataFrame:
    """The large groups' rows dealt to tiles ``(grp, part)`` (side 1), and about
    ``LEADERS`` rows of each group, of at most ``TILE_SHINGLES`` by expectation,
    in every one of them (side 0)."""
    one_in = F.greatest(F.col("docs"), F.ceil(F.col("all_held") * LEADERS / TILE_SHINGLES))
    mine = F.array(F.struct(F.pmod(F.xxhash64("class"), "parts").cast("int").alias("part"), F.lit(1).alias("side")))
    every = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.struct(p.alias("part"), F.lit(0).alias("side")))
    leads = F.pmod(F.xxhash64("class", F.lit(seed)), one_in) < LEADERS
    return members.join(large.withColumnRenamed("held", "all_held"), "grp") \
        .select("grp", "class", "comp", "n", F.explode(F.when(leads, F.concat(mine, every)).otherwise(mine)).alias("t")) \
        .select("grp", "t.*", "class", "comp", "n")


def _groups(keys: DataFrame, comp: DataFrame | None) -> DataFrame:
    """``(class, grp, comp, n, held)`` of the classes that share a token with a class of
    another component. ``keys``: ``(class, n, held, prefix)``; ``comp``: ``(id,
    component)`` as known, which a class meets before its tokens become rows."""
    if comp is None:
        keys = keys.withColumn("comp", F.col("class"))
    else:
        keys = keys.join(comp, F.col("class") == F.col("id"), "left") \
            .select("class", "n", "held", "prefix", F.coalesce("component", "class").alias("comp"))
    named = keys.select("class", "comp", F.explode("prefix").alias("token"))
    live = named.groupBy("token").agg(F.min("class").alias("head"), F.min("comp").alias("lo"),
                                      F.max("comp").alias("hi")).filter("lo <> hi").select("token", "head")
    groups = components(named.join(live, "token").select("class", "head").distinct(), "class", "head")
    return keys.select("class", "comp", "n", "held").join(groups, F.col("class") == F.col("id")) \
        .select("class", F.col("component").alias("grp"), "comp", "n", "held")


def _links(cand: DataFrame, keys: DataFrame, sim: Fraction) -> DataFrame:
    """``(a, b)``: links that connect what the links between ``cand`` connect.
    Rows are dealt without their tokens, which they meet last."""
    tokens = cand.select("class", "tokens")
    links, comp, before, seed = None, None, None, 0
    while True:
        members = saved(_groups(keys, comp))
        large = saved(members.groupBy("grp").agg(F.count("*").alias("docs"), F.sum("held").alias("held"))
                      .filter((F.col("docs") > TILE_DOCS) | (F.col("held") > TILE_SHINGLES))
                      .select("*", F.greatest(F.ceil(F.col("docs") / TILE_DOCS), F.ceil(
                          F.col("held") / TILE_SHINGLES)).cast("int").alias("parts")))
        docs = large.agg(F.sum("docs")).first()[0] or 0
        if not docs or (before is not None and 2 * docs > before):
            break
        found = _leader_tiles(members, large, seed).join(tokens, "class").groupBy("grp", "part") \
            .applyInArrow(_tile(sim), "a long, b long")
        links = saved(found if links is None else links.unionByName(found))
        comp, before, seed = components(links), docs, seed + 1
    rest = saved(_tiles(members, sim).join(tokens, "class").groupBy("grp", "ba", "pa", "bb", "pb")
                 .applyInArrow(_tile(sim), "a long, b long"))
    return rest if links is None else links.unionByName(rest)


def _linked(rows: DataFrame, sim: Fraction, size: int) -> DataFrame:
    """For the rows of :func:`keyed`: ``(_k, _sub, n, class_k, component, least)``;
    ``component`` numbers the component, ``least`` is its smallest ``_k``; null
    for rows without words."""
    sets = saved(rows.mapInArrow(_sets(size), _SETS))
    classes = sets.filter("n > 0").groupBy("n", "d1", "d2").agg(
        F.min(F.struct("_k", "_sub")).alias("first"), F.min("_k").alias("class_k"))
    # a class is named by its first row: the id, or a hash of its name where rows share the id
    name = F.when(F.col("first._sub") == 0, F.col("first._k")).otherwise(F.xxhash64("first"))
    classes = saved(classes.select("n", "d1", "d2", "first", "class_k", name.alias("class")))
    buckets = n_buckets(rows)
    told = rows.mapInArrow(_send(size, buckets), _SENT).groupBy("bucket").applyInArrow(_find(buckets), REPLY)
    heads = classes.select(F.col("first._k").alias("_k"), F.col("first._sub").alias("_sub"), "class", "n") \
        .mapInArrow(deal(buckets), "part int, _k long, _sub long, class long, n long")
    cand = saved(heads.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_gather(sim), _CAND))
    least = F.ceil(F.col("n") * sim.numerator / sim.denominator)
    # the rarest shingles: those that nobody else holds come first and match nothing
    prefix = F.slice("tokens", 1, F.greatest(
        F.lit(0), (F.col("n") - least + 1 - (F.col("n") - F.size("tokens"))).cast("int")))
    keys = cand.select("class", "n", F.size("tokens").alias("held"), prefix.alias("prefix"))
    reach = components(_links(cand, keys, sim))
    of = classes.join(reach, classes["class"] == reach["id"], "left").select(
        "n", "d1", "d2", "class_k", F.coalesce("component", "class").alias("component"))
    named = of.groupBy("component").agg(F.min("class_k").alias("least"))
    of = of.join(named, "component").select("n", "d1", "d2", "class_k", "component", "least")
    return sets.join(of, ["n", "d1", "d2"], "left").select("_k", "_sub", "n", "class_k", "component", "least")


def jaccard_join(docs: DataFrame, sim: Fraction = SIMILARITY, size: int = SHINGLE,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents whose shingle sets have a Jaccard similarity of ``sim`` or
    more are linked; returns one row per row of ``docs``: ``(id_col,
    n_shingles, class_id, component_id)``.

    ``class_id`` is the smallest id with an equal set, ``component_id`` the
    smallest id reachable by links, itself included. A document's set has its
    different ``size``-word shingles (A-Z as a-z); of fewer words, the whole
    sequence; without words or text it is empty and links with nothing.
    Null ids come last: a component of null ids only has a null id. Rows with
    one id may differ in text; each gets its own result. Other columns are not
    read. An empty table gives an empty result.
    """
    rows, every_row = keyed(docs, id_col, text_col)
    out = every_row(_linked(rows, sim, size))
    null = lambda c: F.when(c != F.lit(NULL_KEY), c)
    return out.select(null(F.col("_k")).alias(id_col), F.col("n").alias("n_shingles"),
                      null(F.coalesce("class_k", "_k")).alias("class_id"),
                      null(F.coalesce("least", "_k")).alias("component_id"))


def keep_one(docs: DataFrame, sim: Fraction = SIMILARITY, size: int = SHINGLE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, the one of the smallest id (of
    equal ids, by text digest, then by the hash of the whole row); rows without
    words all stay, equal ones of a repeated id once. All columns stay."""
    rows, _ = keyed(docs, id_col, text_col)
    linked = saved(_linked(rows, sim, size))
    heads = (linked.filter("component is not null").groupBy("component").agg(F.min(F.struct("_k", "_sub")).alias("x"))
             .select("x.*", F.lit(True).alias("_one"))
             .unionByName(linked.filter("component is null").select("_k", "_sub", F.lit(False).alias("_one"))))
    packed, row = packed_once(docs, id_col, text_col)
    kept = packed.join(heads, (F.col("_id_key") == F.col("_k")) & F.col("_sub").isin(F.lit(0), F.col("_digest")))
    if _repeated_ids(packed.select("_id_key")) is None:
        return kept.select(f"`{row}`.*")
    # rows of one id and text that differ elsewhere: one of them, if it has words
    first = kept.filter("_one").groupBy("_id_key", "_digest").agg(F.min_by(row, "_row").alias(row))
    return first.select(f"`{row}`.*").unionByName(kept.filter("not _one").select(f"`{row}`.*"))
