"""Alternating least squares whose normal equations may be solved from several tasks.

Spark ML's ALS solves an id's equations in the id's block, so an id with a
third of the ratings makes one long task per half-iteration. Here the ratings
of one side are dealt to parts of about equal size once: an ordinary id's to
one part, which solves it; a hot id's (over a quarter of a part) to all parts by the
other id, each of which adds up a partial Gram matrix of its share. Partial
matrices are summed up in a tree of fan-in 32 and solved at its root.

Parts go in groups, and a group gets each factor that it needs once, packed in
binary: groups are as few as the factors that one may hold allow, so what is sent
follows the ids and not the parts. The groups that need an id are bits that lie
with the ratings of its part and come out with its factors, so no half-iteration
joins them; the ratings stay cached in their groups for a fit. Factors are
checkpointed after every half-iteration, so a lost executor costs one at most.

That is for factors of :data:`READ_FLOATS` floats at most. Larger ones are written once
a half-iteration and read by each group (:mod:`recsift.operators.read_als`): sent, they
would be shuffled about once a group. The
equations are Spark ML's: the regularisation is scaled by the number of ratings, implicit models
weigh by ``alpha``; items are solved first.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from threading import Lock
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.operators.joins import attach_keys, materialize_keys
from recsift.session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not install the package

# Ratings in a part: about 8 MB, and a factor for each at most.
PART_RATINGS = 500_000
# Ratings in a group of parts: about 200 MB.
GROUP_RATINGS = 16_000_000
# Floats of the factors in a part or a group, and of those packed at once.
PART_FLOATS = 64_000_000
SHIP_FLOATS = 1 << 21
# Floats of both sides' factors up to which they are sent to the groups.
READ_FLOATS = 1 << 20
# Ids with more than this share of a part's ratings are spread over all parts.
HOT_SHARE = 4
FAN_IN = 32
# Bytes of normal equations solved at once in a task.
SOLVE_BYTES = 64 << 20

_FACTORS = "id int, features array<float>"
_HALF = f"{_FACTORS}, part int, equations binary"
_SENT = "grp int, n int, ids binary, vectors binary, high binary"


@dataclass(frozen=True)
class FactorModel:
    """Factor tables ``(id, features)``, in the shape of Spark ML's model."""

    rank: int
    userFactors: DataFrame
    itemFactors: DataFrame


@dataclass(frozen=True)
class Side:
    """The ratings as dealt for one side: ``packed`` ``(part, dst, src, rating,
    hot)`` (one row a part, arrays sorted by ``dst``), and the number of parts and
    hot ids."""

    packed: DataFrame
    parts: int
    n_hot: int


@dataclass(frozen=True)
class Grouped:
    """A side's parts in their groups, cached for a fit: ``packed`` as dealt with
    its group's key ``grp`` and, for its ordinary ids in order, ``to``, the bits of
    the other side's groups that need them."""

    side: Side
    packed: DataFrame
    keys: list[int]


@dataclass(frozen=True)
class Dealt:
    """Ratings dealt for both sides; fits of any rank and regularisation may share them."""

    ratings: DataFrame
    by_item: Side
    by_user: Side


def _pack(table: pa.Table) -> pa.Table:
    table = table.sort_by([("dst", "ascending"), ("src", "ascending")])
    column = lambda c, kind: table.column(c).to_numpy().astype(kind).tobytes()
    return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()),
                     "dst": [column("dst", "<i4")], "src": [column("src", "<i4")],
                     "rating": [column("rating", "<f4")], "hot": [column("hot", "?")]})


def _needs(table: pa.Table) -> pa.Table:
    """The other side's ids that a group needs."""
    ids = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), dtype="<i4") for c in table.column("src").chunks for x in c]))
    grp = table.column("nth")[0].as_py()
    return pa.table({"id": pa.array(ids), "nth": pa.array(np.full(len(ids), grp, dtype=np.int32))})


def _rows_of(flat: np.ndarray, width: int, n: int) -> pa.Array:
    """``n`` binaries of ``width`` bytes each."""
    ends = np.arange(0, n * width + 1, width, dtype=np.int32) if width else np.zeros(n + 1, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat))])


def _bits(groups: int):
    """mapInArrow function: lists of groups as bits."""
    width = -(-groups // 8)

    def run(batches):
        for batch in batches:
            lists = batch.column("nths")
            of = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            told = np.zeros((len(lists), 8 * width), dtype=np.uint8)
            told[of, lists.flatten().to_numpy(zero_copy_only=False)] = 1
            yield pa.RecordBatch.from_arrays([batch.column("id"), _rows_of(np.packbits(told, axis=1), width, len(lists))],
                                             names=["id", "to"])
    return run


def _add_links(packed: pa.Table, links: pa.Table) -> pa.Table:
    """Cogroup function: a part and the groups that need its ordinary ids."""
    if not len(packed):
        return packed.append_column("to", pa.array([], pa.binary()))
    dst, hot = (np.frombuffer(packed.column(c)[0].as_buffer(), dtype=k) for c, k in (("dst", "<i4"), ("hot", "?")))
    links = links.sort_by("id").combine_chunks()
    links = links.filter(pa.array(np.isin(links.column("id").to_numpy(), dst[~hot])))
    to = b"".join(x.as_buffer() for c in links.column("to").chunks for x in c)
    return packed.append_column("to", pa.array([to], pa.binary()))


def _part_of(column: str, parts: int):
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def _group_keys(spark, groups: int, partitions: int) -> list[int]:
    """``groups`` numbers that a shuffle puts into different partitions."""
    at = spark.range(64 * partitions).select(F.col("id").cast("int").alias("id")) \
        .groupBy(F.pmod(F.hash("id"), F.lit(partitions)).alias("p")).agg(F.min("id").alias("id"))
    keys = [r["id"] for r in at.orderBy("p").limit(groups).collect()]
    return keys + [64 * partitions + n for n in range(groups - len(keys))]


def n_groups(side: Side, other_ids: int, ratings: int, spec) -> int:
    """Groups of a side's parts: half of ``spec.blocks`` at least, and so many that
    one holds at most about ``GROUP_RATINGS`` ratings and ``PART_FLOATS`` floats of
    factors. Of ``n`` ids, ``r`` ratings have at most about ``n (1 - exp(-r / n))``."""
    room = max(1, PART_FLOATS // spec.rank)
    held = ratings if room >= other_ids else -other_ids * math.log(1 - room / other_ids)
    return max(1, min(side.parts, max(-(-spec.blocks // 2), -(-ratings // GROUP_RATINGS), math.ceil(ratings / max(held, 1)))))


def group_both(dealt: Dealt, spec) -> tuple[Grouped, Grouped, DataFrame]:
    """Both sides in groups for a fit (by item, by user), and the links ``(id, to)`` of the users."""
    spark, sides = dealt.ratings.sparkSession, (dealt.by_item, dealt.by_user)
    n, *ids = dealt.ratings.agg(F.count(F.lit(1)), F.approx_count_distinct("user_id"),
                                F.approx_count_distinct("item_id")).first()
    placed, links = [], []
    for side, other in zip(sides, ids, strict=True):
        groups = n_groups(side, other, n, spec)
        partitions = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
        keys = _group_keys(spark, groups, partitions)
        nth = F.pmod("part", F.lit(groups))
        packed = side.packed.withColumn("nth", nth).withColumn("grp", F.element_at(F.array(*map(F.lit, keys)), nth + 1))
        need = packed.select("nth", "src").groupBy("nth").applyInArrow(_needs, "id int, nth int")
        links.append(materialize_keys(need.groupBy("id").agg(F.collect_list("nth").alias("nths"))
                                      .mapInArrow(_bits(groups), "id int, to binary")))
        placed.append((side, packed.drop("nth"), keys, partitions))
    out = []
    for (side, packed, keys, partitions), told in zip(placed, reversed(links), strict=True):
        told = told.withColumn("part", _part_of("id", side.parts))
        schema = "part int, dst binary, src binary, rating binary, hot binary, grp int, to binary"
        packed = packed.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(_add_links, schema)
        out.append(Grouped(side, packed.repartition(partitions, "grp").persist(), keys))
    return *out, links[0]


def deal(ratings: DataFrame, dst: str, src: str, parts: int) -> Side:
    """Deals ``ratings`` (``dst``, ``src``, ``rating``) to ``parts`` for the side ``dst``."""
    rows = ratings.select(F.col(dst).alias("dst"), F.col(src).alias("src"), "rating")
    per_id = rows.groupBy("dst").agg(F.count(F.lit(1)).alias("n"))
    size = rows.count() / parts
    hot = materialize_keys(per_id.filter(F.col("n") > size / HOT_SHARE).select("dst", F.lit(True).alias("hot")))
    n_hot = hot.count()
    rows = attach_keys(rows, hot, "dst", hot=False)
    spread = F.pmod(F.xxhash64("dst", "src"), F.lit(parts)).cast("int")
    rows = rows.withColumn("part", F.when(F.col("hot"), spread).otherwise(_part_of("dst", parts)))
    packed = rows.groupBy("part").applyInArrow(_pack, "part int, dst binary, src binary, rating binary, hot binary")
    return Side(materialize_keys(packed), parts, n_hot)


def n_parts(ratings: int, spec, part_ratings: int = PART_RATINGS) -> int:
    """Parts for so many ratings: ``spec.blocks`` at least, each of at most about
    ``part_ratings`` ratings and ``PART_FLOATS`` floats of factors."""
    return max(spec.blocks, -(-ratings // part_ratings), -(-ratings * spec.rank // PART_FLOATS))


def rated(train: DataFrame, spec) -> DataFrame:
    """The ratings that :func:`fit_gram_als` fits, written once, as Parquet: a checkpoint's
    rows take several times the room."""
    from recsift.operators.read_als import fit_folder

    spark, path = train.sparkSession, f"{fit_folder(train.sparkSession)}/ratings"
    rows = train.select(F.col("user_id").cast("int").alias("user_id"), F.col("item_id").cast("int").alias("item_id"),
                        F.col(spec.rating_col).cast("float").alias("rating")).dropna()
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def deal_both(ratings: DataFrame, parts: int) -> Dealt:
    return Dealt(ratings, *(deal(ratings, *ends, parts) for ends in (("item_id", "user_id"), ("user_id", "item_id"))))


def _solve(grams: np.ndarray, sums: np.ndarray, weights: np.ndarray, base: np.ndarray | None) -> np.ndarray:
    """Solutions of ``(gram + weight * I [+ base]) x = sum``, one per row."""
    rank = sums.shape[1]
    a, diagonal = grams.copy() if base is None else grams + base, np.arange(rank)
    a[:, diagonal, diagonal] += weights[:, None]
    try:
        return np.linalg.solve(a, sums[:, :, None])[:, :, 0].astype(np.float32)
    except np.linalg.LinAlgError:  # no regularisation and too few ratings: the smallest solution
        return np.stack([np.linalg.lstsq(m, s, rcond=None)[0] for m, s in zip(a, sums, strict=True)]).astype(np.float32)


def _weighed(rating: np.ndarray, implicit: bool, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per rating: its weight in the Gram matrix and in the sum, and whether it counts for the regularisation."""
    if not implicit:
        return np.ones_like(rating), rating, np.ones_like(rating)
    confidence = alpha * np.abs(rating)
    liked = (rating > 0).astype(np.float64)
    return confidence, liked * (1 + confidence), liked


def _table(ids: list, features: list, part: int, equations: list) -> pa.Table:
    return pa.table({"id": pa.array(ids, pa.int32()), "features": pa.array(features, pa.list_(pa.float32())),
                     "part": pa.array([part] * len(ids), pa.int32()), "equations": pa.array(equations, pa.binary())})


def _linked(table: pa.Table, to) -> pa.Table:
    """``table`` with the links ``to`` of its ids."""
    flat = np.frombuffer(to, dtype=np.uint8)
    return table.append_column("to", _rows_of(flat, len(flat) // max(1, len(table)), len(table)))


def _ship(rank: int, keys: list[int]):
    """mapInArrow function: factors ``(id, features, to)`` packed for the groups
    that need them, a few MB at once."""
    step = max(1, SHIP_FLOATS // rank)
    named = np.array(keys, dtype=np.int32)
    width = -(-len(keys) // 8)

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype("<i4")
            vectors = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)
            bits = np.frombuffer(b"".join(x.as_buffer() for x in batch.column("to")), dtype=np.uint8).reshape(-1, width)
            groups, of = np.nonzero(np.unpackbits(bits, axis=1)[:, :len(keys)].T)
            for lo in range(0, len(of), step):
                at, to = of[lo:lo + step], groups[lo:lo + step]
                starts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
                ends = np.r_[starts[1:], len(to)]
                told = [_shrink(ids[at[s:e]], vectors[at[s:e]]) for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(named[to[starts]]), pa.array((ends - starts).astype(np.int32))]
                    + [pa.array(list(x), pa.binary()) for x in zip(*told, strict=True)],
                    names=["grp", "n", "ids", "vectors", "high"])
    return run


def _shrink(ids: np.ndarray, vectors: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ids and vectors without loss in fewer bytes: the ids' gaps and each float's
    sign and exponent are compressed, the other three bytes have nothing to gain."""
    flat = vectors.astype("<f4").ravel().view(np.uint8).reshape(-1, 4)
    shrunk = lambda x: pa.compress(np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True)
    return shrunk(np.diff(ids, prepend=np.int32(0)).astype("<i4")), flat[:, :3].tobytes(), shrunk(flat[:, 3])


def _grow(sent: pa.Table, rank: int) -> pa.Table:
    """The ids and vectors of a group's rows of :func:`_shrink`."""
    total = sum(sent.column("n").to_pylist())
    ids, flat, done = np.empty(total, dtype="<i4"), np.empty((total * rank, 4), dtype=np.uint8), 0
    for batch in sent.to_batches():
        for n, gaps, low, high in zip(*(batch.column(c) for c in ("n", "ids", "vectors", "high")), strict=True):
            n = n.as_py()
            of = slice(done * rank, (done + n) * rank)
            ids[done:done + n] = np.cumsum(np.frombuffer(pa.decompress(gaps.as_buffer(), 4 * n, "zstd"), dtype="<i4"), dtype="<i4")
            flat[of, :3] = np.frombuffer(low.as_buffer(), dtype=np.uint8).reshape(-1, 3)
            flat[of, 3] = np.frombuffer(pa.decompress(high.as_buffer(), n * rank, "zstd"), dtype=np.uint8)
            done += n
    rows = [pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, x.nbytes], dtype=np.int32)), pa.py_buffer(x)])
            for x in (ids, flat)]
    return pa.table(rows, names=["ids", "vectors"])


def _received(run, rank: int):
    return lambda packed, sent: run(packed, _grow(sent, rank) if len(sent) else sent)


def _partial(vectors: np.ndarray, at: np.ndarray, in_gram: np.ndarray, in_sum: np.ndarray,
             rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and sum of one id's ratings, a slice of them at once."""
    gram, total = np.zeros((rank, rank)), np.zeros(rank)
    step = max(1, SOLVE_BYTES // (8 * rank))
    for lo in range(0, len(at), step):
        x = vectors[at[lo:lo + step]].astype(np.float64)
        gram += (x * in_gram[lo:lo + step, None]).T @ x
        total += in_sum[lo:lo + step] @ x
    return gram, total


def _solve_ids(solved: np.ndarray, whole: np.ndarray, starts: np.ndarray, lengths: np.ndarray, weights: np.ndarray,
               vectors: np.ndarray, at: np.ndarray, in_gram: np.ndarray, in_sum: np.ndarray, reg: float, implicit: bool,
               base: np.ndarray | None) -> None:
    """Solves the ids ``whole`` into their rows of ``solved``, those of equally many ratings together."""
    rank = solved.shape[1]
    whole = whole[np.argsort(lengths[whole], kind="stable")]
    cuts = np.flatnonzero(np.diff(lengths[whole])) + 1
    for same in np.split(whole, cuts) if len(whole) else ():
        n = int(lengths[same[0]])
        step = max(1, SOLVE_BYTES // (8 * (n * rank + min(n, rank) ** 2)))
        for lo in range(0, len(same), step):
            some = same[lo:lo + step]
            if n * rank * 8 > SOLVE_BYTES:
                rows = slice(int(starts[some[0]]), int(starts[some[0]]) + n)
                gram, total = _partial(vectors, at[rows], in_gram[rows], in_sum[rows], rank)
                solved[some] = _solve(gram[None], total[None], weights[some], base)
                continue
            rows = starts[some][:, None] + np.arange(n)
            x = np.take(vectors, np.take(at, rows), axis=0).astype(np.float64)
            across = x.transpose(0, 2, 1)
            if not implicit and reg > 0 and n < rank:
                duals = x @ across
                duals[:, np.arange(n), np.arange(n)] += weights[some][:, None]
                solved[some] = (across @ np.linalg.solve(duals, in_sum[rows][:, :, None]))[:, :, 0]
            else:
                weighed = (x * in_gram[rows][:, :, None]).transpose(0, 2, 1) if implicit else across
                solved[some] = _solve(weighed @ x, (across @ in_sum[rows][:, :, None])[:, :, 0], weights[some], base)


def _half(rank: int, reg: float, implicit: bool, alpha: float, base: np.ndarray | None):
    """Cogroup function of a group, one part after the other: solved factors of its
    ordinary ids, partial equations (Gram matrix, sum, count) of its hot ones.

    Ids with equally many ratings are solved together. An explicit id with fewer
    ratings ``n`` than the rank has its factors in the span of its ``n`` vectors
    ``X``: ``X'(XX' + reg n I)^-1 r`` is the same solution from ``n`` equations."""
    def run(packed: pa.Table, factors: pa.Table) -> pa.Table:
        if not len(packed) or not len(factors):
            return _linked(_table([], [], 0, []), b"")
        joined = lambda c, kind: np.concatenate(
            [np.frombuffer(x.as_buffer(), dtype=kind) for chunk in factors.column(c).chunks for x in chunk])
        ids, vectors = joined("ids", "<i4"), joined("vectors", "<f4").reshape(-1, rank)
        order = np.argsort(ids)
        return pa.concat_tables([one({c: packed.column(c)[i] for c in packed.column_names}, ids, vectors, order)
                                 for i in range(len(packed))])

    def one(packed: dict, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray) -> pa.Table:
        read = lambda c, kind: np.frombuffer(packed[c].as_buffer(), dtype=kind)
        dst, src, rating, hot = read("dst", "<i4"), read("src", "<i4"), read("rating", "<f4"), read("hot", "?")
        part = packed["part"].as_py()
        at = order[np.searchsorted(ids, src, sorter=order)]
        in_gram, in_sum, counted = _weighed(rating.astype(np.float64), implicit, alpha)
        starts = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]])
        lengths = np.diff(np.r_[starts, len(dst)])
        weights = reg * np.add.reduceat(counted, starts)
        solved = np.empty((len(starts), rank), dtype=np.float32)
        _solve_ids(solved, np.flatnonzero(~hot[starts]), starts, lengths, weights, vectors, at, in_gram, in_sum, reg, implicit, base)
        whole = np.flatnonzero(~hot[starts])  # as the links are
        out = _linked(pa.table({"id": pa.array(dst[starts[whole]], pa.int32()), "features": pa.ListArray.from_arrays(
            np.arange(0, (len(whole) + 1) * rank, rank, dtype=np.int32), solved[whole].ravel()),
            "part": pa.array(np.full(len(whole), part, dtype=np.int32)), "equations": pa.nulls(len(whole), pa.binary())}),
            packed["to"].as_buffer() if "to" in packed else b"")
        spread = np.flatnonzero(hot[starts])
        if not len(spread):
            return out
        told = []
        for j in spread.tolist():
            rows = slice(int(starts[j]), int(starts[j] + lengths[j]))
            gram, total = _partial(vectors, at[rows], in_gram[rows], in_sum[rows], rank)
            told.append(np.r_[gram.ravel(), total, counted[rows].sum()].tobytes())
        return pa.concat_tables([out, _linked(_table(dst[starts[spread]].tolist(), [None] * len(spread), part, told), b"")])
    return run


def _added(table: pa.Table) -> np.ndarray:
    total = None
    for b in table.column("equations").to_pylist():
        x = np.frombuffer(b)
        total = x.copy() if total is None else total + x
    return total


def _add(table: pa.Table) -> pa.Table:
    return _table([table.column("id")[0].as_py()], [None], table.column("part")[0].as_py(), [_added(table).tobytes()])


def _finish(rank: int, reg: float, base: np.ndarray | None):
    def run(table: pa.Table) -> pa.Table:
        x = _added(table)
        gram, total, n = x[:rank * rank].reshape(1, rank, rank), x[rank * rank:-1][None], x[-1:]
        return pa.table({"id": pa.array([table.column("id")[0].as_py()], pa.int32()),
                         "features": pa.array(list(_solve(gram, total, reg * n, base)), pa.list_(pa.float32()))})
    return run


def _gram_of(rank: int):
    """mapInArrow function: the sum of ``x x'`` over a task's factors."""
    def run(batches):
        total = np.zeros((rank, rank))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, rank).astype(np.float64)
            total += x.T @ x
        yield from _table([0], [None], 0, [total.tobytes()]).to_batches()
    return run


def _tree(rows: DataFrame, parts: int) -> DataFrame:
    """Equations ``(id, part, equations)`` summed until ``FAN_IN`` are left of an id at most."""
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")) \
            .groupBy("id", "part").applyInArrow(_add, _HALF)
    return rows


def _base(factors: DataFrame, rank: int) -> np.ndarray:
    """``Y'Y`` over all factors: one matrix, summed in a tree."""
    told = materialize_keys(factors.select("features").mapInArrow(_gram_of(rank), _HALF)
                            .withColumn("part", F.spark_partition_id()))
    parts = (told.agg(F.max("part")).first()[0] or 0) + 1
    rows = _tree(told, parts).select("equations").collect()  # FAN_IN rows at most
    return sum((np.frombuffer(r["equations"]).reshape(rank, rank) for r in rows), np.zeros((rank, rank)))


def _step(here: Grouped, other: Grouped, factors: DataFrame, spec) -> DataFrame:
    """One half-iteration: the factors ``(id, features, to)`` of ``here`` from those of ``other``."""
    base = _base(factors, spec.rank) if spec.implicit else None
    sent = factors.select("id", "features", "to").mapInArrow(_ship(spec.rank, here.keys), _SENT)
    out = here.packed.groupBy("grp").cogroup(sent.groupBy("grp")).applyInArrow(
        _received(_half(spec.rank, spec.reg, spec.implicit, spec.alpha, base), spec.rank), f"{_HALF}, to binary")
    if not here.side.n_hot:
        return materialize_keys(out.select("id", "features", "to"))
    out = materialize_keys(out)
    partial = _tree(out.filter("equations is not null").drop("to"), here.side.parts)
    every = F.lit(bytearray(b"\xff" * -(-len(other.keys) // 8)))  # a hot id is sent to all groups
    solved = partial.groupBy("id").applyInArrow(_finish(spec.rank, spec.reg, base), _FACTORS).withColumn("to", every)
    return materialize_keys(out.filter("equations is null").select("id", "features", "to").unionByName(solved))


def _unit(rank: int):
    """mapInArrow function: vectors divided by their lengths."""
    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, rank)
            x = x / np.sqrt(np.add.accumulate(x * x, axis=1)[:, -1:])  # added up in order
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, rank, dtype=np.int32), x.astype(np.float32).ravel())], names=["id", "features"])
    return run


def initial_factors(ids: DataFrame, rank: int, seed: int) -> DataFrame:
    """A random unit vector for each ``id``, from a hash of seed and id: the
    same for any layout and any number of parts."""
    def normal(j):
        u = [(F.pmod(F.xxhash64(F.lit(seed), "id", j, F.lit(i)), F.lit(1 << 53)) + 1) / float(1 << 53) for i in (0, 1)]
        return F.sqrt(-2 * F.log(u[0])) * F.cos(2 * math.pi * u[1])

    drawn = ids.select("id", F.transform(F.sequence(F.lit(1), F.lit(rank)), normal).alias("x"))
    return drawn.mapInArrow(_unit(rank), _FACTORS)


class Shared:
    """What fits of the same ratings share: the ratings, written once, and how they are dealt."""

    def __init__(self, train: DataFrame, spec, deal: Callable = deal_both):
        self.train, self.spec, self._deal = train, spec, deal
        self._kept, self._lock = {}, Lock()

    def _once(self, key, make: Callable):
        with self._lock:
            if key not in self._kept:
                self._kept[key] = make()
            return self._kept[key]

    def ratings(self) -> DataFrame:
        return self._once("ratings", lambda: rated(self.train, self.spec))

    def sizes(self) -> tuple[int, int, int]:
        """Ratings and, about, users and items."""
        ratings = self.ratings()
        return self._once("sizes", lambda: tuple(ratings.agg(
            F.count(F.lit(1)), F.approx_count_distinct("user_id"), F.approx_count_distinct("item_id")).first()))

    def dealt(self, parts: int) -> Dealt:
        ratings = self.ratings()
        return self._once(("dealt", parts), lambda: self._deal(ratings, parts))

    def held(self, groups: int, parts: int):
        """Both sides cached in groups (:class:`~recsift.operators.read_als.Held`)."""
        from recsift.operators.read_als import Held

        ratings, n = self.ratings(), self.sizes()[0]
        return self._once(("held", groups, parts), lambda: Held(ratings, groups, parts, n))

    def release(self) -> None:
        for kept in self._kept.values():
            if hasattr(kept, "release"):
                kept.release()


_SHARED: WeakKeyDictionary[DataFrame, Shared] = WeakKeyDictionary()


@contextmanager
def sharing(train: DataFrame, spec, deal: Callable = deal_both) -> Iterator[Shared]:
    """Inside, all fits of the frame ``train`` by the rating column of ``spec`` share what they can."""
    shared = _SHARED[train] = Shared(train, spec, deal)
    try:
        yield shared
    finally:
        del _SHARED[train]
        shared.release()


def _read_groups(n: int, ids: tuple[int, int], spec, cores: int) -> int:
    """Groups of a fit that reads its factors: ``spec.blocks`` at least, as even as the cores allow."""
    from recsift.operators.read_als import even

    side = Side(None, max(spec.blocks, n), 0)
    return even(max(spec.blocks, *(n_groups(side, other, n, spec) for other in ids)), cores)


def fit_gram_als(train: DataFrame, spec, start: DataFrame | None = None,
                 part_ratings: int = PART_RATINGS) -> FactorModel:
    """Fits ``train`` (``user_id``, ``item_id`` and the rating column of
    ``spec``); rows with a null in one of them do not count. ``start``: the user
    factors to begin with (:func:`initial_factors` by default). Several fits of
    the same frame deal its ratings once inside :func:`sharing`.

    The number of parts grows with the ratings, ``spec.blocks`` at least.
    Without any rating the factor tables are empty.
    """
    shared = _SHARED.get(train)
    if shared is not None and shared.spec.rating_col == spec.rating_col:
        return _fit(shared, spec, start, part_ratings)
    shared = Shared(train, spec)
    try:
        return _fit(shared, spec, start, part_ratings)
    finally:
        shared.release()


def _fit(shared: Shared, spec, start: DataFrame | None, part_ratings: int) -> FactorModel:
    from recsift.operators.read_als import fit_folder, iterate, readable

    ratings, (n, *sizes) = shared.ratings(), shared.sizes()
    spark, parts = ratings.sparkSession, n_parts(n, spec, part_ratings)
    ids = ratings.select(F.col("user_id").alias("id")).distinct()
    if spec.max_iter > 0 and sum(sizes) * spec.rank > READ_FLOATS and readable(checkpoint_dir(spark)):
        users = initial_factors(ids, spec.rank, spec.seed) if start is None else start.join(ids, "id", "left_semi")
        groups = _read_groups(n, tuple(sizes), spec, spark.sparkContext.defaultParallelism)
        return iterate(shared.held(groups, parts), users, spec, fit_folder(spark))
    dealt = shared.dealt(parts)
    users = start or initial_factors(ids.repartition(dealt.by_user.parts, "id"), spec.rank, spec.seed)
    if spec.max_iter < 1:
        return FactorModel(spec.rank, materialize_keys(users), materialize_keys(initial_factors(
            ratings.select(F.col("item_id").alias("id")).distinct(), spec.rank, spec.seed)))
    by_item, by_user, links = group_both(dealt, spec)
    try:
        users = materialize_keys(users.join(links, "id"))
        for _ in range(spec.max_iter):
            items = _step(by_item, by_user, users, spec)
            users = _step(by_user, by_item, items, spec)
    finally:
        for grouped in (by_item, by_user):
            grouped.packed.unpersist()
    return FactorModel(spec.rank, users.select("id", "features"), items.select("id", "features"))
