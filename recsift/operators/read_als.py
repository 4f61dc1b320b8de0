"""Spark ML's alternating least squares for many ratings: factors are written once
and read, not shuffled.

Spark ML sends an id's factors to every block that has a rating of it, in each
half-iteration: with 16 blocks and 30 ratings an id, nearly 14 copies. Here the
ratings of one side are dealt to groups by their id once and stay cached there;
a half-iteration writes its factors once, packed in blocks, to the shared
checkpoint folder, and the next one's tasks read them there and keep those that
their group needs. What is shuffled and written follows ids and ratings; what is
read is a factor table for each group, so groups are few.

Start vectors, equations and order of the half-iterations are Spark ML's, so the
factors are those of ``ALS.fit`` up to rounding. An id's ratings are in one group, in the
order of the other id, so they do not depend on the number of groups either.
Fits of the same rows by several columns share the dealt ratings and the start.

The ``gram`` solver's large fits (:mod:`recsift.operators.gram_als`) run here too:
its hot ids are spread over all groups, whose partial equations are added up.

Factors that no later step reads are deleted, so a fit keeps two tables of them on disk.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import replace
from threading import Lock
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.operators.gram_als import (
    _FACTORS,
    _HALF,
    FAN_IN,
    HOT_SHARE,
    FactorModel,
    _add,
    _finish,
    _group_keys,
    _partial,
    _solve_ids,
    _tree,
    _weighed,
)
from recsift.operators.joins import attach_keys, materialize_keys
from recsift.session import checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not install the package

# Ratings in a group at most, about: 130 MB.
GROUP_RATINGS = 16_000_000
# Ratings that a task packs, or solves, at once.
SLICE_RATINGS = 2_000_000
# Floats of factors in a packed block.
BLOCK_FLOATS = 1 << 21

_SENT = "grp int, n int, dst binary, src binary, rating binary"
_GROUP = "grp int, dst binary, counts binary, need binary, at binary, rating binary"
_BLOCK = "n int, ids binary, vectors binary, gram binary"
_HOT = "id int, part int, equations binary"


def _small(x: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(x).tobytes(), "zstd", asbytes=True)


def _large(x: pa.Scalar, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(x.as_buffer(), n * np.dtype(kind).itemsize, "zstd"), dtype=kind)


def _pack(keys: list[int], columns: list[str]):
    """mapInArrow function: ratings ``(nth, dst, src, *columns)`` packed by group, some millions at once."""
    def packed(batches: list) -> pa.RecordBatch:
        read = lambda c: np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in batches])
        nth, dst, src, rating = read("nth"), read("dst"), read("src"), np.stack([read(c) for c in columns])
        order = np.lexsort((dst, nth))
        nth, dst, src, rating = nth[order], dst[order], src[order], rating[:, order]
        starts = np.flatnonzero(np.r_[True, nth[1:] != nth[:-1]])
        rows = []
        for s, e in zip(starts, np.r_[starts[1:], len(nth)], strict=True):
            rows.append({"grp": keys[nth[s]], "n": e - s, "src": _small(src[s:e].astype("<i4")),
                         "dst": _small(np.diff(dst[s:e], prepend=np.int32(0)).astype("<i4")),
                         "rating": _small(rating[:, s:e].astype("<f4"))})
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("grp", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("dst", "src", "rating"))]))

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += len(batch)
            if n >= SLICE_RATINGS:
                yield packed(held)
                held, n = [], 0
        if n:
            yield packed(held)
    return run


def _gather(width: int):
    """Group function: a group's ratings in one row, its ids ``dst`` with their ``counts``, the other
    side's ids ``need``, and for each rating the position ``at`` among those; ``rating`` has
    ``width`` columns one after the other."""
    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        def joined(c, kind, wide=1, of=lambda x: x):
            return np.concatenate([of(_large(x, kind, wide * n).reshape(wide, n))
                                   for x, n in zip(table.column(c), sizes, strict=True)], axis=1)

        dst = joined("dst", "<i4", of=lambda x: np.cumsum(x, axis=1, dtype="<i4"))[0]
        src, rating = joined("src", "<i4")[0], joined("rating", "<f4", width)
        order = np.lexsort((*rating, src, dst))
        dst, src, rating = dst[order], src[order], rating[:, order]
        starts = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]])
        need, at = np.unique(src, return_inverse=True)
        told = {"dst": dst[starts], "counts": np.diff(np.r_[starts, len(dst)]).astype("<i4"), "need": need,
                "at": at.astype("<i4"), "rating": rating}
        return pa.table({"grp": table.column("grp").slice(0, 1), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in told.items()}})
    return run


def n_groups(ratings: int, spec) -> int:
    return max(spec.blocks, -(-ratings // GROUP_RATINGS))


def even(groups: int, cores: int) -> int:
    """``groups``, or more where the last ones would leave cores without work."""
    return groups if groups <= cores else -(-groups // cores) * cores


def hot_ids(ratings: DataFrame, dst: str, n: int, parts: int) -> DataFrame:
    """Ids with more than a quarter of the ratings that one of ``parts`` has: four times ``parts`` at most."""
    per_id = ratings.groupBy(F.col(dst).alias("dst")).agg(F.count(F.lit(1)).alias("n"))
    return materialize_keys(per_id.filter(F.col("n") > n / parts / HOT_SHARE).select("dst", F.lit(True).alias("hot")))


def deal(ratings: DataFrame, dst: str, src: str, groups: int, hot: DataFrame | None = None) -> DataFrame:
    """The ratings by groups of ``dst``, one row and one task a group, cached; those of
    ``hot`` ids are spread over all groups by the other id. Every other column is a rating."""
    spark, columns = ratings.sparkSession, [c for c in ratings.columns if c not in (dst, src)]
    nth = F.pmod(F.xxhash64("dst"), F.lit(groups))
    rows = ratings.select(F.col(dst).alias("dst"), F.col(src).alias("src"), *columns)
    if hot is not None:
        rows = attach_keys(rows, hot, "dst", hot=False)
        nth = F.when(F.col("hot"), F.pmod(F.xxhash64("dst", "src"), F.lit(groups))).otherwise(nth)
    rows = rows.select(nth.cast("int").alias("nth"), "dst", "src", *columns)
    sent = rows.mapInArrow(_pack(_group_keys(spark, groups, groups), columns), _SENT)
    return sent.repartition(groups, "grp").groupBy("grp").applyInArrow(_gather(len(columns)), _GROUP).persist()


def _blocks(ids: np.ndarray, vectors: np.ndarray, with_gram: bool = True):
    """Factors as rows of :data:`_BLOCK`, each with the sum of its ``x x'`` (which implicit models need)."""
    step = max(1, BLOCK_FLOATS // max(1, vectors.shape[1]))
    for lo in range(0, len(ids), step):
        x = vectors[lo:lo + step]
        gram = b""
        if with_gram:
            wide = x.astype(np.float64)
            gram = (wide.T @ wide).tobytes()
        told = _small(np.diff(ids[lo:lo + step], prepend=np.int32(0)).astype("<i4")), x.astype("<f4").tobytes(), gram
        yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), *(pa.array([b], pa.binary()) for b in told)],
                                         names=["n", "ids", "vectors", "gram"])


def _unpacked(batch: pa.RecordBatch, rank: int):
    """Ids and vectors of each of a batch's blocks."""
    for n, gaps, flat in zip(*(batch.column(c) for c in ("n", "ids", "vectors")), strict=True):
        if n.is_valid:  # else a hot id's partial equations
            yield np.cumsum(_large(gaps, "<i4", n.as_py()), dtype="<i4"), np.frombuffer(flat.as_buffer(), dtype="<f4").reshape(-1, rank)


def _block_rows(rank: int, with_gram: bool = True):
    """mapInArrow function: rows ``(id, features)`` as blocks."""
    def run(batches):
        held = [b for b in batches if len(b)]
        if held:
            ids = np.concatenate([b.column("id").to_numpy(zero_copy_only=False) for b in held])
            vectors = np.concatenate([b.column("features").flatten().to_numpy(zero_copy_only=False) for b in held])
            order = np.argsort(ids)
            yield from _blocks(ids[order], vectors.reshape(-1, rank).astype(np.float32, copy=False)[order], with_gram)
    return run


def _rows_of_blocks(rank: int):
    """mapInArrow function: blocks as rows ``(id, features)``."""
    def run(batches):
        for batch in batches:
            for ids, x in _unpacked(batch, rank):
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.ListArray.from_arrays(
                    np.arange(0, x.size + 1, rank, dtype=np.int32), x.ravel())], names=["id", "features"])
    return run


def _read(files: list[str], need: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """The factors of the ids ``need`` (ascending) from the written blocks, and the sum of all ``x x'``."""
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSystem

    vectors, gram, found = np.empty((len(need), rank), dtype=np.float32), np.zeros((rank, rank)), 0
    for uri in files:
        fs, path = FileSystem.from_uri(uri)
        with fs.open_input_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=1, columns=["n", "ids", "vectors", "gram"]):
                for ids, x in _unpacked(batch, rank):
                    at = np.minimum(np.searchsorted(need, ids), len(need) - 1)
                    hit = np.flatnonzero(need[at] == ids)
                    vectors[at[hit]] = x if len(hit) == len(x) else np.take(x, hit, axis=0)
                    found += len(hit)
                if len(told := batch.column("gram")[0].as_buffer() or b""):
                    gram += np.frombuffer(told).reshape(rank, rank)
    if found != len(need):
        raise ValueError(f"{found} of {len(need)} factors found")
    return vectors, gram


def _half(files: list[str], spec, hot: np.ndarray | None = None):
    """mapInArrow function: the factors of a group's ids from the other side's in ``files``. Of ``hot``
    ids (ascending) it gives the group's partial equations (Gram matrix, sum, count)."""
    rank, reg, implicit, alpha = spec.rank, spec.reg, spec.implicit, spec.alpha

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                yield from one({c: batch.column(c)[i] for c in batch.schema.names})

    def one(row: dict):
        dst, counts, need, at = (np.frombuffer(row[c].as_buffer(), dtype="<i4") for c in ("dst", "counts", "need", "at"))
        rating = np.frombuffer(row["rating"].as_buffer(), dtype="<f4")
        vectors, gram = _read(files, need, rank)
        solved = np.empty((len(dst), rank), dtype=np.float32)
        spread = np.zeros(len(dst), dtype=bool) if hot is None else np.isin(dst, hot)
        told, ends = [], np.cumsum(counts, dtype=np.int64)
        lo = 0
        while lo < len(dst):  # a slice of the ids, one at least
            first = int(ends[lo] - counts[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, first + SLICE_RATINGS, side="right")))
            last = int(ends[hi - 1])
            in_gram, in_sum, counted = _weighed(rating[first:last].astype(np.float64), implicit, alpha)
            starts, lengths = ends[lo:hi] - counts[lo:hi] - first, counts[lo:hi].astype(np.int64)
            _solve_ids(solved[lo:hi], np.flatnonzero(~spread[lo:hi]), starts, lengths, reg * np.add.reduceat(counted, starts),
                       vectors, at[first:last], in_gram, in_sum, reg, implicit, gram if implicit else None)
            for j in np.flatnonzero(spread[lo:hi]).tolist():
                rows = slice(int(starts[j]), int(starts[j] + lengths[j]))
                part, total = _partial(vectors, at[first:last][rows], in_gram[rows], in_sum[rows], rank)
                told.append(np.r_[part.ravel(), total, counted[rows].sum()].tobytes())
            lo = hi
        if hot is None:
            yield from _blocks(dst, solved, implicit)
            return
        for block in _blocks(dst[~spread], solved[~spread], implicit):
            for name, kind in (("id", pa.int32()), ("part", pa.int32()), ("equations", pa.binary())):
                block = block.append_column(name, pa.nulls(1, kind))
            yield block
        if told:
            n = len(told)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary())] * 3, pa.array(dst[spread]),
                 pa.array(np.full(n, TaskContext.get().partitionId(), dtype=np.int32)), pa.array(told, pa.binary())],
                names=["n", "ids", "vectors", "gram", "id", "part", "equations"])
    return run


def readable(folder: str) -> bool:
    """Whether tasks can read the files of ``folder`` (a local or shared path, or a store that Arrow knows)."""
    from pyarrow.fs import FileSystem

    try:
        FileSystem.from_uri(folder)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def start_factors(users: DataFrame, spec) -> DataFrame:
    """Spark ML's first user factors. They follow the user ids of its blocks and the
    seed alone, so one rating a user gives them."""
    data = users.select(F.col("id").alias("user_id"), F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("item_id"),
                        F.lit(1.0).cast("float").alias(spec.rating_col))
    return replace(spec, max_iter=0).estimator().fit(data).userFactors


def _remove(spark, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)  # noqa: SLF001


class Held:
    """Ratings ``(user_id, item_id)`` and one or more rating columns, dealt to groups for both sides and cached
    until :meth:`release`; fits of any rank and regularisation may share them.
    ``parts``: ids that are hot for so many parts are spread over the groups."""

    def __init__(self, ratings: DataFrame, groups: int, parts: int | None = None, n: int = 0):
        self.ratings, self.groups = ratings, groups
        self.sides, self.hot = [], []
        for ends in (("item_id", "user_id"), ("user_id", "item_id")):
            hot = None if parts is None else hot_ids(ratings, ends[0], n, parts)
            ids = [] if hot is None else sorted(r["dst"] for r in hot.collect())  # four times ``parts`` at most
            self.hot.append(np.array(ids, dtype="<i4") if ids else None)
            self.sides.append(deal(ratings, *ends, groups, hot) if ids else deal(ratings, *ends, groups))

    def release(self) -> None:
        for side in self.sides:
            side.unpersist()

    def of(self, nth: int) -> list[DataFrame]:
        """Both sides with the ``nth`` rating column alone."""
        size = F.length("at")
        return [side.withColumn("rating", F.substring("rating", size * nth + 1, size)) for side in self.sides]


def _gram_sum(blocks: DataFrame, rank: int) -> np.ndarray:
    """The sum of the blocks' ``x x'``: one matrix, from ``FAN_IN`` at most."""
    told = blocks.filter("gram is not null").select(
        F.lit(0).alias("id"), F.lit(None).cast("array<float>").alias("features"),
        F.pmod(F.xxhash64("ids"), F.lit(FAN_IN)).cast("int").alias("part"), F.col("gram").alias("equations"))
    rows = told.groupBy("id", "part").applyInArrow(_add, _HALF).select("equations").collect()
    return sum((np.frombuffer(r["equations"]).reshape(rank, rank) for r in rows), np.zeros((rank, rank)))


def iterate(held: Held, users: DataFrame, spec, folder: str, nth: int | None = None) -> FactorModel:
    """The half-iterations from the factors ``users`` on, by the ``nth`` rating column of several. Two tables of factors are left in ``folder``."""
    spark, sides = users.sparkSession, held.sides if nth is None else held.of(nth)

    def written(rows: DataFrame, name: str) -> tuple[list[str], list[str]]:
        path = f"{folder}/{name}"
        rows.write.parquet(path)
        return [path], sorted(spark.read.schema(rows.schema).parquet(path).inputFiles())

    def half(n: int, other: list[str], files: list[str], name: str) -> tuple[list[str], list[str]]:
        packed, hot = sides[n], held.hot[n]
        if hot is None:
            return written(packed.mapInArrow(_half(files, spec), _BLOCK), name)
        paths, found = written(packed.mapInArrow(_half(files, spec, hot), f"{_BLOCK}, {_HOT}"), name)
        partial = spark.read.schema(f"{_BLOCK}, {_HOT}").parquet(*paths).filter("equations is not null") \
            .select("id", F.lit(None).cast("array<float>").alias("features"), "part", "equations")
        base = _gram_sum(spark.read.schema(_BLOCK).parquet(*other), spec.rank) if spec.implicit else None
        solved = _tree(partial, held.groups).groupBy("id").applyInArrow(_finish(spec.rank, spec.reg, base), _FACTORS)
        more, also = written(solved.mapInArrow(_block_rows(spec.rank, spec.implicit), _BLOCK), f"{name}-hot")
        return paths + more, found + also

    here = written(users.select("id", "features").mapInArrow(_block_rows(spec.rank, spec.implicit), _BLOCK), "start")
    for n in range(spec.max_iter):
        for side, name in enumerate(("items", "users")):
            before, here = here, half(side, *here, f"{name}-{n}")
            if side == 0 or n + 1 < spec.max_iter:  # the last items are a result
                for path in before[0]:
                    _remove(spark, path)
        items = before
    rows = lambda paths: spark.read.schema(_BLOCK).parquet(*paths).mapInArrow(_rows_of_blocks(spec.rank), _FACTORS)
    return FactorModel(spec.rank, rows(here[0]), rows(items[0]))


def fit_folder(spark) -> str:
    return f"{checkpoint_dir(spark)}/recsift-als/{uuid.uuid4().hex}"


class Shared:
    """What fits of the same rows by one or more rating columns share: the ratings, dealt and cached
    once, and Spark ML's start."""

    def __init__(self, train: DataFrame, columns: tuple[str, ...]):
        self.train, self.columns, self._lock = train, columns, Lock()
        self._held, self._starts = None, {}

    def held(self, spec) -> Held | None:
        """None where the columns have nulls, so that fits of one are of other rows than those of another."""
        with self._lock:
            if self._held is None:
                self._held = (self._deal(spec),)
                if self._held[0]:
                    self._fill(self._held[0], spec)
            return self._held[0]

    def _fill(self, held: Held, spec) -> None:
        """Caches both sides and takes the start side by side: each leaves cores without work."""
        run = inheritable_thread_target(self.train.sparkSession)
        with ThreadPoolExecutor(3) as pool:
            told = [pool.submit(run(side.count)) for side in held.sides] + [pool.submit(run(lambda: self._begin(held, spec)))]
        for one in told:
            one.result()

    def _deal(self, spec) -> Held | None:
        spark, path = self.train.sparkSession, f"{fit_folder(self.train.sparkSession)}/ratings"
        names = [f"rating_{n}" for n in range(len(self.columns))]
        rows = self.train.select(*[F.col(c).cast("int").alias(c) for c in ("user_id", "item_id")],
                                 *[F.col(c).cast("float").alias(n) for c, n in zip(self.columns, names, strict=True)])
        rows = rows.dropna(subset=["user_id", "item_id"]).dropna("all", subset=names)
        rows.write.parquet(path)
        ratings = spark.read.schema(rows.schema).parquet(path)
        n, *whole = ratings.agg(F.count(F.lit(1)), *[F.count(F.nullif(F.col(c), F.lit(float("nan")))) for c in names]).first()
        if any(x != n for x in whole):
            return None
        return Held(ratings, even(n_groups(n, spec), spark.sparkContext.defaultParallelism))

    def _begin(self, held: Held, spec) -> DataFrame:
        key = (spec.blocks, spec.rank, spec.seed)
        if key not in self._starts:
            spark, path = self.train.sparkSession, f"{fit_folder(self.train.sparkSession)}/start"
            start_factors(held.ratings.select(F.col("user_id").alias("id")).distinct(), spec).write.parquet(path)
            self._starts[key] = spark.read.schema(_FACTORS).parquet(path)
        return self._starts[key]

    def start(self, spec) -> DataFrame:
        """Start vectors, written once: they follow blocks, rank and seed, not the ratings."""
        with self._lock:
            return self._begin(self._held[0], spec)

    def release(self) -> None:
        if self._held and self._held[0]:
            self._held[0].release()


_SHARED: WeakKeyDictionary[DataFrame, Shared] = WeakKeyDictionary()


@contextmanager
def sharing(train: DataFrame, columns: tuple[str, ...]) -> Iterator[None]:
    """Inside, fits of the frame ``train`` by any of ``columns`` share what they can."""
    _SHARED[train] = shared = Shared(train, columns)
    try:
        yield
    finally:
        del _SHARED[train]
        shared.release()


def fit_read_als(train: DataFrame, spec) -> FactorModel:
    """Fits ``train`` (``user_id``, ``item_id`` and the rating column of ``spec``) as Spark ML does."""
    folder, shared = fit_folder(train.sparkSession), _SHARED.get(train)
    if shared and spec.rating_col in shared.columns and (held := shared.held(spec)):
        return iterate(held, shared.start(spec), spec, folder, shared.columns.index(spec.rating_col))
    shared = Shared(train, (spec.rating_col,))
    try:
        return iterate(shared.held(spec), shared.start(spec), spec, folder)
    finally:
        shared.release()
