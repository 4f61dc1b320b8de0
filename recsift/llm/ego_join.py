"""Operator 3: embedding near-duplicates by an epsilon grid order join.

Unit vectors are turned onto the principal axes of all vectors; for cosine
``c`` two linked vectors lie within ``epsilon = sqrt(2 - 2c)`` of each other in
any of these dimensions. Vectors are sorted by label, then by grid cells of
side epsilon on the leading dimensions (the epsilon grid order) and cut into
sequence intervals. A pair of intervals is skipped when their boxes are more
than epsilon apart; a pair that is not is halved recursively, with the same
test at every level, down to small blocks that are compared exactly, as
cosines of the original vectors in double precision.

Equal vectors of a label are one row with a count throughout. No pair leaves
a task: it returns link counts per vector and a spanning forest of the links.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.components import components
from recsift.llm.links import Forest
from recsift.llm.rows import NULL_KEY, saved

COSINE = 0.98
# Leading dimensions in the grid order, and dimensions of the boxes.
GRID_DIMS = 4
BOX_DIMS = 16
# Vectors in a sequence interval, and in a block that is compared exactly.
INTERVAL = 512
LEAF = 64

_MOMENTS = "dim int, at int, value double"
_MOMENTS_ARROW = pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("value", pa.float64())])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch):
    dims = batch.column("dim").to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        x = _matrix(batch.column("vector").take(pa.array(at)), dim)
        yield dim, at, x


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _moments(batches):
    """Sums of a partition's unit vectors' products, of their components, and
    their number: ``dim * dim + dim + 1`` rows for each dimension that occurs."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, _, x in _by_dim(batch):
            u = _unit(x)
            part = np.concatenate([(u.T @ u).ravel(), u.sum(axis=0), [len(u)]])
            total[dim] = total.get(dim, 0) + part
    for dim, values in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(values), dim, dtype=np.int32)), pa.array(np.arange(len(values), dtype=np.int32)),
             pa.array(values)], schema=_MOMENTS_ARROW)


def principal_axes(vectors: DataFrame, most: int = BOX_DIMS) -> dict[int, np.ndarray]:
    """For each vector length, the ``most`` leading principal axes (columns).
    What reaches the driver is one matrix per length, whatever the rows."""
    rows = vectors.mapInArrow(_moments, _MOMENTS).groupBy("dim", "at").agg(F.sum("value").alias("value")).collect()
    sums: dict[int, np.ndarray] = {}
    for r in rows:
        sums.setdefault(r["dim"], np.zeros(r["dim"] ** 2 + r["dim"] + 1))[r["at"]] = r["value"]
    out = {}
    for dim, s in sums.items():
        mean = s[dim * dim:-1] / s[-1]
        _, axes = np.linalg.eigh(s[:dim * dim].reshape(dim, dim) / s[-1] - np.outer(mean, mean))
        out[dim] = axes[:, ::-1][:, :most]
    return out


def _project(axes: dict[int, np.ndarray], epsilon: float):
    def run(batches):
        for batch in batches:
            cells, places = [None] * batch.num_rows, [None] * batch.num_rows
            for dim, at, x in _by_dim(batch):
                p = _unit(x) @ axes[dim]
                c = np.floor(p[:, :GRID_DIMS] / epsilon).astype(np.int32)
                for i, cell, place in zip(at.tolist(), c.tolist(), p.tolist(), strict=True):
                    cells[i], places[i] = cell, place
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.float64()))],
                names=[*batch.schema.names, "cell", "place"])
    return run


_BLOCK = ("block string, dim int, label string, n int, lo array<double>, hi array<double>, c_lo int, c_hi int, "
          "ids array<long>, counts array<long>, vectors array<double>, places array<double>")
_BLOCK_ARROW = pa.schema([("block", pa.string()), ("dim", pa.int32()), ("label", pa.string()), ("n", pa.int32()),
                          ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                          ("c_lo", pa.int32()), ("c_hi", pa.int32()), ("ids", pa.list_(pa.int64())),
                          ("counts", pa.list_(pa.int64())), ("vectors", pa.list_(pa.float64())),
                          ("places", pa.list_(pa.float64()))])


def _cut(batches):
    """Sequence intervals of rows sorted in epsilon grid order."""
    from pyspark import TaskContext

    task, serial, rows = TaskContext.get().partitionId(), 0, []

    def block():
        nonlocal serial, rows
        serial += 1
        place = np.array([r["place"] for r in rows])
        first = rows[0]
        out = {"block": f"{task}-{serial}", "dim": first["dim"], "label": first["label"], "n": len(rows),
               "lo": place.min(axis=0).tolist(), "hi": place.max(axis=0).tolist(),
               "c_lo": min(r["cell"][0] for r in rows), "c_hi": max(r["cell"][0] for r in rows),
               "ids": [r["rep"] for r in rows], "counts": [r["n"] for r in rows],
               "vectors": np.concatenate([r["vector"] for r in rows]).tolist(), "places": place.ravel().tolist()}
        rows = []
        return pa.RecordBatch.from_pylist([out], schema=_BLOCK_ARROW)

    for batch in batches:
        for r in batch.to_pylist():
            if rows and (len(rows) == INTERVAL or r["label"] != rows[0]["label"] or r["dim"] != rows[0]["dim"]):
                yield block()
            rows.append(r)
    if rows:
        yield block()


class _Interval:
    def __init__(self, r: dict, side: str):
        self.ids = np.array(r[f"{side}ids"], dtype=np.int64)
        self.counts = np.array(r[f"{side}counts"], dtype=np.int64)
        self.unit = _unit(np.array(r[f"{side}vectors"]).reshape(len(self.ids), -1))
        self.place = np.array(r[f"{side}places"]).reshape(len(self.ids), -1)


def _far(p: np.ndarray, q: np.ndarray, epsilon: float) -> bool:
    """Whether two blocks' boxes are more than epsilon apart (with room for
    rounding: a block wrongly kept costs time only)."""
    gap = np.maximum(0, np.maximum(p.min(axis=0) - q.max(axis=0), q.min(axis=0) - p.max(axis=0)))
    return float((gap * gap).sum()) > (epsilon + 1e-9) ** 2


def join_intervals(a: _Interval, b: _Interval, same: bool, cosine: float, epsilon: float):
    """Links between two intervals: counts for the rows of each, and a
    spanning forest as pairs of positions (those of ``b`` after ``a``'s)."""
    na, nb = np.zeros(len(a.ids), dtype=np.int64), np.zeros(len(b.ids), dtype=np.int64)
    forest, links = Forest(len(a.ids) + (0 if same else len(b.ids))), []
    shift = 0 if same else len(a.ids)
    todo = [(0, len(a.ids), 0, len(b.ids))]
    while todo:
        i, j, k, m = todo.pop()
        if same and k < i:
            continue  # the mirror image of a pair that is done
        if _far(a.place[i:j], b.place[k:m], epsilon):
            continue
        if j - i > LEAF or m - k > LEAF:
            cut = lambda lo, hi: [(lo, (lo + hi) // 2), ((lo + hi) // 2, hi)] if hi - lo > LEAF else [(lo, hi)]
            todo += [(*x, *y) for x in cut(i, j) for y in cut(k, m)]
            continue
        hit = a.unit[i:j] @ b.unit[k:m].T >= cosine
        if same and i == k:
            hit = np.triu(hit, 1)
        r, c = np.nonzero(hit)
        np.add.at(na, i + r, b.counts[k + c])
        np.add.at(nb, k + c, a.counts[i + r])
        for x, y in zip((i + r).tolist(), (k + c + shift).tolist(), strict=True):
            if forest.join(x, y):
                links.append((x, y))
    return na, nb, links


def _join(cosine: float, epsilon: float):
    out = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                same = r["a_block"] == r["b_block"]
                a = _Interval(r, "a_")
                b = a if same else _Interval(r, "b_")
                na, nb, links = join_intervals(a, b, same, cosine, epsilon)
                ids = a.ids if same else np.concatenate([a.ids, b.ids])
                count = na + nb if same else np.concatenate([na, nb])
                got = np.flatnonzero(count)
                pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
                rep = np.concatenate([ids[got], ids[pairs[:, 0]]])
                links_ = np.concatenate([count[got], np.zeros(len(pairs), dtype=np.int64)])
                other = pa.array([None] * len(got) + ids[pairs[:, 1]].tolist(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(links_), other], schema=out)
    return run


def near_vectors(table: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` for every row of ``table``:
    vectors of one label (not null) and one length are linked when their
    cosine, in double precision, is at least ``cosine``.

    ``n_links``: other rows linked directly; ``component_id``: the smallest id
    reachable by links, itself included; ``kept``: the id is that smallest one.
    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing. Equal vectors of a label are linked. A null id comes
    last and is never kept. Repeated rows count one by one. Other columns are
    not read. An empty table gives an empty result.
    """
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    epsilon = math.sqrt(2 - 2 * cosine)
    v = F.col("vector")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col("label").isNotNull() & v.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("id"),
                        F.col(label_col).cast("string").alias("label"),
                        F.transform(F.col(vector_col), lambda x: x.cast("double") + 0.0).alias("vector"))
    rows = rows.withColumn("valid", F.coalesce(valid, F.lit(False)))
    # equal vectors: one row with a count; their group is named by its digest
    # (the label's length tells where it ends)
    digest = F.sha2(F.concat_ws(",", F.length("label").cast("string"), "label",
                                F.transform(v, lambda x: x.cast("string"))), 256)
    rows = rows.withColumn("key", F.when(F.col("valid"), digest))
    groups = (rows.filter("valid").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("n"),
              F.first("label").alias("label"), F.first("vector").alias("vector"))
              .withColumn("dim", F.size("vector")))
    # ids may repeat, so a group goes by a number made from its digest
    groups = saved(groups.withColumn("least", F.col("rep")).withColumn(
        "rep", F.conv(F.substring("key", 1, 15), 16, 10).cast("long")))
    axes = principal_axes(groups.select("dim", "vector"))
    shape = ("rep long, n long, label string, vector array<double>, dim int, cell array<int>, "
             "place array<double>")
    placed = saved(groups.select("rep", "n", "label", "vector", "dim").mapInArrow(_project(axes, epsilon), shape))
    keys = ["dim", "label", *[F.element_at("cell", F.least(F.lit(i + 1), F.size("cell"))) for i in range(GRID_DIMS)]]
    blocks = saved(placed.repartitionByRange(*keys, "rep").sortWithinPartitions(*keys, "rep")
                   .mapInArrow(_cut, _BLOCK))
    # pairs of intervals by shared cells of the first dimension, then by boxes
    box = blocks.select("block", "dim", "label", "lo", "hi", "c_lo", "c_hi")
    left = box.select("dim", "label", F.explode(F.sequence(F.col("c_lo") - 1, F.col("c_hi") + 1)).alias("c"),
                      F.col("block").alias("a"), F.col("lo").alias("a_lo"), F.col("hi").alias("a_hi"))
    right = box.select("dim", "label", F.explode(F.sequence("c_lo", "c_hi")).alias("c"),
                       F.col("block").alias("b"), F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
    gaps = F.zip_with(F.zip_with("a_lo", "b_hi", lambda x, y: x - y), F.zip_with("b_lo", "a_hi", lambda x, y: x - y),
                      lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = (left.join(right, ["dim", "label", "c"]).filter("a <= b").filter(apart <= (epsilon + 1e-9) ** 2)
             .select("a", "b").distinct())
    part = lambda side: blocks.select(*[F.col(c).alias(f"{side}_{c}")
                                        for c in ("block", "ids", "counts", "vectors", "places")])
    work = pairs.join(part("a"), F.col("a") == F.col("a_block")).join(part("b"), F.col("b") == F.col("b_block"))
    found = saved(work.drop("a", "b").mapInArrow(_join(cosine, epsilon), "rep long, links long, other long"))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reach = components(found.filter("other is not null"), "rep", "other")
    of = (groups.select("key", "rep", "least", "n").join(counts, "rep", "left")
          .join(reach, F.col("rep") == F.col("id"), "left").withColumn("comp", F.coalesce("component", "rep")))
    smallest = of.groupBy("comp").agg(F.min("least").alias("smallest"))
    of = of.join(smallest, "comp").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "smallest")
    out = rows.select("id", "key").join(of, "key", "left")
    own = F.coalesce("smallest", "id")
    null = lambda c: F.when(c != F.lit(NULL_KEY), c)
    return out.select(null(F.col("id")).alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      null(own).alias("component_id"),
                      F.coalesce(null(F.col("id")) == null(own), F.lit(False)).alias("kept"))
