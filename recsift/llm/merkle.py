"""Operator 11: a Merkle manifest whose trees lie in van Emde Boas order.

A tree of fan-out 16 is cut into aligned subtrees (blocks) of at most
``BLOCK`` levels of edges. A block holds all its nodes in one binary, in van
Emde Boas order: a tree of several levels is laid out as its upper half,
then the subtrees under that, each laid out alike. Where a node lies follows
from its depth and number by arithmetic (:func:`address`); building a block and
reading the siblings of a path use nothing else.

The leaves of a source are numbered by a range sort, each task making blocks
of consecutive leaves; the blocks' roots are the nodes of the next round, until
every source has one node, its subroot. The subroots, numbered by source, make
the last tree by the same rounds. Paths are read the other way: from the last
tree's blocks down, a block takes the path of its root and hands each of its
nodes theirs. So no task sees more than a block of ``16 ** BLOCK`` nodes and a path.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.rows import saved
from recsift.operators.joins import bounded

FAN = 16
# Levels of edges in a block: up to 4,096 nodes at its foot.
BLOCK = 3
# Blocks (140 KB each at most) that one task reads.
BLOCKS_IN_TASK = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 5


# ------------------------------------------------------------------ layout

def _width(levels: int) -> int:
    """Nodes of a complete tree of ``levels`` levels of nodes."""
    return (FAN ** levels - 1) // (FAN - 1)


def address(levels: int, depth: int, number: np.ndarray) -> np.ndarray:
    """Where the nodes ``number`` of a depth (0: the root) lie in the van Emde
    Boas order of a complete tree of ``levels`` levels of nodes."""
    number = np.asarray(number, dtype=np.int64)
    if levels <= 1:
        return np.zeros_like(number)
    top = levels // 2
    if depth < top:
        return address(top, depth, number)
    low = levels - top
    under = FAN ** (depth - top)  # nodes of this depth in one lower subtree
    return _width(top) + number // under * _width(low) + address(low, depth - top, number % under)


def _digest(parts: bytes) -> bytes:
    return hashlib.sha256(parts.hex().encode()).digest()


class Block:
    """Nodes of one aligned subtree; ``count[d]`` of them at depth ``d``."""

    def __init__(self, data: bytes | bytearray, n: int, height: int):
        self.data, self.height = data, height
        self.count = [n]
        for _ in range(height):
            self.count.insert(0, -(-self.count[0] // FAN))
        self.at = [address(height + 1, d, np.arange(c)) * 32 for d, c in enumerate(self.count)]

    @classmethod
    def build(cls, nodes: list[bytes], height: int) -> Block:
        """The block over these lowest nodes."""
        block = cls(b"", len(nodes), height)
        block.data = bytearray(max(int(a[-1]) for a in block.at) + 32)
        for at, node in zip(block.at[height].tolist(), nodes, strict=True):
            block.data[at:at + 32] = node
        for depth in range(height - 1, -1, -1):
            for i, at in enumerate(block.at[depth].tolist()):
                block.data[at:at + 32] = _digest(block.run(depth + 1, i))
        return block

    def run(self, depth: int, parent: int) -> bytes:
        """The children, at ``depth``, of node ``parent`` one level up."""
        where = self.at[depth][parent * FAN:parent * FAN + FAN].tolist()
        return b"".join(bytes(self.data[a:a + 32]) for a in where)

    def paths(self, above: bytes) -> list[bytes]:
        """For each run of lowest nodes: the run, and the path of its parent.

        A path is, per level upwards, a byte for the node's place in its run,
        one for the run's length and the run's digests.
        """
        paths = [above]
        for depth in range(1, self.height):
            paths = [_step(i % FAN, self.run(depth, i // FAN)) + paths[i // FAN] for i in range(self.count[depth])]
        return paths


def _step(place: int, run: bytes) -> bytes:
    return bytes([place, len(run) // 32]) + run


def _steps(path: bytes) -> list[tuple[int, str]]:
    """Place and run, as hex text, of every level of a path."""
    out, i = [], 0
    while i < len(path):
        n = 32 * path[i + 1]
        out.append((64 * path[i], path[i + 2:i + 2 + n].hex()))
        i += 2 + n
    return out


def fold(node: str, steps: list[tuple[int, str]]) -> str:
    """The root that a node and its siblings give."""
    for at, run in steps:
        node = hashlib.sha256((run[:at] + node + run[at + 64:]).encode()).hexdigest()
    return node


# ------------------------------------------------------------------ numbering

def _count_off(schema: pa.Schema):
    """Of the sorted rows of a task: ``_nth``, the number of the source among
    the task's, and ``_inside``, the row's number in it there."""
    def run(batches):
        nth, inside, last = -1, 0, ()
        for batch in batches:
            told = [[], []]
            for source in batch.column(batch.schema.get_field_index("source")).to_pylist():
                if (source,) != last:
                    nth, inside, last = nth + 1, 0, (source,)
                told[0].append(nth)
                told[1].append(inside)
                inside += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x, pa.int64()) for x in told)], schema=schema)
    return run


def numbered(leaves: DataFrame) -> tuple[DataFrame, int]:
    """``leaves`` with ``tree``, the number of the row's source (null first,
    then by UTF-8 bytes), ``at``, the row's number in it (by ``doc_id``, nulls
    last, then ``leaf``) and ``total``, the source's rows; and the number of sources.

    The rows are range-sorted, so a source of any size spreads over tasks,
    and counted off where they lie. What is shuffled after that has a row for
    each source of each task, and each window of it the rows of one source or task.
    """
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_last(), F.col("leaf"), F.col("_tie")]
    leaves = leaves.withColumn("_tie", F.monotonically_increasing_id())  # equal rows may be dealt apart
    leaves = leaves.repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie") \
        .withColumn("_task", F.spark_partition_id())
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in ("source", "leaf", "tampered")),
                        ("_task", pa.int32()), ("_nth", pa.int64()), ("_inside", pa.int64())])
    rows = saved(leaves.select("doc_id", "source", "leaf", "tampered", "_task").mapInArrow(
        _count_off(schema), "doc_id long, source string, leaf string, tampered string, _task int, _nth long, _inside long"))
    parts = rows.groupBy("source", "_task").agg(F.count(F.lit(1)).alias("_rows"), F.first("_nth").alias("_nth"))
    own = Window.partitionBy("source")
    before = own.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "source", F.col("_task").alias("_t"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(own).alias("total"), F.min(F.struct("_task", "_nth")).over(own).alias("_first"))
    parts = saved(parts.withColumnRenamed("source", "_source"))
    # sources in the order of the tasks that they begin in: as many windows' rows as begin in one
    heads = parts.filter("_t = _first._task").select("_source", F.col("_t").alias("_begun"), "_first._nth")
    told = heads.withColumn("_rank", F.row_number().over(Window.partitionBy("_begun").orderBy("_nth")) - 1)
    # one row per task
    tasks = heads.groupBy(F.col("_begun").alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("_b", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_sources"))
    trees = told.join(F.broadcast(tasks), F.col("_begun") == F.col("_b")).select(
        F.col("_source").alias("_name"), (F.col("_sources") + F.col("_rank")).alias("tree"))
    places, _ = bounded(parts.join(trees, F.col("_source").eqNullSafe(F.col("_name"))).drop("_name", "_first"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_task") == F.col("_t"))
    out = rows.join(places, same).select("doc_id", F.col("tree").cast("string").alias("tree"),
                                         (F.col("_start") + F.col("_inside")).alias("at"), "total", "leaf", "tampered")
    return saved(out), heads.count()


# ------------------------------------------------------------------ rounds

_BLOCK_SCHEMA = "tree string, block long, height int, total long, n int, data binary, root binary"
_BLOCK_ARROW = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("height", pa.int32()), ("total", pa.int64()),
                          ("n", pa.int32()), ("data", pa.binary()), ("root", pa.binary())])


def _build(table: pa.Table) -> pa.Table:
    """One block from its nodes ``(tree, at, total, node)``."""
    table = table.sort_by("at")
    first = table.slice(0, 1).to_pylist()[0]
    height, total = 0, first["total"]
    while height < BLOCK and FAN ** height < total:
        height += 1
    block = Block.build(table.column("node").to_pylist(), height)
    return pa.Table.from_pylist([{
        "tree": first["tree"], "block": first["at"] // FAN ** BLOCK, "height": height, "total": total,
        "n": len(table), "data": bytes(block.data), "root": bytes(block.data[:32])}], schema=_BLOCK_ARROW)


def _grow(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of every round over ``(tree, at, total, node)``, ``total`` being
    the tree's number of nodes. The last round has one block per tree."""
    rounds = []
    while True:
        blocks = saved(nodes.withColumn("block", F.floor(F.col("at") / FAN ** BLOCK))
                       .groupBy("tree", "block").applyInArrow(_build, _BLOCK_SCHEMA))
        n, most = blocks.agg(F.count(F.lit(1)), F.max("total")).first()
        rounds.append(blocks.coalesce(max(1, n // BLOCKS_IN_TASK)))
        if (most or 0) <= FAN ** BLOCK:
            return rounds
        # a tree that one block holds is done; its root is the only node left
        nodes = blocks.filter(F.col("total") > FAN ** BLOCK).select(
            "tree", F.col("block").alias("at"), F.ceil(F.col("total") / FAN ** BLOCK).alias("total"),
            F.col("root").alias("node"))


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """``(tree, root)``."""
    out = None
    for blocks in rounds:
        done = blocks.filter(F.col("total") <= FAN ** BLOCK).select("tree", "root")
        out = done if out is None else out.unionByName(done)
    return out


_HANDED = "tree string, at long, path binary, node binary, subroot binary"
_HANDED_ARROW = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("path", pa.binary()), ("node", pa.binary()),
                           ("subroot", pa.binary())])


def _hand_down(batches):
    """From blocks with the path of their root: each lowest node with its path."""
    for batch in batches:
        for r in batch.to_pylist():
            block, n = Block(r["data"], r["n"], r["height"]), r["n"]
            above = block.paths(r["path"])
            nodes = [bytes(block.data[a:a + 32]) for a in block.at[-1].tolist()]
            if r["height"]:
                runs = [block.run(r["height"], i) for i in range(len(above))]
                above = [_step(i % FAN, runs[i // FAN]) + above[i // FAN] for i in range(n)]
            at = np.arange(n, dtype=np.int64) + r["block"] * FAN ** BLOCK
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["tree"]] * n), pa.array(at), pa.array(above, pa.binary()), pa.array(nodes, pa.binary()),
                 pa.array([r["subroot"]] * n, pa.binary())], schema=_HANDED_ARROW)


def _handed(blocks: DataFrame) -> DataFrame:
    return blocks.select("tree", "block", "height", "n", "data", "path", "subroot").mapInArrow(_hand_down, _HANDED)


def _with_path(rounds: list[DataFrame], tops: DataFrame | None) -> DataFrame:
    """The first round's blocks with the path of their root, and the subroot of
    their tree. ``tops``: ``(tree, path, subroot)`` of the trees' roots; None for
    the last tree, whose root has no path and no subroot."""
    handed = None
    for blocks in reversed(rounds):
        done = blocks.filter(F.col("total") <= FAN ** BLOCK)
        if tops is None:
            done = done.select("*", F.lit(b"").alias("path"), F.lit(None).cast("binary").alias("subroot"))
        else:
            done = done.join(tops, "tree")
        if handed is not None:
            above = handed.select("tree", F.col("at").alias("block"), "path", "subroot")
            done = done.unionByName(blocks.join(above, ["tree", "block"]))
        if blocks is not rounds[0]:
            handed = _handed(done)
    return done


# ------------------------------------------------------------------ the manifest

def leaf(text: Column, fields: dict[str, Column]) -> Column:
    """A row's leaf: SHA-256 of its fields, each ``-`` if null, else its length
    in bytes, a colon and its value."""
    told = []
    for name, value in fields.items():
        value = text if name == "text" else value.cast("string")
        told.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*told), 256)


_OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(root: str):
    names = [f.split()[0] for f in _OUT.split(", ")]

    def run(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("at")
        r = blocks.to_pylist()[0]
        block = Block(r["data"], r["n"], r["height"])
        subroot = r["subroot"].hex()
        above = [_steps(p) for p in block.paths(r["path"])]
        higher = ["".join(run[:at] + run[at + 64:] for at, run in steps) for steps in above]
        runs = [block.run(r["height"], i).hex() for i in range(len(above))] if r["height"] else []
        out = {c: [] for c in names}
        for i, (doc, own, other) in enumerate(zip(*(leaves.column(c).to_pylist() for c in (
                "doc_id", "leaf", "tampered")), strict=True)):
            if runs:
                j, at = i // FAN, 64 * (i % FAN)
                proof = runs[j][:at] + runs[j][at + 64:] + higher[j]
                steps = [(at, runs[j]), *above[j]]
            else:  # a lone leaf is its subroot
                proof, steps = higher[0], above[0]
            folded = fold(other or own, steps)
            row = (doc, own, subroot, root, hashlib.sha256(proof.encode()).hexdigest(), folded, folded == root)
            for c, v in zip(names, row, strict=True):
                out[c].append(v)
        return pa.table({c: pa.array(v, {"doc_id": pa.int64(), "verified": pa.bool_()}.get(c, pa.string()))
                         for c, v in out.items()})
    return run


def merkle_manifest(docs: DataFrame) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Leaves ``(doc_id, tree, at, total, leaf, tampered)``, the blocks of
    the sources' trees and those of the tree over them, all written to the
    shared folder.

    ``docs`` has the columns :data:`FIELDS`. ``tree`` is the source's number
    (null first, then by UTF-8 bytes) in the last tree.
    """
    fields = {c: F.col(c) for c in FIELDS}
    text = F.col("text")
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string")) % TAMPER_EVERY == 0
    leaves = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                         leaf(text, fields).alias("leaf"), F.when(chosen, leaf(lower, fields)).alias("tampered"))
    leaves, n_sources = numbered(leaves)
    low = _grow(leaves.select("tree", "at", "total", F.unhex("leaf").alias("node")))
    high = _grow(_roots(low).select(F.lit("").alias("tree"), F.col("tree").cast("long").alias("at"),
                                    F.lit(n_sources).cast("long").alias("total"), F.col("root").alias("node")))
    return leaves, low, high


def prove(leaves: DataFrame, low: list[DataFrame], high: list[DataFrame]) -> DataFrame:
    """For each leaf of :func:`merkle_manifest`: ``(doc_id, leaf, subroot, root,
    proof_sha256, folded_root, verified)``. The proof are the siblings on the
    leaf's way to the root, read from the blocks; ``folded_root`` is what they give with
    the tampered leaf where there is one, else with the leaf.
    """
    last = _roots(high).first()
    if last is None:
        return leaves.sparkSession.createDataFrame([], _OUT)
    tops = _handed(_with_path(high, None)).select(
        F.col("at").cast("string").alias("tree"), "path", F.col("node").alias("subroot"))
    blocks = _with_path(low, saved(tops))
    cut = leaves.withColumn("block", F.floor(F.col("at") / FAN ** BLOCK))
    return cut.select("tree", "block", "at", "doc_id", "leaf", "tampered").groupBy("tree", "block").cogroup(
        blocks.select("tree", "block", "height", "n", "data", "path", "subroot").groupBy("tree", "block")
    ).applyInArrow(_prove(last["root"].hex()), _OUT)


def merkle_proofs(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` and every row's proof: :func:`prove` of
    :func:`merkle_manifest`, one row per row of ``docs``.

    Null ids come last in their source and are never tampered with; rows of one id
    come in order of their leaf, and equal rows are interchangeable. Null text
    is the leaf's ``-``, tampered or not. Columns other than :data:`FIELDS` do not
    count. An empty table gives an empty result.
    """
    return prove(*merkle_manifest(docs))
