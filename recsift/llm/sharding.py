"""Operator 8: shards along a Hilbert curve.

Size, language and source of every document are quantised to 32 steps each;
the cell's index on the Hilbert curve orders the documents, so neighbours in
the order are alike in all three, and the order is cut into runs of equal
length. A filter on any of the dimensions then needs few shards' files.
DataFrame functions throughout. Law: ``rows``, counts at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.prefix import running, spread_of
from recsift.llm.rows import saved

SHARDS = 40
BITS = 5
SALT = 8  # of the hash that orders the documents of a cell


def _rotate(x: int, by: int, n: int) -> int:
    by %= n
    return (x << by | x >> (n - by)) & ((1 << n) - 1)


def _steps(n: int) -> tuple[list[int], list[int], list[int]]:
    """For each of the ``2 ** n`` sub-cubes in curve order: its Gray code's
    inverse table, entry corner and direction (by rule, any dimension)."""
    size = 1 << n
    gray = [i ^ i >> 1 for i in range(size)]
    inverse = [gray.index(i) for i in range(size)]
    entry = [0] + [gray[2 * ((i - 1) // 2)] for i in range(1, size)]
    trailing = [((i ^ i + 1) + 1).bit_length() - 2 for i in range(size)]  # ones at i's end
    direction = [0] + [trailing[i - 1] % n if i % 2 == 0 else trailing[i] % n for i in range(1, size)]
    return inverse, entry, direction


def curve_tables(n: int) -> tuple[list[int], list[int], list[int]]:
    """For each (direction, corner of the frame): its place on the curve; for
    each (direction, place): the turn of the next corner, the next direction."""
    inverse, entry, direction = _steps(n)
    every = [(d, x) for d in range(n) for x in range(1 << n)]
    return ([inverse[_rotate(x, n - (d + 1), n)] for d, x in every],
            [_rotate(entry[x], d + 1, n) for d, x in every], [(d + direction[x] + 1) % n for d, x in every])


def hilbert_index(dims: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell with coordinates below ``2 ** bits``.

    One step per bit, from the highest: the sub-cube is turned into the
    curve's own frame (corner ``e``, direction ``d``), its place there is
    three bits of the index, and the frame of the next step follows from it.
    """
    n = len(dims)
    mask = (1 << n) - 1
    table = lambda values: F.array(*[F.lit(v) for v in values])
    flat_place, flat_turn, flat_direction = map(table, curve_tables(n))
    coordinates = F.array(*[d.cast("int") for d in dims])
    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))

    def step(acc: Column, bit: Column) -> Column:
        label = F.aggregate(F.transform(coordinates, lambda x, i: F.call_function(
            "shiftleft", F.call_function("shiftright", x, bit).bitwiseAND(F.lit(1)), i)), F.lit(0),
            lambda a, b: a.bitwiseOR(b))
        w = F.element_at(flat_place, acc["d"] * (mask + 1) + label.bitwiseXOR(acc["e"]) + 1)
        at = acc["d"] * (mask + 1) + w + 1
        return F.struct((acc["h"] * (mask + 1) + w).alias("h"),
                        acc["e"].bitwiseXOR(F.element_at(flat_turn, at)).alias("e"),
                        F.element_at(flat_direction, at).alias("d"))

    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda acc: acc["h"])


def _quantised(cells: DataFrame, name: str, steps: int) -> DataFrame:
    """``(name, q_name)``: values in order, null last, at the step in which the
    middle of their rows falls. The windows hold one row per value."""
    per = cells.groupBy(name).agg(F.sum("n").alias("n"))
    before = Window.orderBy(F.col(name).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("n") / 2
    step = F.least(F.floor(middle / F.sum("n").over(Window.partitionBy()) * steps), F.lit(steps - 1))
    return per.select(F.col(name).alias(f"_{name}"), step.cast("int").alias(f"q_{name}"))


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, keep: tuple[str, ...] = ("doc_id",),
                   text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                   order_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: ``keep`` columns, ``size`` (UTF-8 bytes plus
    16), ``text_crc32``, ``hilbert``, ``law`` ('rows'), ``shard`` and ``slot``
    (place in the shard, gapless from 0).

    Shards are runs of the order (curve index, hash of the id, id, text hash),
    their counts at most one apart; with fewer rows than shards some are
    empty. Null text: no bytes, the checksum of no bytes. Null language or
    source: a value of its own, last. Repeated ids and rows get slots of their
    own; equal rows are interchangeable. Extra columns are not read unless
    named in ``keep``. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept_columns"),
                       (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       F.col(order_col).cast("string").alias("_id"), F.xxhash64(text).alias("_text"))
    # sizes in eight steps to a doubling, before their own quantiles: the bit
    # length and the three bits after the first
    top = F.length(F.bin("size")) - 1
    step = F.call_function("shiftright", F.col("size"), top - 3).bitwiseAND(F.lit(7).cast("long"))
    rows = saved(rows.withColumn("volume", (top * 8 + step).cast("int")))
    cells = saved(rows.groupBy("volume", "lang", "source").agg(F.count("*").alias("n")))
    named = cells
    for name in ("volume", "lang", "source"):
        q = _quantised(cells, name, 1 << bits)
        named = named.join(q, named[name].eqNullSafe(q[f"_{name}"])).drop(f"_{name}")
    named = named.withColumn("hilbert", hilbert_index([F.col(f"q_{x}") for x in ("volume", "lang", "source")], bits))
    per = named.groupBy("hilbert").agg(F.sum("n").alias("n"))  # at most 2 ** (3 * bits) rows
    before = Window.orderBy("hilbert").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select(F.col("hilbert").alias("_h"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    of_cell = named.join(starts, F.col("hilbert") == F.col("_h")).select(
        F.col("volume").alias("_v"), F.col("lang").alias("_l"), F.col("source").alias("_s"), "hilbert", "_first")
    of_cell = saved(of_cell)
    placed = rows.join(of_cell, rows["volume"].eqNullSafe(of_cell["_v"]) & rows["lang"].eqNullSafe(of_cell["_l"])
                       & rows["source"].eqNullSafe(of_cell["_s"])).drop("_v", "_l", "_s")
    total = rows.count()
    ranked = running(placed, ["hilbert"], [F.col("_id"), F.col("_text")], F.lit(1).cast("long"), "_at",
                     spread_of(SALT, "_id"), total)
    rank = F.col("_first") + F.col("_at")
    # the first `more` shards have one row more than the others
    few, more = total // shards, total % shards
    cut = more * (few + 1)
    shard = F.when(rank < cut, F.floor(rank / (few + 1))).otherwise(
        more + F.floor((rank - cut) / max(few, 1))).cast("int")
    slot = F.when(rank < cut, rank % (few + 1)).otherwise((rank - cut) % max(few, 1)).cast("long")
    return ranked.select(*[F.col(f"kept_columns.`{c}`").alias(c) for c in keep], "size", "text_crc32", "hilbert",
                         F.lit("rows").alias("law"), shard.alias("shard"), slot.alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, **options) -> None:
    """``docs`` as Parquet, a folder for each shard, in the order of its slots."""
    spare = "".join(docs.columns) + "_"  # a name that no column has
    view = docs.select(F.struct("*").alias(spare), "text", "lang", "source", "doc_id")
    placed = hilbert_shards(view, shards, keep=(spare,), **options)
    (placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot")
     .select(F.col("shard").alias("_shard"), f"`{spare}`.*").write.partitionBy("_shard").parquet(path))
