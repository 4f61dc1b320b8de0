"""Operator 7: mixing sources by a curriculum that changes over time.

Every source has a weight schedule over training time 0 to 1. Its integral up
to a time, scaled to the source's target, is the source's cumulative token
demand; inverting it turns a document's offset among its source's tokens into
a training position. Documents are taken while their offset lies within the
demand, a second time where the target is larger than the source, and
range-sorted by position. DataFrame functions throughout.

Schedules are linear, ``1 + slope * (2t - 1)``, and fall, stay or rise. A hash
of the source's name picks one, so a source keeps its schedule whichever others
are there. Each integrates to 1, so schedules say when a source's tokens come,
weights how many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.prefix import running, spread_of
from recsift.llm.rows import name_columns, packed_once, row_hash, saved

WEIGHTS = (5, 2, 1)
SLOPES = (-0.5, 0.0, 0.5)
SHARE = 1.5
MOST = 2
SALT = 7  # of the hash that orders a source's documents


def word_count(text: Column) -> Column:
    """Maximal runs of characters other than 0x20 and 0x09-0x0D; null text: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def schedule(source: Column, slopes: tuple = SLOPES) -> Column:
    """Slope of a source's schedule, by its name (null: as the empty name)."""
    name = F.coalesce(source.cast("string"), F.lit(""))
    return F.element_at(F.array(*map(F.lit, slopes)), F.ascii(F.md5(name)) % len(slopes) + 1)


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """``(source, source_size, weight, slope, target)``, one row per source.

    Targets are ``min(most * source_size, level * weight)`` with the level at
    which they add up to ``share`` of all sizes: sources are filled in order
    of ``most * size / weight``, and the level is that of the first source
    that it does not fill. This is where resharing the excess ends. The windows hold
    one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # UTF-8 bytes in order are code points in order
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), rank + 1)
    per = per.select("source", "source_size", weight.cast("double").alias("weight"),
                     schedule(F.col("source"), slopes).cast("double").alias("slope"))
    cap = (F.col("source_size") * most).cast("double")
    fill = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) * share - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    per = per.withColumn("_level", left / weight_left)
    per = per.withColumn("_open", F.when(cap > F.col("_level") * F.col("weight"), F.col("_level")))
    level = F.first("_open", ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding,
                                                                     Window.unboundedFollowing))
    target = F.least(cap, F.coalesce(level * F.col("weight"), cap))
    return per.select("source", "source_size", "weight", "slope", target.alias("target"))


def position(share: Column, slope: Column) -> Column:
    """Time ``t`` at which a schedule has asked for ``share`` of its tokens:
    the inverse of ``(1 - slope) * t + slope * t ** 2``."""
    a, b = slope, 1 - slope
    return F.when(F.abs(a) < 1e-9, share).otherwise((F.sqrt(b * b + 4 * a * share) - b) / (2 * a))


def mix_sources(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), source_col: str = "source",
                text_col: str = "text", order_col: str = "doc_id", **targets) -> DataFrame:
    """One row per row of ``docs``: ``keep`` columns, ``size`` (words),
    ``source_size``, ``target``, ``copies`` (0, 1 or 2 times taken), ``taken``
    (words) and ``positions`` (training times, one per copy).

    In each source documents come in order of a hash of their id; a document
    is taken once for each pass in which more than half of it lies within the
    target, so a source's taken words differ from its target by half a
    document at most, and no document exceeds twice its size.

    Null source: a source of its own, last. Null text: size 0, taken by the
    same rule (its words are 0). Repeated ids and rows are ordered by text
    hash, then by the hash of the kept columns, and count one by one; rows equal in
    these are interchangeable. Extra columns
    are not read unless named in ``keep``. If all texts are empty, targets are
    0. An empty table gives an empty result.
    """
    packed = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept_columns"),
                         F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                         F.col(order_col).cast("string").alias("_id"), F.xxhash64(text_col).alias("_text"),
                         row_hash(docs.select(*keep)).alias("_rest"))
    packed = saved(packed)
    per = saved(source_targets(packed, **targets))
    n_rows = packed.count()
    placed = running(packed, ["source"], [F.col("_id"), F.col("_text"), F.col("_rest")], F.col("size"), "_at",
                     spread_of(SALT, "_id"), n_rows)
    named = per.withColumnRenamed("source", "_source")
    joined = placed.join(named, placed["source"].eqNullSafe(named["_source"]))
    size, whole, target = F.col("size"), F.col("source_size"), F.col("target")
    passes = F.array(*[F.col("_at") + whole * i for i in range(targets.get("most", MOST))])
    taken = F.filter(passes, lambda at: (at + size / 2.0 < target) | ((size == 0) & (at < target)))
    joined = joined.withColumn("_taken", taken)
    times = F.transform("_taken", lambda at: position(F.least(at / target, F.lit(1.0)), F.col("slope")))
    return joined.select(*[F.col(f"kept_columns.`{c}`").alias(c) for c in keep], "size", "source_size", "target",
                         F.size("_taken").alias("copies"), (F.size("_taken") * size).alias("taken"),
                         times.alias("positions"))


def sorted_by_position(rows: DataFrame, at: Column, *ties: Column) -> DataFrame:
    """Range-sorted by position, null positions last. ``ties`` spread rows of
    one position, above all those that are not taken, over tasks."""
    order = [at.asc_nulls_last(), *ties]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def training_positions(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **options) -> DataFrame:
    """``keep`` columns, ``copy`` (0 or 1) and ``position``: a row for each copy
    that the mix takes, range-sorted by position."""
    mixed = mix_sources(docs, keep=keep, **options)
    kept = [F.col(f"`{c}`") for c in keep]
    rows = mixed.select(*kept, F.posexplode("positions").alias("copy", "position")) \
        .withColumn("copy", F.col("copy").cast("long"))
    return sorted_by_position(rows, F.col("position"), F.xxhash64(*kept))


def _rows_at(docs: DataFrame, positions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs``, a row for each of the ``(_i, _d, _r, position)`` of its name, range-sorted by position."""
    packed, row = packed_once(docs, id_col, text_col)
    same = (F.col("_id_key") == F.col("_i")) & (F.col("_digest") == F.col("_d")) & (F.col("_row") == F.col("_r"))
    rows = packed.join(positions, same)
    ordered = sorted_by_position(rows.select(row, "position", "_i", "_d", "_r"), F.col("position"),
                                 F.xxhash64("_i", "_d", "_r"))
    return ordered.select(f"`{row}`.*")


def training_order(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                   **targets) -> DataFrame:
    """``docs`` as the mix takes them, all columns: a row for each copy, range-
    sorted by training position. Positions are worked out on rows without
    text, which then meets them by id, digest and the hash of the whole row.

    Null and repeated ids, null texts and sources: as in :func:`mix_sources`.
    Rows of one id and text that differ in another column are taken each by
    itself; equal rows are interchangeable. An empty table gives an empty result.
    """
    names = docs.select(*name_columns(id_col, text_col), row_hash(docs).alias("_row"),
                        F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    mixed = mix_sources(names, keep=("_id_key", "_digest", "_row"), order_col="_id_key", **targets)
    positions = mixed.select(F.col("_id_key").alias("_i"), F.col("_digest").alias("_d"), F.col("_row").alias("_r"),
                             F.explode("positions").alias("position"))
    return _rows_at(docs, positions, id_col, text_col)


def order_again(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                most: int = MOST) -> DataFrame:
    """Rows of :func:`training_order`, written and read in any order, range-
    sorted by training position again; all columns.

    Positions come from what is there: the taken words stand for a source's
    target (half a document apart at most), its name gives the slope, and a
    row's copies are its passes. A source that the mix took nothing of changes
    nothing for the others. Equal input rows that were each taken once count as
    two passes of one. Null and repeated ids, null texts and sources: as in
    :func:`mix_sources`. An empty table gives an empty result.
    """
    names = docs.select(*name_columns(id_col, text_col), row_hash(docs).alias("_row"),
                        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    copies = names.groupBy("_id_key", "_digest", "_row").agg(
        F.first("source").alias("source"), F.first("size").alias("size"), F.count("*").alias("n")) \
        .withColumn("copy", F.explode(F.expr(f"transform(sequence(0L, n - 1), i -> i % {most})"))) \
        .withColumn("_id", F.col("_id_key").cast("string"))
    copies = saved(copies.select("_id_key", "_digest", "_row", "_id", "source", "size", "copy"))
    per = saved(source_targets(copies)).select(F.col("source").alias("_source"), "source_size", "slope")
    passes = saved(copies.groupBy("source", "copy").agg(F.sum("size").alias("_words")))
    before = Window.partitionBy("source").orderBy("copy").rowsBetween(Window.unboundedPreceding, -1)
    starts = passes.select(F.col("source").alias("_s"), F.col("copy").alias("_c"),
                           F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_start"))
    placed = running(copies, ["source", "copy"], [F.col("_id"), F.col("_digest"), F.col("_row")], F.col("size"), "_at",
                     spread_of(SALT, "_id"), copies.count())
    placed = placed.join(per, placed["source"].eqNullSafe(per["_source"])).join(
        starts, placed["source"].eqNullSafe(starts["_s"]) & (placed["copy"] == starts["_c"]))
    share = F.when(F.col("source_size") > 0, (F.col("_start") + F.col("_at")) / F.col("source_size")) \
        .otherwise(F.lit(0.0))
    positions = placed.select(F.col("_id_key").alias("_i"), F.col("_digest").alias("_d"), F.col("_row").alias("_r"),
                              position(F.least(share, F.lit(1.0)), F.col("slope")).alias("position"))
    return _rows_at(docs, positions, id_col, text_col)
