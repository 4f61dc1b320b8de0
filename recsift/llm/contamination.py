"""Operator 12: benchmark passages found through a positional inverted index.

1. The benchmark's texts are cut into windows of words; equal windows are one
   query, and their words are the vocabulary.
2. One pass over the training texts writes the index: a posting ``(term, row,
   position)`` for each occurrence of a vocabulary word. Postings come out in
   the order of the texts, so writing them needs no shuffle.
3. A window's terms are ranked by the length of their lists. A window with an
   empty list is dead. Every posting of the rarest term, moved back by the
   term's offset, is a candidate start; it stays if the second rarest term's
   list has a posting at its own offset from there. The other lists are read
   for the rows that are left, and a start that all of them confirm is a match.

DataFrame functions throughout. Key sets are broadcast only behind a count of
their rows (:func:`recsift.operators.joins.bounded`), else joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.rows import id_of, keyed, saved
from recsift.operators.joins import bounded

WINDOW = 10
# Words stand between these: ASCII that is no letter or digit.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW = ["_k", "_sub"]
# The term that stands at the end of every text: its position is the number of words.
END = -1


def word_list(text: Column) -> Column:
    """A text's words, A-Z as a-z and other letters as they are; null text: none."""
    text = F.coalesce(text, F.lit(""))
    # on ASCII alone, lower() does the same, and faster
    folded = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(folded, BETWEEN), "")


def query_windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(win, n, offset, word)``, a row for each word of each different window,
    and ``(win, item)``, the items that hold it.

    A window is ``size`` consecutive words; a text of fewer words is one
    window, a text without words has none.
    """
    cut = items.select(F.col(id_col).cast("string").alias("item"), word_list(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = cut.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("words"))
    named = saved(cut.select("words").distinct().withColumn("win", F.monotonically_increasing_id()))
    members = saved(cut.join(named, "words").select("win", "item").distinct())
    lists = named.select("win", F.size("words").alias("n"), F.posexplode("words").alias("offset", "word"))
    return lists, members


def build_index(rows: DataFrame, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index of ``rows`` (``_k, _sub, text``) over the different ``words``
    (one column, ``word``): postings ``(_k, _sub, term, pos)`` with positions
    from 0, written once to the shared folder, and ``(term, word)``.

    Each row also has a posting of the term :data:`END` at its number of words.
    """
    terms = saved(words.select("word").distinct().withColumn("term", F.monotonically_increasing_id()))
    ends = terms.select("term", "word").unionByName(
        words.sparkSession.createDataFrame([(END, "")], "term long, word string"))
    vocabulary, _ = bounded(ends)
    told = rows.select(*_ROW, F.posexplode(F.concat(word_list(F.col("text")), F.array(F.lit("")))).alias("pos", "word"))
    return saved(told.join(vocabulary, "word").select(*_ROW, "term", "pos")), terms


def ranked_lists(index: DataFrame, terms: DataFrame, lists: DataFrame) -> DataFrame:
    """``(win, n, offset, term, rank)`` of the windows that can occur: rank 1
    is the term with the fewest postings. Windows have ``n`` rows here."""
    lengths = index.groupBy("term").agg(F.count(F.lit(1)).alias("held"))
    known = lists.join(terms, "word").join(lengths, "term")
    own = Window.partitionBy("win")
    known = known.withColumn("rank", F.row_number().over(own.orderBy("held", "offset"))) \
        .withColumn("_alive", F.count(F.lit(1)).over(own) == F.col("n"))
    return saved(known.filter("_alive").select("win", "n", "offset", "term", "rank"))


def _at(starts: DataFrame, lists: DataFrame) -> DataFrame:
    """Where the terms of ``lists`` must stand for the candidate starts."""
    lists, _ = bounded(lists.select("win", "offset", "term"))
    return starts.join(lists, "win").withColumn("pos", F.col("start") + F.col("offset")).drop("offset")


def phrase_matches(index: DataFrame, lists: DataFrame) -> DataFrame:
    """``(_k, _sub, start, n, win)``: every place where a window's words stand
    one after the other. ``lists`` is :func:`ranked_lists`' result."""
    lead, _ = bounded(lists.filter("rank = 1").select("win", "n", "offset", "term"))
    starts = index.join(lead, "term").select(*_ROW, (F.col("pos") - F.col("offset")).alias("start"), "win", "n") \
        .filter("start >= 0")
    second = lists.filter("rank = 2")
    its_terms, _ = bounded(second.select("term").distinct())
    pairs = saved(_at(starts.filter("n > 1"), second).join(
        index.join(its_terms, "term", "left_semi"), [*_ROW, "term", "pos"], "left_semi")
        .select(*_ROW, "start", "win", "n"))
    left = pairs.filter("n > 2")
    some, _ = bounded(left.select(*_ROW).distinct())
    rest = index.join(some, _ROW, "left_semi")
    place = [*_ROW, "start", "n", "win"]
    whole = _at(left, lists.filter("rank > 2")).join(rest, [*_ROW, "term", "pos"], "left_semi") \
        .groupBy(*place).agg(F.count(F.lit(1)).alias("_found")).filter("_found = n - 2")
    return whole.select(*place).unionByName(pairs.filter("n = 2").select(*place)) \
        .unionByName(starts.filter("n = 1").select(*place))


def proximity_matches(index: DataFrame, lists: DataFrame, within: int) -> DataFrame:
    """``(_k, _sub, pos, win)``: every place of a window's rarest term that has
    all other terms of the window, in any order, at most ``within`` words away.

    Lists meet by the ``within``-wide stretch that positions lie in and its two
    neighbours, so that a join on equal keys finds every posting in reach.
    """
    width = within + 1
    lead, _ = bounded(lists.filter("rank = 1").select("win", F.col("term").alias("rarest")))
    anchors = index.join(lead, F.col("term") == F.col("rarest")).select(*_ROW, F.col("pos").alias("anchor"), "win")
    others = lists.join(lead, "win").filter("term <> rarest").select("win", "term").distinct()
    wanted = others.groupBy("win").agg(F.count(F.lit(1)).alias("_wanted"))
    alone = anchors.join(bounded(wanted)[0], "win", "left_anti")
    at = anchors.join(bounded(others)[0], "win").withColumn(
        "stretch", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))),
                                         lambda i: F.floor(F.col("anchor") / width).cast("int") + i)))
    kept, _ = bounded(others.select("term").distinct())
    near = index.join(kept, "term", "left_semi").withColumn("stretch", F.floor(F.col("pos") / width).cast("int"))
    found = at.join(near, [*_ROW, "term", "stretch"]).filter(F.abs(F.col("pos") - F.col("anchor")) <= within) \
        .select(*_ROW, "anchor", "win", "term").distinct() \
        .groupBy(*_ROW, "anchor", "win").agg(F.count(F.lit(1)).alias("_found"))
    full = found.join(bounded(wanted)[0], "win").filter("_found = _wanted").select(*_ROW, "anchor", "win")
    return full.unionByName(alone.select(*_ROW, "anchor", "win")).withColumnRenamed("anchor", "pos")


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(id_col, n_words, n_hit, n_items, items)`` for every row of ``docs``:
    its words, those inside an occurrence of a window of ``items``, and the
    different items (as text, sorted) with such a window.

    Null text has no words. Null and repeated ids: rows of one id are told
    apart by their text, equal rows get the same result. Items that share a
    window all count; of a null item id the words are hit, but it is not listed.
    Extra columns are not read. Without documents, or without items, the
    result has no rows, or no hits.
    """
    rows, every_row = keyed(docs, id_col, text_col)
    lists, members = query_windows(items, size, item_col, item_text_col)
    index, terms = build_index(rows, lists)
    matches = saved(phrase_matches(index, ranked_lists(index, terms, lists)))
    spans = F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)
    hit = matches.select(*_ROW, F.explode(spans).alias("pos")).distinct() \
        .groupBy(*_ROW).agg(F.count(F.lit(1)).alias("n_hit"))
    held = matches.select(*_ROW, "win").distinct().join(members, "win").groupBy(*_ROW) \
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    words = index.filter(F.col("term") == END).select(*_ROW, F.col("pos").cast("long").alias("n_words"))
    out = words.join(hit.join(held, _ROW), _ROW, "left")
    none = F.array().cast("array<string>")
    return every_row(out.select(
        *_ROW, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", none).alias("items"))).select(
        id_of().cast(docs.schema[id_col].dataType).alias(id_col), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"), "items")
