"""Operator 6: quality by weak supervision.

Rules over counts of a text vote good, bad or abstain. Expectation-
maximisation over all documents estimates, without labels, how often good and
bad documents get each vote of each rule, and so each rule's accuracy; a
document's posterior probability of being good decides instead of all rules
having to pass. A vote pattern is one of ``3 ** rules``, so EM works on
pattern counts: one aggregate over the documents, whatever their number.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsift.llm.words import CHUNK_BYTES, U64, Chunk, chunks, mix, span_hashes, window_hashes

REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
          "n_lower", "n_exclaim", "n_bare", "n_ends", "n_doubled")

_SYMBOL, _UPPER, _LOWER, _EXCLAIM, _ALNUM, _HEAD, _END = (np.zeros(256, dtype=bool) for _ in range(7))
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER[65:91] = True
_LOWER[97:123] = True
_EXCLAIM[33] = True
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_HEAD[:128] = _HEAD[192:] = True  # bytes that begin a code point
_END[list(b".!?")] = True


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(flags, dtype=np.int64)]
    return total[off[1:]] - total[off[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur more than once, and which of these are not the first."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    later[order[1:][same]] = True
    return twice, later


def text_counts(chunk: Chunk) -> dict[str, np.ndarray]:
    """:data:`COUNTS` for every row of the chunk."""
    buf, off, word_off = chunk.buf, chunk.off, chunk.word_off
    starts, ends = chunk.starts, chunk.ends
    words = chunk.hashes()
    row = np.repeat(np.arange(chunk.n_rows), np.diff(word_off))
    out = {"n_words": np.diff(word_off)}
    for name, table in (("n_symbols", _SYMBOL), ("n_upper", _UPPER), ("n_lower", _LOWER), ("n_exclaim", _EXCLAIM)):
        out[name] = _per_row(table[buf], off)
    heads = np.r_[0, np.cumsum(_HEAD[buf], dtype=np.int64)]
    letters = np.r_[0, np.cumsum(_ALNUM[buf], dtype=np.int64)]
    chars = np.r_[0, np.cumsum(heads[ends] - heads[starts])]
    out["word_chars"] = chars[word_off[1:]] - chars[word_off[:-1]]
    out["n_bare"] = _per_row(letters[ends] == letters[starts], word_off)
    out["n_ends"] = _per_row(_END[buf[ends - 1]], word_off)
    doubled = np.zeros(len(words), dtype=bool)
    doubled[1:] = (words[1:] == words[:-1]) & (row[1:] == row[:-1])
    out["n_doubled"] = _per_row(doubled, word_off)
    # words in windows that occur again in the same row
    at = chunk.windows_inside(REPEAT_WINDOW)
    twice, _ = _repeated(window_hashes(words, REPEAT_WINDOW)[at] + mix(row[at].astype(U64) + U64(1)))
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[at[twice]] += 1
    edge[at[twice] + REPEAT_WINDOW] -= 1
    out["n_repeat_words"] = _per_row(np.cumsum(edge[:-1]) > 0, word_off)
    # lines with a word; every row begins a new line
    cut = np.flatnonzero(buf == 10)
    begin = np.unique(np.concatenate([off[:-1][np.diff(off) > 0], cut + 1]))
    begin = begin[begin < len(buf)]
    stop = np.r_[begin[1:], len(buf)]
    stop = stop - (buf[stop - 1] == 10) if len(begin) else stop[:0]
    full = np.searchsorted(starts, stop) > np.searchsorted(starts, begin)
    begin, stop = begin[full], stop[full]
    line_row = np.searchsorted(off, begin, "right") - 1
    _, later = _repeated(span_hashes(buf, begin, stop) + mix(line_row.astype(U64) + U64(1)))
    out["n_lines"] = np.bincount(line_row, minlength=chunk.n_rows)
    out["n_dup_lines"] = np.bincount(line_row[later], minlength=chunk.n_rows)
    return out


def _count(keep: int):
    def run(batches):
        for batch in batches:
            for chunk in chunks(batch.column(keep), CHUNK_BYTES // 2):
                counts = text_counts(chunk)
                part = batch.slice(chunk.rows.start, chunk.n_rows)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:keep], *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)],
                    names=[*part.schema.names[:keep], *COUNTS])
    return run


@dataclass(frozen=True)
class Rule:
    """Votes bad (-1) or good (+1) where the condition holds, else abstains (0)."""

    name: str
    bad: Column
    good: Column

    def vote(self) -> Column:
        sure = lambda c: F.coalesce(c, F.lit(False))
        return F.when(sure(self.bad), -1).when(sure(self.good), 1).otherwise(0)


def default_rules() -> list[Rule]:
    """Each rule knows one fault, whose absence says little: it votes bad or
    abstains. Only the sentence rule takes its sign as evidence of prose."""
    c = F.col
    words = F.greatest(c("n_words"), F.lit(1)).cast("double")
    lines = F.greatest(c("n_lines"), F.lit(1)).cast("double")
    letters = F.greatest(c("n_upper") + c("n_lower"), F.lit(1)).cast("double")
    some, never = c("n_words") > 0, F.lit(False)
    length = c("word_chars") / words
    return [
        Rule("long_enough", c("n_words") < MIN_WORDS, never),
        Rule("few_symbols", c("n_symbols") / words > 0.1, never),
        Rule("letters_not_symbols", some & (20 * c("n_symbols") > c("word_chars")), never),
        Rule("few_exclamations", c("n_exclaim") / words > 0.2, never),
        Rule("few_capitals", c("n_upper") / letters > 0.4, never),
        Rule("few_repeats", 100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * words, never),
        Rule("few_copied_lines", (c("n_lines") >= 4) & (c("n_dup_lines") / lines > 0.4), never),
        Rule("word_length", some & ((length < 2.5) | (length > 12)), never),
        Rule("words_not_marks", c("n_bare") / words > 0.2, never),
        Rule("sentences", (c("n_words") >= 100) & (c("n_ends") / words < 0.005),
             (c("n_ends") / words >= 0.01) & (c("n_ends") / words <= 0.34)),
        Rule("not_doubled", c("n_doubled") / words > 0.2, never),
    ]


@dataclass(frozen=True)
class LabelModel:
    """``prior``: share of good documents. ``table[class, rule, vote + 1]``:
    probability of each vote for bad (0) and good (1) documents."""

    prior: float
    table: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """P(good) for vote patterns ``(m, rules)`` of -1, 0, 1."""
        picked = np.log(self.table)[:, np.arange(votes.shape[1]), votes + 1].sum(axis=2)
        score = picked + np.log([[1 - self.prior], [self.prior]])
        return 1 / (1 + np.exp(np.clip(score[0] - score[1], -700, 700)))

    def accuracies(self) -> np.ndarray:
        """P(vote is right | no abstention) of every rule."""
        share = np.array([1 - self.prior, self.prior])
        right = share[0] * self.table[0, :, 0] + share[1] * self.table[1, :, 2]
        voted = (share[:, None] * (self.table[:, :, 0] + self.table[:, :, 2])).sum(axis=0)
        return right / np.maximum(voted, 1e-12)


def fit_label_model(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> LabelModel:
    """Expectation-maximisation on vote patterns and their counts. It starts
    from votes that are right nine times in ten, a bad one counting twice; half a
    document's weight is added to each cell, so no vote becomes impossible."""
    rules = votes.shape[1]
    hit = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    bad, good = (votes < 0).sum(axis=1), (votes > 0).sum(axis=1)
    p = 1 / (1 + np.exp(np.clip(math.log(9) * (2 * bad - good - 0.5), -50, 50)))
    model = None
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        table = np.einsum("cm,mrv->crv", weight, hit) + 0.5
        table /= table.sum(axis=2, keepdims=True)
        prior = float((weight[1].sum() + 0.5) / (counts.sum() + 1))
        model = LabelModel(prior, table)
        new = model.posterior(votes)
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return model if model is not None else LabelModel(0.5, np.full((2, rules, 3), 1 / 3))


def score_quality(docs: DataFrame, rules: list[Rule] | None = None, threshold: float = 0.5,
                  keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, :data:`COUNTS`, ``p_good``, ``base_failed`` and
    ``kept`` for every row of ``docs``.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in
    8-word windows that occur twice in the text; such rows are not kept. The
    others are kept if their posterior is at least ``threshold``. Null or
    empty text: all counts 0, failed. Ties in votes share a posterior. Rows
    count one by one, so null and repeated ids need no rule; a column of
    ``keep`` may have any name. An empty table gives an empty result.
    """
    rules = rules or default_rules()
    text = F.col(text_col).alias("text")
    code = sum(((rule.vote() + 1) * 3 ** i for i, rule in enumerate(rules)), F.lit(0)).cast("int")
    columns = ", ".join(f"{c} long" for c in COUNTS)
    # the texts are read twice: cheaper than writing rows that may hold them
    patterns_of = docs.select(text).mapInArrow(_count(0), columns).select(code.alias("pattern"))
    # one row for each vote pattern that occurs: at most 3 ** rules, whatever the input
    seen = patterns_of.groupBy("pattern").count().collect()
    packed = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept_columns"), text)
    counted = packed.mapInArrow(
        _count(1), f"kept_columns {packed.schema['kept_columns'].dataType.simpleString()}, {columns}"
    ).withColumn("pattern", code)
    patterns = np.array([r["pattern"] for r in seen], dtype=np.int64)
    votes = patterns[:, None] // 3 ** np.arange(len(rules)) % 3 - 1
    model = fit_label_model(votes, np.array([r["count"] for r in seen], dtype=float)) if seen else None
    p = model.posterior(votes).tolist() if seen else []
    table = docs.sparkSession.createDataFrame(list(zip(patterns.tolist(), p, strict=True)),
                                              "pattern int, p_good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = counted.join(F.broadcast(table), "pattern").withColumn("base_failed", failed)
    return scored.select(*[F.col(f"kept_columns.`{c}`").alias(c) for c in keep], *COUNTS, "p_good", "base_failed",
                         (~F.col("base_failed") & (F.col("p_good") >= threshold)).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that :func:`score_quality` keeps, all columns."""
    spare = "".join(docs.columns) + "_"  # a name that no column has
    scored = score_quality(docs.select(F.struct("*").alias(spare), text_col), keep=(spare,),
                           text_col=text_col, **options)
    return scored.filter("kept").select(f"`{spare}`.*")
