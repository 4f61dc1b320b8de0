"""Substring dedup, n-gram Jaccard join and components against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from brute import SF001
from recsift.llm import ngram_join
from recsift.llm.components import components
from recsift.llm.ngram_join import SIMILARITY, jaccard_join, keep_one, tile_links
from recsift.llm.substring_dedup import substring_dedup
from recsift.llm.words import Chunk, span_hashes, window_hashes


def _pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def _dedup(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup(df).collect()), key=str)


def test_substring_dedup_edges(spark):
    docs = brute.edge_docs(spark)
    assert _dedup(docs) == brute.substring_dedup(_pairs(docs))


def test_substring_dedup_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert _dedup(docs) == brute.substring_dedup(_pairs(docs))


def test_intervals_are_maximal_and_cover_what_went(spark):
    text = brute.prose(1, 50)
    docs = spark.createDataFrame([(1, text), (2, "a b " + text + " c"), (3, text + " " + text)], "doc_id long, text string")
    got = {r.doc_id: [list(x) for x in r.intervals] for r in substring_dedup(docs).collect()}
    assert got == {1: [], 2: [[2, 52]], 3: [[0, 100]]} or got == {1: [], 2: [[2, 52]], 3: [[0, 50], [50, 100]]}


def test_empty_tables(spark):
    none = brute.edge_docs(spark).limit(0)
    assert substring_dedup(none).collect() == [] and jaccard_join(none).collect() == []
    assert keep_one(none).collect() == [] and keep_one(none).columns == none.columns


def _joined(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(df).collect()), key=str)


def test_jaccard_edges(spark):
    docs = brute.edge_docs(spark)
    assert _joined(docs) == brute.jaccard_join(_pairs(docs))


def test_jaccard_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert _joined(docs) == brute.jaccard_join(_pairs(docs))


def test_jaccard_chains_and_split_tiles(spark, monkeypatch):
    """A chain whose ends are unlike, sets at the border, tiles of three rows."""
    monkeypatch.setattr(ngram_join, "TILE_DOCS", 3)
    base, rng, rows = brute.prose(1, 200).split(), random.Random(5), []
    for i in range(60):
        w = base[i * 3:i * 3 + 60] if i < 30 else [x if rng.random() > 0.02 else f"n{rng.random()}" for x in base[:90]]
        rows.append((100 - i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _joined(docs) == brute.jaccard_join(rows)


@pytest.mark.parametrize(("leaders", "bridges", "left"), [(0, 0, (500, 600)), (8, 0, (0, 20)), (8, 12, (0, 612))])
def test_large_groups_meet_leaders_first(spark, monkeypatch, leaders, bridges, left):
    """Two clusters of near copies: with leaders, no row is left for the tiles;
    without, all are, as with documents of other clusters that share prefix shingles."""
    monkeypatch.setattr(ngram_join, "TILE_DOCS", 32)
    monkeypatch.setattr(ngram_join, "LEADERS", leaders)
    rng, rows = random.Random(8), []
    bases = [brute.prose(s, 80).split() for s in (3, 4)]
    for i in range(600):
        w = list(bases[i % 2])
        w[rng.randrange(80)] = f"n{i // 3}"
        rows.append((i, " ".join(w)))
    for i in range(600, 600 + bridges):
        rows.append((i, " ".join(bases[0][:40] + bases[1][:40] + [f"m{i}"])))
    tiles, real = [], ngram_join._tiles
    monkeypatch.setattr(ngram_join, "_tiles", lambda m, sim: tiles.append(m.count()) or real(m, sim))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _joined(docs) == brute.jaccard_join(rows)
    assert left[0] <= tiles[0] <= left[1], tiles


def test_keep_one_keeps_the_smallest_and_all_columns(spark):
    docs = brute.edge_docs(spark)
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    sets = [brute.shingles(t) for _, t in rows]
    assert brute.jaccard_links(sets) == []  # no near copies are left
    want = {c for _, n, c in brute.jaccard_join(_pairs(docs)) if n}
    assert {i for i, t in rows if brute.words(t)} == want  # nor is a component lost
    assert sum(not brute.words(t) for _, t in rows) == 4  # without words: equal rows once


@pytest.mark.parametrize("seed", range(5))
def test_tiles_find_what_all_pairs_find(seed):
    rng = np.random.default_rng(seed)
    tokens = [np.unique(rng.choice(40, size=rng.integers(1, 30))).astype(np.int64) for _ in range(60)]
    n = np.array([len(t) + rng.integers(0, 3) for t in tokens])
    every = np.arange(60)
    want = []
    for i in range(60):
        for j in range(i):
            c = len(np.intersect1d(tokens[i], tokens[j]))
            if 100 * c >= 75 * (n[i] + n[j] - c):
                want.append((i, j))
    got = tile_links(n, tokens, every, every, SIMILARITY)
    assert brute.components(60, got) == brute.components(60, want)
    left, right = every[:25], every[25:]
    cross = [(i, j) for i, j in want if (i < 25) != (j < 25)]
    assert brute.components(60, tile_links(n, tokens, left, right, SIMILARITY)) == brute.components(60, cross)


def test_words_and_window_hashes():
    texts = ["a b  a", "", " x\ty\n", "é è", "a b"]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    c = Chunk(slice(0, 5), np.frombuffer(b"".join(raw), np.uint8), off)
    got = [bytes(c.buf[s:e]) for s, e in zip(c.starts, c.ends)]
    assert got == [w.encode() for t in texts for w in brute.words(t)]
    h = c.hashes()
    assert len(set(h.tolist())) == len(set(got))
    assert [dict(zip(got, h.tolist()))[w] for w in got] == h.tolist()
    assert c.windows_inside(2).tolist() == [0, 1, 3, 5, 7]
    w = window_hashes(h, 2)
    assert w[0] == w[7] and len(set(w[[0, 1, 3, 5]].tolist())) == 4
    assert span_hashes(np.frombuffer(b"AbaB", np.uint8), np.array([0, 2]), np.array([2, 4]), fold=True)[0] \
        != span_hashes(np.frombuffer(b"AbAB", np.uint8), np.array([0, 2]), np.array([2, 4]))[0]


def test_components_of_chains_stars_and_null_ends(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, x) for x in range(200, 260)] + [(7, 7), (None, 3), (3, 5)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r.id: r.component for r in components(df).collect()}
    want = {i: 100 for i in range(100, 141)} | {x: 3 for x in [3, 5, *range(200, 260)]}
    assert got == want
    assert components(df.filter(F.lit(False))).collect() == []


def test_edges_that_are_stars_take_no_step(spark, monkeypatch):
    from recsift.llm import components as module

    steps, saved = [], module.saved
    monkeypatch.setattr(module, "saved", lambda df: steps.append(1) or saved(df))
    stars = spark.createDataFrame([(5, 1), (7, 1), (9, 2)], "a long, b long")
    assert {r.id: r.component for r in components(stars).collect()} == {1: 1, 5: 1, 7: 1, 2: 2, 9: 2}
    assert len(steps) == 1  # the edges as written; a chain takes more
    components(spark.createDataFrame([(3, 2), (2, 1)], "a long, b long"))
    assert len(steps) > 2


def test_rows_are_dealt_to_tiles_without_their_tokens(spark):
    rows = spark.createDataFrame([(1, 1, 1, 40, 40), (2, 1, 2, 41, 40)], "class long, grp long, comp long, n long, held int")
    dealt = ngram_join._tiles(rows, SIMILARITY)
    assert "tokens" not in dealt.columns and dealt.count() >= 2
