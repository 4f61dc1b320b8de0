"""Merkle manifest, benchmark contamination, token alignment."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from brute import SF001
from recsift.llm import merkle
from recsift.llm.alignment import align_tokens, first_vocabulary, identity_map, second_vocabulary
from recsift.llm.contamination import (
    build_index,
    contamination,
    proximity_matches,
    query_windows,
    ranked_lists,
)
from recsift.llm.merkle import FIELDS, Block, address, merkle_manifest, merkle_proofs, prove
from recsift.llm.rows import keyed

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _fold_case(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ------------------------------------------------------------------ Merkle

def _leaf(row):
    told = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _hash("".join(told(row[c]) for c in FIELDS))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_hash("".join(out[-1][i:i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def _siblings(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 16 * 16
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + 16])))
        i //= 16
    return out


def proofs(rows):
    """Sorted result rows for rows given as dicts."""
    sources = sorted({r["source"] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in sources:
        own = sorted((r for r in rows if r["source"] == s),
                     key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, _leaf(r)))
        trees.append((own, _levels([_leaf(r) for r in own])))
    top = _levels([levels[-1][0] for _, levels in trees])
    root, out = top[-1][0], []
    for k, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            path = _siblings(levels, i) + _siblings(top, k)
            node = _leaf(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                node = _leaf({**r, "text": _fold_case(r["text"])})
            for left, right in path:
                node = _hash(left + node + right)
            proof = _hash("".join(a + b for a, b in path))
            out.append((r["doc_id"], _leaf(r), levels[-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_addresses_fill_the_tree_and_keep_subtrees_together(levels):
    at = [address(levels, d, np.arange(16 ** d)) for d in range(levels)]
    every = np.concatenate(at)
    assert len(every) == len(set(every.tolist())) == every.max() + 1
    assert at[0][0] == 0
    if levels > 1:  # a lower subtree is one run of addresses
        top, low = levels // 2, levels - levels // 2
        width = merkle._width(low)
        for d in range(top, levels):
            assert ((at[d] - merkle._width(top)) // width == np.arange(16 ** d) // 16 ** (d - top)).all()


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096])
def test_a_block_holds_every_level(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    levels = _levels([x.hex() for x in leaves])
    block = Block.build(leaves, len(levels) - 1)
    for depth, level in enumerate(reversed(levels)):
        held = [bytes(block.data[a:a + 32]).hex() for a in block.at[depth].tolist()]
        assert held == level


def test_proofs_on_edge_rows(spark):
    docs = brute.edge_docs(spark)
    got = sorted(map(tuple, merkle_proofs(docs).collect()), key=str)
    assert got == proofs([r.asDict() for r in docs.collect()])
    again = merkle_proofs(docs.repartition(5).drop("part"))
    assert got == sorted(map(tuple, again.collect()), key=str)


def test_proofs_of_an_empty_table_and_of_one_row(spark):
    docs = brute.edge_docs(spark)
    assert merkle_proofs(docs.limit(0)).collect() == []
    one = docs.filter("doc_id = 0")
    assert list(map(tuple, merkle_proofs(one).collect())) == proofs([r.asDict() for r in one.collect()])


def test_trees_of_several_rounds_and_many_sources(spark, monkeypatch):
    """Blocks of 16 nodes, so that few rows need blocks over blocks, in the last tree too."""
    monkeypatch.setattr(merkle, "BLOCK", 1)
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 700, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40))
        .alias("source"), F.lit("en").alias("lang"), F.col("id").alias("n_chars"), F.concat(F.lit("Text "), "id").alias("text"))
    got = merkle_proofs(docs).collect()
    assert sorted(map(tuple, got), key=str) == proofs([r.asDict() for r in docs.collect()])
    assert {r["verified"] for r in got} == {True, False}


def test_a_changed_block_changes_the_proofs(spark):
    leaves, low, high = merkle_manifest(spark.read.parquet(f"{SF001}/documents.parquet"))
    other = low[0].withColumn("data", F.expr("overlay(data placing unhex(repeat('00', 32)) from 33 for 32)"))
    # a leaf whose run holds the changed node no longer gives the root
    assert prove(leaves, low, high).filter("verified").count() > prove(leaves, [other, *low[1:]], high) \
        .filter("verified").count()


# ------------------------------------------------------------------ contamination

def _plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _fold_case(text or ""))


def contaminated(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = _plain_words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = _plain_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (of := windows.get(tuple(w[s:s + n]))) is not None:
                    hit.update(range(s, s + n))
                    found |= of
        listed = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(listed), listed))
    return sorted(out, key=str)


ITEMS = [(1, "One two THREE four five six seven eight nine ten eleven"), (2, "É-cole two"), (10, "single"), (3, None),
         (4, ""), (5, "... --"), (6, "the the the the the the the the the the the the"), (7, "never seen words here"),
         (8, "one two three four five six seven eight nine ten"), (8, "tail words"), (None, "no name item"),
         (9, "école"), (11, "É-cole two")]
TEXTS = ["one two three four five six seven eight nine ten eleven", "x One, two; three four five six seven eight nine ten!",
         "two three four five six seven eight nine ten eleven one", "É cole two", "é cole two", "a single word, single",
         "the " * 25, "words tail words", "", None, "no name item", "École école", "one two three four five six seven",
         "ten one two three four five six seven eight nine ten eleven " * 3, "single"]


def _item_table(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, word string, win long")


@pytest.mark.parametrize("bound", ["2000000", "0"])
def test_contamination_on_edge_rows(spark, bound):
    spark.conf.set("recsift.broadcast.maxRows", bound)
    try:
        rows = [(r[0], r[1]) for r in brute.edge_rows()] + [(100 + i, t) for i, t in enumerate(TEXTS)] + \
            [(200, TEXTS[0]), (200, TEXTS[0]), (200, TEXTS[5]), (None, TEXTS[1])]
        docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows],
                                     "doc_id long, text string, word string, term long, pos int").repartition(3)
        got = contamination(docs, _item_table(spark, ITEMS))
        assert sorted(map(tuple, got.collect()), key=str) == contaminated(rows, ITEMS)
        assert contamination(docs.limit(0), _item_table(spark, ITEMS)).collect() == []
        clean = contamination(docs, _item_table(spark, ITEMS).limit(0)).collect()
        assert len(clean) == len(rows) and not any(r["n_hit"] or r["n_items"] for r in clean)
    finally:
        spark.conf.unset("recsift.broadcast.maxRows")


def test_proximity(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 12, 60)) for _ in range(20)]
    items = [(1, "w1 w2 w3"), (2, "w4 w4 w5"), (3, "w6"), (4, "w7 w8 nowhere")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lists, members = query_windows(_item_table(spark, items))
    index, terms = build_index(keyed(docs)[0], lists)
    ranked = ranked_lists(index, terms, lists)
    for within in (1, 4):
        got = proximity_matches(index, ranked, within).join(members, "win")
        got = sorted((r["_k"], r["pos"], int(r["item"])) for r in got.collect())
        rare = Counter(w for t in texts for w in t.split())
        expected = []
        for item, text in items:
            words = text.split()
            if not all(rare[w] for w in words):
                continue
            lead = min(enumerate(words), key=lambda x: (rare[x[1]], x[0]))[1]
            for k, t in enumerate(texts):
                w = t.split()
                for p, x in enumerate(w):
                    if x == lead and set(words) <= set(w[max(0, p - within):p + within + 1]):
                        expected.append((k, p, item))
        assert got == sorted(expected) and expected


def test_index_work_runs_without_python(spark):
    docs, items = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = contamination(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", plan)


# ------------------------------------------------------------------ alignment

def aligned(rows):
    """``(id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum)`` per row."""
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=B)
    with open(A) as f, open(B, "rb") as g:
        a_bytes, b_bytes = first_vocabulary(f.read()), second_vocabulary(g.read())
    told, docs = [], Counter()
    for i, text in rows:
        a = own.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = other.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[x] for x in a) != raw or b"".join(b_bytes[x] for x in b) != raw:
            told.append((i, None))
            continue
        ends = [np.cumsum([len(v[x]) for x in ids]).tolist() for v, ids in ((a_bytes, a), (b_bytes, b))]
        groups, links, p, q = [], [], 0, 0
        place = [{end: k + 1 for k, end in enumerate(e)} for e in ends]
        for end in sorted(place[0].keys() & place[1].keys()):
            x, y = place[0][end], place[1][end]
            groups.append((a[p:x], b[q:y]))
            links += [(s, t) for s in a[p:x] for t in b[q:y]]
            p, q = x, y
        docs.update(set(links))
        told.append((i, (a, b, groups, links)))
    most = {}
    for (s, _), n in docs.items():
        most[s] = max(most.get(s, 0), n)
    out = []
    for i, x in told:
        if x is None:
            out.append((i, 0, 0, 0, 0, "", 0, 0))
            continue
        a, b, groups, links = x
        text = ";".join(",".join(map(str, s)) + "|" + ",".join(map(str, t)) for s, t in groups)
        out.append((i, len(a), len(b), len(groups), len(links), _hash(text),
                    sum(docs[x] == most[x[0]] for x in links), sum(docs[x] for x in links)))
    return sorted(out, key=str), docs


ODD_TEXTS = ["a  b", " a", "a ", "a\n b\n\n  c\tdef \t x", "x\r\ny;\r\n z", "one▁two", "café naïve ÀÉ", "<s> x </s> <|endoftext|>",
             "中文 漢字　全角", "\U0001f469‍\U0001f467 ok", "\x00a\x1cb", "  ", "\n", "9999 123,456.789", "don't we'll ‘quote’",
             "x" * 500 + " y", "абв где", "a b c\u0085d", "foo﻿bar", "the the the", "'''   '''", " \n a"]


@pytest.mark.parametrize("max_pairs", [4_000_000, 0])
def test_alignment_against_plain_python(spark, max_pairs):
    rows = [(r[0], r[1]) for r in brute.edge_rows()] + [(300 + i, t) for i, t in enumerate(ODD_TEXTS)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows],
                                 "doc_id long, text string, pairs long, regular string").repartition(3)
    found, counts = align_tokens(docs, A, B, max_pairs=max_pairs)
    expected, pairs = aligned(rows)
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert {(r["a"], r["b"]): r["docs"] for r in counts.collect()} == pairs
    empty, none = align_tokens(docs.limit(0), A, B, max_pairs=max_pairs)
    assert empty.collect() == [] and none.collect() == []


def test_alignment_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    found, _ = align_tokens(docs, A, B)
    expected, _ = aligned([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_identity_map_names_equal_bytes():
    with open(A) as f, open(B, "rb") as g:
        a, b = first_vocabulary(f.read()), second_vocabulary(g.read())
    same = identity_map(a, b)
    assert all(b[j] == x for x, j in zip(a, same.tolist(), strict=True) if j >= 0)
    assert all(j >= 0 for x, j in zip(a, same.tolist(), strict=True) if x and x in set(b))
