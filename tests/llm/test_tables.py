"""Vectors, archives, mixture, shards and the pipeline."""

import base64
import gzip
import hashlib
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from brute import SF01, SF001
from recsift.llm import ego_join, mixing, warc
from recsift.llm.ego_join import near_vectors
from recsift.llm.entry import QUERIES
from recsift.llm.mixing import mix_sources, order_again, position, training_order
from recsift.llm.ngram_join import keep_one
from recsift.llm.pii import all_spans, look_alikes
from recsift.llm.sharding import hilbert_index, hilbert_shards, write_shards
from recsift.llm.warc import _plain_uri, new_folder, ranges, read_records, write_archives


def _near(rows):
    """``(id, n_links, component_id, kept)`` of ``(id, vector, label)`` rows."""
    unit = []
    for _, v, label in rows:
        ok = v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, dtype=float) / np.linalg.norm(np.array(v, dtype=float)) if ok else None)
    links = [(i, j) for i in range(len(rows)) for j in range(i)
             if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.98]
    of, n = brute.components(len(rows), links), [0] * len(rows)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    least = {}
    for (i, _, _), c in zip(rows, of, strict=True):
        least[c] = min([x for x in (least.get(c), i) if x is not None], default=None)
    return sorted(((i, k, least[c], i is not None and i == least[c]) for (i, _, _), k, c in zip(rows, n, of, strict=True)),
                  key=str)


def test_labels_may_hold_commas(spark):
    rows = [(1, [1.0, 2.0], "a"), (2, [2.0], "a,1.0"), (3, [2.0], "a,1.0"), (4, [1.0, 2.0], "a"), (5, [2.0], "1"),
            (6, [2.0], "1,1"), (7, [2.0], "3,a,1.0"), (8, [1.0, 2.0], None), (9, [1.0, 2.0], ""), (10, [1.0, 2.0], "")]
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string"))
    assert sorted(map(tuple, got.collect()), key=str) == _near(rows)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr(ego_join, "INTERVAL", 40)
    monkeypatch.setattr(ego_join, "LEAF", 8)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + rng.normal(size=8) * (0.05 + 0.03 * (i % 4))).tolist(), i % 3 % 2) for i in range(400)]
    rows += [(400 + i, rows[0][1], rows[0][2]) for i in range(30)]  # equal vectors
    rows += [(430, [2 * x for x in rows[1][1]], rows[1][2]), (431, None, 0), (432, [0.0] * 8, 0),
             (433, [1.0, None] + [0.0] * 6, 0), (434, [float("nan")] * 8, 0), (435, [float("inf")] * 8, 0),
             (436, rows[0][1], None), (437, [], 0), (438, [1.0, 0.0], 0), (439, [1.0, 0.01], 0), (439, [1.0, 0.01], 0),
             (None, rows[2][1], rows[2][2]), (440, [1e-30] * 8, 0), (441, [1e30] * 8, 0)]
    df = spark.createDataFrame([(i, v, lab, "x", "y") for i, v, lab in rows],
                               "vec_id long, embedding array<double>, label int, id string, rep string").repartition(3)
    got = sorted((tuple(r) for r in near_vectors(df).collect()), key=str)
    assert got == _near(rows)
    assert near_vectors(df.limit(0)).collect() == []


def test_blocks_that_are_far_apart_are_skipped():
    a = ego_join._Interval({"x_ids": [1, 2], "x_counts": [1, 1], "x_vectors": [1, 0, 1, 0.01], "x_places": [1, 0, 1, 0.01]}, "x_")
    b = ego_join._Interval({"x_ids": [3], "x_counts": [5], "x_vectors": [0, 1], "x_places": [0, 1]}, "x_")
    na, nb, links = ego_join.join_intervals(a, b, False, 0.98, 0.2)
    assert not na.any() and not nb.any() and links == []
    na, _, links = ego_join.join_intervals(a, a, True, 0.98, 0.2)
    assert na.tolist() == [1, 0] and links == [(0, 1)]


def _pages(spark):
    long, short = "<p>" + "y" * 200, "<p>"
    rows = [(1, "http://a", long), (2, "http://b", long), (3, None, short), (4, "u\r\nx", short), (5, "http://e", None),
            (6, "http://é", "é" * 60), (7, "", ""), (0, "http://z", long), (7, "http://again", long), (0, "http://z", long),
            (None, "n", long), (None, "m", "only nulls " * 20), (None, "m", "only nulls " * 20), (9, "g", "z" * 300000)]
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "page_id long, url string, html string, digest string, "
                                 "refers_to string").repartition(3)


def test_archives_come_back(spark):
    pages = _pages(spark)
    folder = new_folder(pages)
    index = write_archives(pages, folder)
    assert index.count() == pages.count()
    first = {}
    for r in pages.collect():
        p = (r.html or "").encode()
        if len(p) >= 100 and r.page_id is not None:
            first[p] = min(first.get(p, r.page_id), r.page_id)
    want = []
    for r in pages.collect():
        p = (r.html or "").encode()
        to = first.get(p) if r.page_id != first.get(p) else None
        want.append((r.page_id, len(p), hashlib.sha256(p).hexdigest(), "response" if to is None else "revisit", to,
                     p if to is None else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
            None if r.payload is None else bytes(r.payload)) for r in read_records(index, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    some = read_records(index.filter("page_id = 2 or page_id = 6"), folder).collect()
    assert sorted(r.page_id for r in some) == [2, 6]
    for file in {r.file for r in index.collect()}:  # a plain gzip reader sees whole WARC records
        text = gzip.decompress(Path(folder.removeprefix("file:"), file).read_bytes())
        assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
    empty = write_archives(pages.limit(0), new_folder(pages))
    assert read_records(empty, folder).collect() == []


def test_ranges_close_together_are_one_read():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 200, 10), ("b", 0, 10)]
    assert list(ranges(rows, gap=10, most=100)) == [[0, 1, 2], [3], [4]]
    assert list(ranges(rows, gap=10, most=20)) == [[0, 1], [2], [3], [4]]
    assert list(ranges([])) == []


def test_damaged_records_are_refused():
    member = warc.record(1, "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False, "2000-01-01T00:00:00Z")
    assert warc.parse(member)["payload"] == b"payload"
    raw = zlib.decompress(member, 31).replace(b"payload", b"pAyload")
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        warc.parse(pack.compress(raw) + pack.flush())


def _targets(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    left, free, out = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = [s for s in free if level * w[s] > 2 * sizes[s]]
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


@pytest.mark.parametrize("table", ["edges", "documents"])
def test_mixture_meets_its_targets(spark, table):
    docs = brute.edge_docs(spark) if table == "edges" else spark.read.parquet(f"{SF01}/documents.parquet")
    rows = mix_sources(docs, keep=("doc_id", "source", "text")).collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        n = len(brute.words(r.text))
        assert r["size"] == n and r.taken == n * r.copies <= 2 * n and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), n)
    targets = _targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    again = mix_sources(docs.repartition(7), keep=("doc_id", "source", "text")).collect()
    assert _summary(rows) == _summary(again)


def _summary(rows):
    return sorted((str(r.doc_id), str(r.source), r["size"], r.copies) for r in rows)


def test_positions_follow_the_schedule(spark):
    # a rising schedule asks for less than half of its tokens in the first half
    at = spark.range(1).select(*[position(F.lit(0.5), F.lit(s)).alias(n) for n, s in
                                 (("rise", 0.5), ("stay", 0.0), ("fall", -0.5))]).first()
    assert at.rise > at.stay == 0.5 > at.fall
    t = at.rise
    assert (1 - 0.5) * t + 0.5 * t * t == pytest.approx(0.5)


def test_mixing_queries_follow_the_schedules(spark, monkeypatch):
    rows = lambda name: [tuple(r) for r in QUERIES[name](spark, SF01).collect()]
    mixed, places = rows("op7_mixing"), rows("op7_positions")
    first = {i: at for i, copy, at in places if copy == 0}
    assert [at for _, _, at in places] == sorted(at for _, _, at in places)
    assert [first[i] for i, *_ in mixed if i in first] == sorted(first.values())  # op7 comes in training order
    assert len(places) == sum(taken // size if size else 0 for _, size, _, _, taken, _, _ in mixed)
    assert {i: a for i, *_, a, _ in mixed if a is not None} == first
    assert {i: b for i, *_, b in mixed if b is not None} == {i: at for i, _, at in sorted(places)}
    monkeypatch.setattr(mixing, "position", lambda share, slope: position(share, -slope))
    assert sorted(rows("op7_positions")) != sorted(places) and rows("op7_mixing") != mixed


def test_training_order_repeats_rows_in_order(spark):
    docs = brute.edge_docs(spark)
    out = training_order(docs)
    assert out.columns == docs.columns
    copies = sum(r.copies for r in mix_sources(docs).collect())
    names = docs.count() - docs.distinct().count()
    assert names == 0  # the fixture's equal texts differ in other columns
    assert 0 < out.count() <= copies and out.select("doc_id", "text").exceptAll(
        docs.select("doc_id", "text").union(docs.select("doc_id", "text"))).count() == 0
    assert training_order(docs.limit(0)).collect() == [] and mix_sources(docs.limit(0)).collect() == []


def test_rows_of_one_id_and_text_stay_themselves(spark, tmp_path):
    text = brute.prose(3, 30)
    kind = "doc_id long, text string, lang string, source string, n_chars long, tags map<string,int>"
    rows = [(1, text, "en", "s1", 1, {"a": 1}), (1, text, "fr", "s2", 1, {"a": 1}), (1, text, "fr", "s2", 1, {"a": 2}),
            (1, text, None, "s2", 1, None), (2, brute.prose(4, 40), "en", "s1", 2, None),
            (3, brute.prose(5, 50), "de", None, 3, None), (None, None, "en", "s1", None, None),
            (None, "", "fr", "s1", None, None), (1, text, "en", "s1", 1, {"a": 1})]
    found = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, kind).coalesce(1)
        out = training_order(docs).collect()
        taken = Counter(map(str, out))
        mixed = mix_sources(docs, keep=("doc_id", "source")).collect()
        expected = Counter()
        for r in mixed:
            expected[r.doc_id, r.source] += r.copies
        assert Counter((r.doc_id, r.source) for r in out) == +expected and set(taken) <= {
            str(r) for r in docs.collect()}
        again = order_again(training_order(docs).repartition(3))
        assert Counter(map(str, again.collect())) == taken
        kept = sorted(map(str, keep_one(docs).collect()))
        assert len(kept) == 5  # texts 1, 2, 3 once each, and both rows without words
        found.append((taken, kept))
    assert found[0] == found[1]
    empty = spark.createDataFrame([], kind)
    assert order_again(empty).collect() == [] and keep_one(empty).collect() == []


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 3)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = 1 << bits
    cells = spark.range(side ** dims).select(*[F.expr(f"cast(floor(id / {side ** i}) % {side} as int) c{i}")
                                               for i in range(dims)])
    rows = cells.select("*", hilbert_index([F.col(f"c{i}") for i in range(dims)], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(side ** dims))
    steps = np.abs(np.diff(np.array([r[:dims] for r in rows]), axis=0)).sum(axis=1)
    assert (steps == 1).all()


@pytest.mark.parametrize("table", ["edges", "documents"])
def test_shards(spark, table):
    docs = brute.edge_docs(spark) if table == "edges" else spark.read.parquet(f"{SF01}/documents.parquet")
    rows = hilbert_shards(docs, keep=("doc_id", "text")).collect()
    n = docs.count()
    assert len(rows) == n
    slots = {}
    for r in rows:
        raw = (r.text or "").encode()
        assert r["size"] == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(40)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    h = {}
    for r in rows:
        h.setdefault(r.shard, []).append(r.hilbert)
    runs = [(min(v), max(v)) for _, v in sorted(h.items())]
    assert all(a[1] <= b[0] for a, b in zip(runs, runs[1:]))  # shards are runs of the curve
    if table == "edges":
        assert hilbert_shards(docs.limit(0)).collect() == []


def test_written_shards_prune_on_every_dimension(spark, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    write_shards(docs, str(tmp_path / "s"), shards=16)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.drop("_shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    hit = lambda c: back.filter(c).select("_shard").distinct().count()
    assert hit(F.col("lang") == "de") <= 8 and hit(F.col("source") == "src3") <= 8
    assert hit(F.length("text") > 8000) <= 8


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, kept = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF001).write.parquet(out := str(tmp_path / str(k)))
        kept[name] = (docs, docs := spark.read.parquet(out))
        if k < 4:
            assert docs.columns == columns
    before, after = kept["quality"]
    clean = [r.doc_id for r in spark.read.parquet(f"{SF001}/labels.parquet").filter("quality = 1").collect()]
    rows = {r.doc_id: r.text for r in before.collect()}
    failed = {i for i, t in rows.items() if len(w := brute.words(t)) < 20 or 100 * _repeats(w) > 30 * len(w)}
    left = {r.doc_id for r in after.collect()}
    assert not failed & left and set(clean) - failed <= left
    before, after = kept["near_duplicates"]
    pairs = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in brute.jaccard_join(pairs)})
    before, after = kept["private_data"]
    assert after.count() == before.count()
    assert not after.filter(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")).count()
    assert after.filter(F.col("n_chars") != F.length("text")).count() == 0
    before, after = kept["mixture"]
    assert after.exceptAll(before.union(before)).count() == 0
    before, after = kept["tokens"]
    assert sorted((r.doc_id, r.text) for r in after.collect()) == sorted((r.doc_id, r.text) for r in before.collect())


def _spread(doc_id):
    return int(hashlib.md5(f"7|{doc_id}".encode()).hexdigest()[:15], 16), str(doc_id)


def _by_source(rows):
    """Documents ``(doc_id, source, text)`` of each source in the mix's order, and source sizes."""
    held = {}
    for i, s, t in sorted(rows, key=lambda r: _spread(r[0])):
        held.setdefault(s, []).append((i, len(brute.words(t))))
    return held, {s: sum(n for _, n in docs) for s, docs in held.items()}


def test_order_again_without_a_source_that_was_not_taken(spark):
    rows = [(i, " ".join(["w"] * (20 + i % 7)), "en", f"s{i % 5}", 1) for i in range(200)]
    rows += [(200, " ".join(["long"] * 9000), "en", "aa", 1)]  # its own source, over twice what that may take
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = mixing.training_order(docs, weights=(1, 50, 50, 50, 50, 50), share=0.2)
    left = [r.doc_id for r in mixed.collect()]
    assert left and 200 not in left
    again = mixing.order_again(spark.createDataFrame(mixed.collect()[::-1], mixed.schema))
    slope = {s: (-0.5, 0.0, 0.5)[ord(hashlib.md5(s.encode()).hexdigest()[0]) % 3] for s in ("s0", "s1", "s2", "s3", "s4")}
    assert len(set(slope.values())) > 1
    of = {i: s for i, _, _, s, _ in rows}
    got = [r.doc_id for r in again.collect()]
    assert sorted(got) == sorted(left)
    for s in slope:  # each source's own order is the mixture's
        assert [i for i in got if of[i] == s] == [i for i in left if of[i] == s]
    place = {s: k for k, s in enumerate(sorted(slope))}
    half = {s: sum(k < len(got) / 2 for k, i in enumerate(got) if of[i] == s) for s in place}
    was = {s: sum(k < len(left) / 2 for k, i in enumerate(left) if of[i] == s) for s in place}
    assert all(abs(half[s] - was[s]) <= 2 for s in place)  # schedules are the same ones


def test_order_again_on_edge_rows(spark):
    docs = brute.edge_docs(spark)
    mixed = mixing.training_order(docs)
    again = mixing.order_again(mixed)
    assert again.columns == docs.columns
    assert again.exceptAll(mixed).count() == 0 and mixed.exceptAll(again).count() == 0
    assert mixing.order_again(docs.limit(0)).collect() == []


def test_tokens_are_written_in_training_order(spark, tmp_path):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").limit(400)
    docs.write.parquet(str(tmp_path / "d"))
    corpus_pipeline.mixture(spark, spark.read.parquet(str(tmp_path / "d")), SF01).repartition(7) \
        .write.parquet(str(tmp_path / "m"))
    mixed = spark.read.parquet(str(tmp_path / "m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        corpus_pipeline.tokens(spark, mixed, SF01).write.parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted((tmp_path / "t").glob("part-*.parquet"))
    got = [i for f in files for i in pq.read_table(f).column("doc_id").to_pylist()]
    rows = {(r.doc_id, r.source, r.text) for r in mixed.collect()}
    source, copies = {i: s for i, s, _ in rows}, Counter(r.doc_id for r in mixed.collect())
    held, _ = _by_source(rows)
    slope = {s: (-0.5, 0.0, 0.5)[ord(hashlib.md5(s.encode()).hexdigest()[0]) % 3] for s in held}
    at, total = {}, {s: sum(n * copies[i] for i, n in docs) for s, docs in held.items()}
    for s, order in held.items():
        done = 0
        for k in range(2):
            for i, n in order:
                if copies[i] > k:
                    x, a = done / total[s], slope[s]
                    at[i, k] = x if a == 0 else ((1 - a) ** 2 + 4 * a * x) ** 0.5 / (2 * a) - (1 - a) / (2 * a)
                    done += n
    seen, times = Counter(), []
    for i in got:
        times.append(at[i, seen[i]])
        seen[i] += 1
    assert len(files) > 1 and seen == copies and len(set(source.values())) > 2
    assert all(a <= b + 1e-9 for a, b in zip(times, times[1:]))


def _masked(text, glyphs, pattern):
    out, at = "", 0
    for kind, a, b, _ in sorted(all_spans(text, glyphs, pattern), key=lambda x: (x[1], -x[2], x[0].upper())):
        if a >= at:
            out, at = out + text[at:a] + f"[{kind.upper()}]", b
    return out + text[at:]


def test_pipeline_rows_by_plain_python(spark, tmp_path):
    docs, kept = spark.read.parquet(f"{SF001}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF001).write.parquet(out := str(tmp_path / name))
        before, docs = docs.collect(), spark.read.parquet(out)
        kept[name] = before, docs.collect()
    before, after = kept["private_data"]
    glyphs, pattern = look_alikes()
    want = {r.doc_id: _masked(r.text, glyphs, pattern) for r in before}
    assert {r.doc_id: r.text for r in after} == want and want != {r.doc_id: r.text for r in before}
    before, after = kept["mixture"]
    held, sizes = _by_source([(r.doc_id, r.source, r.text) for r in before])
    targets, copies = _targets(sizes), Counter()
    for s, order in held.items():
        at = 0
        for i, n in order:
            copies[i] = sum(at + sizes[s] * k + n / 2 < targets[s] for k in range(2))
            at += n
    texts = {r.doc_id: tuple(r) for r in before}
    assert Counter(tuple(r) for r in after) == +Counter({texts[i]: n for i, n in copies.items()})
    before, after = kept["tokens"]
    lines = [x.split() for x in open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb")]
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines})
    ids = lambda t: np.array(own.encode_ordinary(t), dtype="<u4").tobytes()
    rows = lambda x: sorted((r.doc_id, r.n_tokens, bytes(r.ids), r.text) for r in x)
    assert rows(after) == sorted((r.doc_id, len(i := ids(r.text)) // 4, i, r.text) for r in before)
    assert rows(corpus_pipeline.run(spark, SF001).collect()) == rows(after)


def _repeats(w):
    seen, covered = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            for i in at:
                covered.update(range(i, i + 8))
    return len(covered)


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.columns == ["doc_id", "n_tokens", "ids", "text"] and out.count() > 100
    assert re.fullmatch("[a-z_ ]+", " ".join(n for n, _ in corpus_pipeline.STAGES))


def test_archive_folders_by_hadoop_names():
    names = {"s3a://b/k": "s3://b/k", "s3n://b": "s3://b", "dbfs:/x/y": "/dbfs/x/y", "file:///x": "file:///x", "/x": "/x"}
    assert {n: _plain_uri(n) for n in names} == names


def test_records_are_read_by_as_many_tasks_as_bytes_ask_for(spark, tmp_path, monkeypatch):
    from recsift.llm import warc

    pages = spark.createDataFrame([(i, f"u{i}", brute.prose(i, 300)) for i in range(60)], "page_id long, url string, html string")
    index = write_archives(pages, f"file://{tmp_path}/w")
    size = index.agg(F.sum("length")).first()[0]
    monkeypatch.setattr(warc, "TASK_BYTES", size // 5)
    read = read_records(index, f"file://{tmp_path}/w")
    assert read.rdd.getNumPartitions() >= 5 and read.count() == 60
