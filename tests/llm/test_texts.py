"""Row-wise operators: personal data, quality, byte-level BPE, token counts."""

import base64
import hashlib
import random
import re
import time
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import brute
from brute import SF01, SF001
from recsift.llm.byte_bpe import Codec, byte_bpe, load_ranks, serialise_model
from recsift.llm.entry import QUERIES
from recsift.llm.pii import _INVISIBLE, _LOOKALIKES, _Mapped, all_spans, find_pii, find_spans, look_alikes, mask_pii
from recsift.llm.quality import COUNTS, fit_label_model, keep_good, score_quality
from recsift.llm.token_counts import token_counts

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0


def _spans(t):
    out = [("email", *m.span()) for m in EMAIL.finditer(t)]
    out += [("ip", *m.span()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(t) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_patterns_on_random_texts():
    rng = random.Random(1)
    for _ in range(30000):
        t = "".join(rng.choice("a1.@-+ 9(0)b") for _ in range(rng.randint(0, 40)))
        assert find_spans(t) == _spans(t), t


DISGUISED = [
    ("write to john at example dot com now", "email", "john at example dot com"),
    ("jane [at] mail (dot) example [dot] org.", "email", "jane [at] mail (dot) example [dot] org"),
    ("ｊohn＠example．com", "email", "ｊohn＠example．com"),
    ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),  # Cyrillic letters
    ("call plus one five five five one two three four five six now", "phone",
     "plus one five five five one two three four five six"),
    ("at one nine two dot one six eight dot zero dot one ok", "ip", "one nine two dot one six eight dot zero dot one"),
    ("appelez plus trois trois un deux trois quatre cinq six sept huit neuf ici", "phone",
     "plus trois trois un deux trois quatre cinq six sept huit neuf"),
    ("ruf plus vier neun null fünf sechs sieben acht neun eins an", "phone",
     "plus vier neun null fünf sechs sieben acht neun eins"),
    ("4l11 1111 1111 1111", "card", "4l11 1111 1111 1111"),
    ("１９２.168.0.1", "ip", "１９２.168.0.1"),
]


@pytest.mark.parametrize(("text", "kind", "span"), DISGUISED)
def test_disguises_are_found_at_their_source(text, kind, span):
    glyphs, pattern = look_alikes()
    added = [(k, text[a:b]) for k, a, b, base in all_spans(text, glyphs, pattern) if not base]
    assert added == [(kind, span)]


@pytest.mark.parametrize("text", ["we met at home dot by dot", "one by one, two of three", "the cat (at) night",
                                  "[dot] zero one two", "l0l and 0ne", "", "at noon at two dot three"])
def test_plain_talk_is_no_disguise(text):
    glyphs, pattern = look_alikes()
    assert [s for s in all_spans(text, glyphs, pattern) if not s[3]] == []


SHORT_DISGUISES = [
    ("at one two seven dot zero dot zero dot one, ok", "ip", "one two seven dot zero dot zero dot one"),
    ("at one zero dot zero dot zero dot one", "ip", "one zero dot zero dot zero dot one"),
    ("use eight dot eight dot eight dot eight now", "ip", "eight dot eight dot eight dot eight"),
    ("127 dot 0 dot 0 dot 1", "ip", "127 dot 0 dot 0 dot 1"),
    ("eins null punkt null punkt null punkt eins", "ip", "eins null punkt null punkt null punkt eins"),
    ("call +1 8OO 555 1234", "phone", "+1 8OO 555 1234"),
    ("4lll 1111 1111 1111", "card", "4lll 1111 1111 1111"),
    ("jane at startup dot co", "email", "jane at startup dot co"),
    ("my mail: jane at startup dot me.", "email", "jane at startup dot me"),
    ("jane.doe at startup dot us", "email", "jane.doe at startup dot us"),
    ("jane dot doe at example.com", "email", "jane dot doe at example.com"),
    ("jane42 at example.com, please", "email", "jane42 at example.com"),
    ("you can email jane at example.com", "email", "jane at example.com"),
    ("jane at example.com is my e-mail", "email", "jane at example.com"),
    ("jane@startup dot me", "email", "jane@startup dot me"),
]


@pytest.mark.parametrize(("text", "kind", "span"), SHORT_DISGUISES)
def test_short_disguises_are_found_at_their_source(text, kind, span):
    glyphs, pattern = look_alikes()
    added = [(k, text[a:b]) for k, a, b, base in all_spans(text, glyphs, pattern) if not base]
    assert added == [(kind, span)]


@pytest.mark.parametrize("text", ["look at example.com", "contact us at example.com", "check your email at gmail.com",
                                  "we met at noon dot me too", "one dot two dot three", "see jane at example.com",
                                  "300 dot 1 dot 1 dot 1", "we came at 5.It was late", "jane at home. It rained"])
def test_plain_talk_near_the_short_forms(text):
    glyphs, pattern = look_alikes()
    assert [s for s in all_spans(text, glyphs, pattern) if not s[3]] == []


@pytest.mark.parametrize("sign", [*_INVISIBLE, *_LOOKALIKES], ids=lambda c: f"U+{ord(c):04X}")
def test_one_sign_is_enough_in_a_latin_1_text(sign):
    glyphs, pattern = look_alikes()
    mail = f"jo{sign}hn@example.com"
    found = [(k, a, b) for k, a, b, base in all_spans(f"à {mail}", glyphs, pattern) if not base]
    assert found == [("email", 2, 2 + len(mail))]
    if sign in _INVISIBLE:
        card = f"4111{sign}1111{sign}1111{sign}1111"
        assert all_spans(f"café {card}", glyphs, pattern) == [("card", 5, 5 + len(card), False)]


LONG_NAME = "n" * 70
UNBOUNDED = [
    ("write a dot b dot c dot d dot e dot f at host dot com", "email", "a dot b dot c dot d dot e dot f at host dot com"),
    ("to joe at b dot c dot d dot e dot f dot g dot h dot com!", "email",
     "joe at b dot c dot d dot e dot f dot g dot h dot com"),
    ("joe   [at]   host   [dot]   com", "email", "joe   [at]   host   [dot]   com"),
    (f"by {LONG_NAME} at host dot com", "email", f"{LONG_NAME} at host dot com"),
    ("mail " + " dot ".join(["part"] * 90) + " at example.com", "email", " dot ".join(["part"] * 90) + " at example.com"),
    ("four    one    one    one 1111 1111 1111", "card", "four    one    one    one 1111 1111 1111"),
    ("call +1\u2011800\u2011555\u20111234 now", "phone", "+1\u2011800\u2011555\u20111234"),
    ("4111\u00a01111\u00a01111\u00a01111", "card", "4111\u00a01111\u00a01111\u00a01111"),
    ("4111\u20131111\u20131111\u20131111", "card", "4111\u20131111\u20131111\u20131111"),
    ("jo\u0301e\u0301@host.com", "email", "jo\u0301e\u0301@host.com"),
    ("ask joe-at-host-dot-co-dot-uk.", "email", "joe-at-host-dot-co-dot-uk."),
    ("juan arroba ejemplo punto com", "email", "juan arroba ejemplo punto com"),
    ("jean arobase exemple point fr", "email", "jean arobase exemple point fr"),
    ("joe&#64;host&#x2e;com", "email", "joe&#64;host&#x2e;com"),
]


@pytest.mark.parametrize(("text", "kind", "span"), UNBOUNDED)
def test_disguises_of_any_length(text, kind, span):
    added = [(k, text[a:b]) for k, a, b, base in all_spans(text, *look_alikes()) if not base]
    assert [(k, s.rstrip(".")) for k, s in added] == [(kind, span.rstrip("."))]


@pytest.mark.parametrize("text", ["we arrived at this point de facto", "mail from John at some point in May",
                                  "a stay-at-home dot", "1990\u20131995 and 2000\u20132005", "&#233;t&#233; &amp; &#99999999999;",
                                  "le point de vue arroba", "dot dot dot at dot at dot at"])
def test_plain_talk_near_the_long_forms(text):
    assert all_spans(text, *look_alikes()) == []


@pytest.mark.parametrize("part", ["a dot ", "at dot ", "a at ", " at dot at ", "@ at a.", "   ", "[  ", "x@", "1 ", "one   ",
                                  "-at-a-dot-", "&#", "\u0430\u043e ", "\u4f60\u597d", "a.", "\u200b1", "4111 "])
def test_long_texts_take_linear_time(part):
    signs = look_alikes()

    def seconds(n):
        best = 9e9
        for _ in range(2):
            start = time.perf_counter()
            all_spans(part * n, *signs)
            best = min(best, time.perf_counter() - start)
        return best
    assert seconds(80_000) < 12 * seconds(20_000) + 0.2  # four times the text


def test_offsets_after_several_rewrites():
    rng = random.Random(5)
    for _ in range(300):
        mapped, ranges = _Mapped("".join(rng.choice("abcdef") for _ in range(20))), [(i, i + 1) for i in range(20)]
        for _ in range(4):
            edits, at = [], 0
            while at < len(mapped.text) - 3:
                a = at + rng.randrange(3)
                b = a + 1 + rng.randrange(2)
                edits.append((a, b, rng.choice(["", "x"])))
                at = b
            text, want, last = "", [], 0
            for a, b, put in edits:
                text += mapped.text[last:a] + put
                want += ranges[last:a] + [(ranges[a][0], ranges[b - 1][1])] * len(put)
                last = b
            text, ranges = text + mapped.text[last:], want + ranges[last:]
            mapped.rewrite(edits)
            assert mapped.text == text
            assert [mapped.source(i, i + 1) for i in range(len(text))] == ranges


def test_mask_leaves_nothing_before_a_soft_hyphen(spark):
    t = spark.createDataFrame([("é jo\u00adhn@example.com!",)], "text string")
    assert [r.text for r in mask_pii(t).collect()] == ["é [EMAIL]!"]


def test_pii_query_matches_the_patterns(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op1_pii"](spark, SF01).collect()}
    assert len(got) == len(docs)
    for d in docs:
        want = _spans(d.text)
        r = got[d.doc_id]
        n = Counter(k for k, _, _ in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(n[k] for k in ("email", "ip", "card", "phone"))
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(text.split(",")) <= set(r.spans.split(","))


def test_pii_edges_and_masks(spark):
    docs = brute.edge_docs(spark)
    assert find_pii(docs).count() == docs.count()
    masked = mask_pii(docs)
    assert masked.columns == docs.columns
    assert masked.exceptAll(docs).count() == 0 and docs.exceptAll(masked).count() == 0  # nothing private
    t = spark.createDataFrame([(1, "é a.b@c.de, jane [at] x (dot) org, +1 (017) 555-7713!", "z"), (2, None, "z")],
                              "doc_id long, text string, rest string")
    assert [r.text for r in mask_pii(t).orderBy("doc_id").collect()] == ["é [EMAIL], [EMAIL], [PHONE]!", None]
    assert find_pii(docs.limit(0)).collect() == []


def _counts(text):
    w = brute.words(text)
    c = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if c[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)),
            len(covered))


def test_quality_counts_on_edges_and_documents(spark):
    for docs in (brute.edge_docs(spark), spark.read.parquet(f"{SF01}/documents.parquet")):
        want = sorted((str(r.doc_id), *_counts(r.text)) for r in docs.select("doc_id", "text").collect())
        rows = score_quality(docs).collect()
        assert sorted((str(r.doc_id), *(r[c] for c in COUNTS[:5])) for r in rows) == want
        for r in rows:
            failed = r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words
            assert r.base_failed == failed and not (failed and r.kept)


def test_quality_agrees_with_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = [r for r in score_quality(spark.read.parquet(f"{SF01}/documents.parquet")).collect()
            if r.doc_id in labels and not r.base_failed]
    good = [r.kept for r in rows if labels[r.doc_id]]
    bad = [r.kept for r in rows if not labels[r.doc_id]]
    assert sum(good) == len(good) > 200  # clean documents stay
    assert sum(bad) <= 0.1 * len(bad)


def test_label_model_learns_accuracies_without_labels():
    rng = np.random.default_rng(3)
    truth = rng.random(20000) < 0.7
    right = np.array([0.95, 0.8, 0.7, 0.9])
    votes = np.where(rng.random((20000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    votes[rng.random((20000, 4)) < 0.3] = 0
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = fit_label_model(patterns, counts.astype(float))
    assert model.prior == pytest.approx(0.7, abs=0.03)
    assert model.accuracies() == pytest.approx(right, abs=0.04)
    assert ((model.posterior(patterns)[at.ravel()] > 0.5) == truth).mean() > 0.9


def test_keep_good_keeps_columns_and_empty_tables(spark):
    docs = brute.edge_docs(spark)
    kept = keep_good(docs)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0
    assert keep_good(docs.limit(0)).collect() == [] and score_quality(docs.limit(0)).collect() == []


RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ODD_TEXTS = ["", " ", "a  b", "l's 'll we've", "x\x85y", "a\x1cb!\x1c!", "日本語 text", "😀👍🏽", "  \n\n x", "tab\tnew\n line",
             "x" * 3000, "<|endoftext|> and <|endoftext|>", "½ Ⅳ ٣", "é​", "　wide space", "a᠎b", "\x00\x7f"]


def test_byte_bpe_is_the_librarys_encoding():
    tokens = load_ranks(RANKS)
    codec = Codec(tokens, serialise_model(tokens), P.PATTERN)
    lines = [line.split() for line in open(RANKS, "rb")]
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks={base64.b64decode(a): int(b) for a, b in lines})
    rng = random.Random(0)
    letters = list("ab cd\n\t  '’s'llé日本ñ٣½²Ⅳ!?.-_  　\x85\x1c​😀👍́ßZ09")
    texts = ODD_TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    ids = codec.encode(texts)
    for t, i in zip(texts, ids, strict=True):
        assert np.frombuffer(i, "<u4").tolist() == own.encode_ordinary(t), t
        assert codec.decode(i) == t.encode()


def test_byte_bpe_round_trip_on_rows(spark):
    docs = brute.edge_docs(spark)
    rows = byte_bpe(docs, RANKS, P.PATTERN).select("doc_id", "n_tokens", "ids", F.col("decoded").cast("string").alias("t"))
    got = sorted((str(r.doc_id), r.t) for r in rows.collect())
    assert got == sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert all(len(r.ids) == 4 * r.n_tokens for r in rows.collect())
    assert byte_bpe(docs.limit(0), RANKS, P.PATTERN).collect() == []


def test_token_counts_are_the_librarys(spark):
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").union(
        brute.edge_docs(spark).select("doc_id", "text")).union(
        spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string"))
    want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(own.encode(r.text or "", add_special_tokens=False).ids),
                   n > 512) for r in docs.collect())
    got = token_counts(docs, P.path("byte_bpe_50k.json")).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want
    assert token_counts(docs.limit(0), P.path("byte_bpe_50k.json")).collect() == []
    with pytest.raises(ValueError):
        token_counts(docs, P.path("word_bpe_49k.json"))
