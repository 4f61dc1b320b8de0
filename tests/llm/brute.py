"""Plain-Python versions of the operators, and rows that try their edges."""

import hashlib
import re
from collections import Counter, defaultdict

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# extra columns whose names an operator may use itself
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _k long, _sub string, part string, "
          "n_words string, position string, `class` string, pii_spans string, size string, shard string, row string, "
          "text_ string, _id_key string, pattern string, rest string, kept_columns string")
_EXTRA = ("x",) * (len(SCHEMA.split(",")) - 6)


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    """``n`` words, different for each seed."""
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 99991}" for i in range(n))


def edge_rows():
    base = prose(1, 120)
    near = base.split()
    near[60] = "other"
    passage = prose(5, 45)
    texts = [
        (0, base), (1, base), (2, " ".join(near)), (3, None), (4, ""), (5, " \t\n\x0b\r "), (6, "one two three"),
        (7, "One TWO three"), (8, prose(2, 19)), (9, prose(3, 20)), (10, "same " * 60), (11, prose(4, 30) + " " + passage),
        (12, passage + "\n" + prose(6, 30)), (13, prose(7, 12000)), (14, prose(7, 12000) + " tail"),
        (15, base), (15, base), (16, prose(8, 60)), (16, prose(9, 60)), (None, prose(10, 50)), (None, base),
        (None, None), (17, "é" * 300 + " ÀÉ   x"), (18, "x" * 20000), (-3, prose(11, 40)),
        (19, "line a\nline a\nline b\n\nline a"),
    ]
    return [(i, t, None if n % 5 == 0 else "en", (None, "a", "b", "b", "c")[n % 5], len(t or ""), n, *_EXTRA)
            for n, (i, t) in enumerate(texts)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def named(rows):
    """``(key, text)`` per row: key as in the operators' order of documents."""
    ids = Counter(i for i, _ in rows)
    big = (1 << 63) - 1
    out = []
    for i, t in rows:
        sub = int(hashlib.sha256((t or "").encode()).hexdigest()[:15], 16) if ids[i] > 1 else 0
        out.append(((big if i is None else i, sub), t))
    return out


def substring_dedup(rows, n=20):
    """Sorted ``(id, n_words, n_removed, kept)`` for ``(id, text)`` rows."""
    keyed = named(rows)
    first = {}
    for key, text in keyed:
        w = words(text)
        for i in range(len(w) - n + 1):
            t = tuple(w[i:i + n])
            first[t] = min(first.get(t, (key, i)), (key, i))
    out = []
    for (key, text), (i, _) in zip(keyed, rows, strict=True):
        w = words(text)
        gone = set()
        for s in range(len(w) - n + 1):
            if first[tuple(w[s:s + n])] < (key, s):
                gone.update(range(s, s + n))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=str)


def shingles(text, size=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def jaccard_links(sets):
    """Pairs of positions whose sets reach 0.75."""
    held = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            held[t].append(i)
    common = Counter((i, j) for at in held.values() for x, i in enumerate(at) for j in at[:x])
    return [(i, j) for (i, j), c in common.items() if 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c)]


def components(n, links):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        i, j = find(i), find(j)
        root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def jaccard_join(rows):
    """Sorted ``(id, n_shingles, component_id)`` for ``(id, text)`` rows."""
    sets = [shingles(t) for _, t in rows]
    of = components(len(rows), jaccard_links(sets))
    least = {}
    for (i, _), c in zip(rows, of, strict=True):
        least[c] = min(x for x in (least.get(c), i) if x is not None) if (least.get(c), i) != (None, None) else None
    return sorted(((i, len(s), least[c]) for (i, _), s, c in zip(rows, sets, of, strict=True)), key=str)
