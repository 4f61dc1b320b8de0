"""Operator 1: personal data behind disguises, with offsets into the source.

Base patterns are searched in the text as it stands. Transducers then rewrite
it where a disguise shows, and keep the source range of what they rewrote:

1. homoglyphs: code points that compatibility-normalise to one ASCII
   character (fullwidth and styled letters, digits of other scripts), look-alike
   letters, hyphens and spaces, one for one by a table; invisible characters and
   combining accents go; numeric character references are read;
2. spelled digits: runs of seven or more digit words or digits, three words
   at least, ``plus`` and ``dot`` between them; four numbers of one to three
   digits or digit words with three dot words between them; and runs of O, o,
   I, l between digits;
3. at/dot disguises: bracketed ``[at]``, ``(dot)``; hyphened
   ``name-at-host-dot-com``; bare ``name at host dot com`` with a known
   top-level domain; and ``name at host.com`` or a domain that is a common word
   (``dot me``) if the name has a dot or digit in it, an ``@`` or ``arroba``
   stands there or a mail word is near.

The same patterns are searched in the rewritten text; what is found there is
mapped back to source characters. A span is added only if a rewritten
character lies in it and it lies in no base span; base spans always stay.
No pattern has a bound on lengths, and all take linear time.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recsift.llm.words import slices

KINDS = ("email", "ip", "card", "phone")
_KIND_ORDER = {k: i for i, k in enumerate(KINDS)}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain, found from each @: the
    local part is the run of its characters before it (linear time)."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _byte_sized(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans ``(kind, start, end)`` of the base patterns, by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in _emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(map(_byte_sized, m[0].split("."))):
                out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


# Letters of other scripts that look like a Latin letter.
_LOOKALIKES = dict(zip("аеорсухіјѕԁһӏԛԝАВЕКМНОРСТУХІЈЅαικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "aeopcyxijsdhlqwABEKMHOPCTYXIJSaiKvoptuxABEZHIKMNOPTYX", strict=True))
# Soft hyphen, zero-width characters, direction marks, hair space, word joiner, byte-order mark.
_INVISIBLE = "\u00ad\u200a\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2066\u2067\u2068\u2069\ufeff"
_ACCENTS = "\u0300-\u036f"  # combining
# Hyphens and dashes.
_HYPHENS = "\u2010\u2011\u2012\u2013\u2014\u2015\u2212"
# Digit words of the documents' languages, 0 to 9.
_DIGIT_LISTS = (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
_DIGIT_WORDS = {w: str(i) for words in _DIGIT_LISTS for i, w in enumerate(words.split())} | {"oh": "0"}
# Words for the plus sign and the dot between numbers.
_PLUS_WORDS, _DOT_WORDS = ("plus", "más"), ("dot", "point", "punkt", "punto")


def look_alikes() -> tuple[np.ndarray, re.Pattern]:
    """A table that gives each code point the ASCII character that it stands
    for (itself, where it stands for none), and a pattern of those that go."""
    table = np.arange(0x20000, dtype="<u4")
    for code in range(0x100, len(table)):
        flat = unicodedata.normalize("NFKC", chr(code))
        if len(flat) == 1 and " " <= flat < "\x7f":
            table[code] = ord(flat)
        elif (d := unicodedata.decimal(chr(code), None)) is not None:
            table[code] = ord("0") + d
    for c, flat in {**_LOOKALIKES, **dict.fromkeys(_HYPHENS, "-"), "\u00a0": " "}.items():
        table[ord(c)] = ord(flat)
    for c in _INVISIBLE:
        table[ord(c)] = ord(c)
    return table, re.compile(f"[{_INVISIBLE}{_ACCENTS}]")


_PART = 1 << 20  # characters that are looked up at a time


def flattened(text: str, table: np.ndarray) -> str:
    """The text with its look-alikes replaced, one for one."""
    if text.isascii():
        return text
    out = []
    for i in range(0, len(text), _PART):
        codes = np.frombuffer(text[i:i + _PART].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        within = codes < len(table)
        out.append(np.where(within, table[np.where(within, codes, 0)], codes).tobytes()
                   .decode("utf-32-le", "surrogatepass"))
    flat = "".join(out)
    return text if flat == text else flat


class _Mapped:
    """A rewritten text and the places where it differs from its source.

    ``pieces`` holds, in order, ``(at, n, start, end)``: the ``n`` (0 or 1)
    characters from ``at`` on stand for the source range ``start`` to ``end``.
    Between pieces text and source run side by side, so memory grows with the
    edits.
    """

    def __init__(self, text: str):
        self.text = text
        self.pieces: list[tuple[int, int, int, int]] = []
        self.at: list[int] = []

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace ranges by one character or none; edits in order, not overlapping."""
        if not edits:
            return
        text, pieces, old, i, last, shift = [], [], self.pieces, 0, 0, 0
        for a, b, put in edits:
            while i < len(old) and old[i][0] + old[i][1] <= a:
                pieces.append((old[i][0] + shift, *old[i][1:]))
                i += 1
            while i < len(old) and old[i][0] < b:  # within the range
                i += 1
            pieces.append((a + shift, len(put), *self.source(a, b)))
            text += self.text[last:a], put
            shift += len(put) - (b - a)
            last = b
        pieces += [(at + shift, *rest) for at, *rest in old[i:]]
        self.text = "".join(text) + self.text[last:]
        self.pieces, self.at = pieces, [p[0] for p in pieces]

    def _stands_for(self, i: int) -> tuple[int, int]:
        k = bisect_right(self.at, i) - 1
        if k < 0:
            return i, i + 1
        at, n, start, end = self.pieces[k]
        return (start, end) if at + n > i else (end + i - at - n, end + i - at - n + 1)

    def source(self, a: int, b: int) -> tuple[int, int]:
        """Source range of the characters ``a`` to ``b`` (one at least)."""
        return self._stands_for(a)[0], self._stands_for(b - 1)[1]

    def marks(self) -> list[int]:
        """Rewritten characters; what went belongs to the character before it."""
        return [at if n else at - 1 for at, n, _, _ in self.pieces]


_any = lambda words: "(?:" + "|".join(sorted(words, key=len, reverse=True)) + ")"
_WORD, _PLUS, _DOT = _any(_DIGIT_WORDS), _any(_PLUS_WORDS), _any(_DOT_WORDS)
_GAP = r"[\x20\t,-]++"
_SPELLED = re.compile(
    rf"(?i)(?<![A-Za-z0-9])(?:{_PLUS}{_GAP})?(?:{_WORD}|[0-9])"
    rf"(?:(?:{_GAP}{_DOT}{_GAP}|{_GAP}|)(?:(?<![A-Za-z]){_WORD}(?![A-Za-z])|[0-9])){{6,}}(?![A-Za-z])")
_ONE_WORD = re.compile(rf"(?i){_WORD}")
_PARTS = re.compile(rf"(?i){_WORD}|{_PLUS}|{_DOT}|[0-9]|{_GAP}")
_DIGIT = rf"(?:(?<![A-Za-z]){_WORD}(?![A-Za-z])|[0-9])"
_NUMBER = rf"{_DIGIT}(?:[\x20-]?{_DIGIT}){{0,2}}"
_ADDRESS = re.compile(rf"(?i)(?<![A-Za-z0-9]){_NUMBER}(?:{_GAP}{_DOT}{_GAP}{_NUMBER}){{3}}(?![A-Za-z0-9])")
_LETTER_DIGIT = re.compile(r"(?<=[0-9])[OoIl]+(?=[\x20.-]?[0-9])")
_LETTER_IN_DIGITS = re.compile(r"[0-9][OoIl]+[\x20.-]?[0-9]")
_WHOLE_WORDS = tuple(f" {w} " for w in _DIGIT_WORDS)
_ZERO_ONE = {"O": "0", "o": "0", "I": "1", "l": "1"}
_BRACKET_AT = re.compile(r"(?i)(?<!\s)\s*+[\[({<]\s*+(?:at|@|arroba|arobase)\s*+[\])}>]\s*+")
_BRACKET_DOT = re.compile(r"(?i)(?<!\s)\s*+[\[({<]\s*+(?:dot|\.|punkt|punto|point)\s*+[\])}>]\s*+")
_REFERENCE = re.compile(r"(?ai)&(?:#([0-9]++)|#x([0-9a-f]++)|commat|period);")
# Top-level domains that are no common words, which the bare form
# needs ("at noon dot ..." is plain talk).
_TOP = frozenset(("com|org|net|edu|gov|info|biz|io|dev|app|ai|eu|uk|de|fr|es|nl|ch|pl|se|dk|fi|cz|pt|gr|ie|ca|au|nz|jp|cn|kr|"
        "br|mx|ar|cl|ru|ua|tr|za|co|tv|cc|xyz|ly|sh|ws|gg|lt|lv|ee|hu|ro|bg|hr|rs|sk|il|kr|sg|hk|tw|th|vn|ph|pk|"
        "lk|ke|ng|gh|eg|qa|kw|mk|md|uy|bo|ec|cr|gt|pr|mil|coop|mobi").split("|"))
# Domains that are common words too, or often plain talk.
_WORD_TOP = frozenset(("me|us|in|it|be|is|no|so|to|at|my|am|as|do|id|by|pe|la|sa|se|ma|lu|li|si|su|tu|ni|pa|im|name|pro|online|"
             "shop|store|site|club|blog|news|live|life|world|tech|cloud|digital|email|link|space|website|page|art|"
             "one|today|agency|company|int|travel|jobs").split("|"))
# Words for the at sign and the dot in addresses. "point" is plain English talk after "at".
_AT = re.compile(r"(?ai)\x20(?:at|arroba|arobase)\x20|@")
_AFTER_AT, _AFTER_OTHERS = ("dot", "punto", "punkt"), ("dot", "punto", "punkt", "point")
_SHOWS_AT = tuple(f" {w} " for w in ("at", "arroba", "arobase", *_AFTER_OTHERS))
_LABEL = re.compile(r"[A-Za-z0-9-]++")
_NEXT = {words: re.compile(rf"(?ai)(\x20{_any(words)}\x20|\.)([A-Za-z0-9-]++)") for words in (_AFTER_AT, _AFTER_OTHERS)}
_SPELLED_DOT = {words: re.compile(rf"(?ai)\x20{_any(words)}\x20") for words in (_AFTER_AT, _AFTER_OTHERS)}
_HYPHENED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++")
_HYPHEN_DOT = re.compile(r"(?ai)-dot-")
_NAME_SHAPE = re.compile(r"(?i)[a-z0-9][._+][a-z0-9]|[a-z][0-9]|[0-9][a-z]|\x20dot\x20")
# Words near an address, and words that are no name before it.
_MAIL_WORDS = ("mail", "mails", "email", "emails", "e-mail", "e-mails", "mailto", "courriel", "correo", "contact",
               "contacto", "contacter", "kontakt", "inbox", "address", "adresse", "dirección")
_MAIL = re.compile(rf"(?i)(?<![\w-]){_any(_MAIL_WORDS)}(?![\w-])")
_NO_NAMES = frozenset(("i you he she it we they me us him her them this that here there is are was be more look shop "
                       "online available and or out only").split()) | frozenset(_MAIL_WORDS)
_NEAR = 40  # characters


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _SPELLED.finditer(text):
        if len(_ONE_WORD.findall(m[0])) < 3:  # a number in plain digits, next to a word that is one
            continue
        for p in _PARTS.finditer(text, *m.span()):
            low = p[0].lower()
            put = "+" if low in _PLUS_WORDS else "." if low in _DOT_WORDS else _DIGIT_WORDS.get(low)
            if put:
                out.append((*p.span(), put))
            elif not low.isdigit():
                out.append((*p.span(), ""))
    return out


def _address_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _ADDRESS.finditer(text):
        for p in _PARTS.finditer(text, *m.span()):
            low = p[0].lower()
            if not low.isdigit():
                out.append((*p.span(), "." if low in _DOT_WORDS else _DIGIT_WORDS.get(low, "")))
    return out


def _reference_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _REFERENCE.finditer(text):
        digits = (m[1] or m[2] or "").lstrip("0")
        code = ord("@" if m[0].lower() == "&commat;" else ".") if not (m[1] or m[2]) else \
            int(digits or "0", 10 if m[1] else 16) if len(digits) <= 3 else 0
        if 0x20 < code < 0x7F:
            out.append((*m.span(), chr(code)))
    return out


def _hyphened_edits(text: str) -> list[tuple[int, int, str]]:
    out = []
    for m in _HYPHENED.finditer(text):
        low = m[0].lower()
        at = low.rfind("-at-")
        if at <= 0:
            continue
        labels = low[at + 4:].rstrip(".").split("-dot-")
        if len(labels) > 1 and all(labels) and labels[-1] in _TOP:
            at += m.start()
            out += [(*p.span(), ".") for p in _HYPHEN_DOT.finditer(text, m.start(), at)]
            out.append((at, at + 4, "@"))
            out += [(*p.span(), ".") for p in _HYPHEN_DOT.finditer(text, at + 4, m.end())]
    return out


def _name_start(text: str, floor: int, end: int, dots: tuple[str, ...]) -> int:
    """Start of the name that ends at ``end``: runs of a local part's characters
    with dot words between them; ``end`` itself if there is none."""
    start = at = end
    while True:
        unit = at
        while at > floor and text[at - 1] in _LOCAL:
            at -= 1
        if at == unit:
            return start
        start = at
        before = text[max(floor, at - 7):at].lower()
        word = next((w for w in dots if before.endswith(f" {w} ")), None)
        if word is None:
            return start
        at -= len(word) + 2


def _address_ends(text: str, at: re.Match, dots: tuple[str, ...]) -> tuple[int, int]:
    """Ends of the host after an at sign: at its last top-level domain after a
    dot word, and at its last of any kind; 0 if there is none."""
    bare = any_kind = 0
    label = _LABEL.match(text, at.end())
    while label and (label := _NEXT[dots].match(text, label.end())):
        top = label[2].lower()
        first = top.split("-", 1)[0]
        if len(label[1]) > 1 and first in _TOP:
            bare = label.start(2) + len(first)
        if top in _TOP or top in _WORD_TOP:
            any_kind = label.end()
    return bare, any_kind


def _bare_edits(text: str) -> list[tuple[int, int, str]]:
    """``name at host dot com``, and names before other hosts by their shape or a mail word near.

    A chain of labels ends at the next ``at`` that could begin another, so
    chains and names overlap at most twice and the search takes linear time.
    """
    out, last = [], 0
    for m in _AT.finditer(text):
        plain = m[0].lower() == " at "
        dots = _AFTER_AT if plain else _AFTER_OTHERS
        bare, end = _address_ends(text, m, dots)
        if not (bare or end):
            continue
        start = _name_start(text, last, m.start(), dots)
        if start == m.start() or start == last > 0:
            continue
        if bare or not plain:
            end = max(bare, end)
        else:
            name = text[start:m.start()]
            near = text[max(0, start - _NEAR):start], text[end:end + _NEAR]
            if not (_NAME_SHAPE.search(name) or name.lower() not in _NO_NAMES and any(map(_MAIL.search, near))):
                continue
        last = end
        out += [(*p.span(), ".") for p in _SPELLED_DOT[dots].finditer(text, start, m.start())]
        if m[0] != "@":
            out.append((*m.span(), "@"))
        out += [(*p.span(), ".") for p in _SPELLED_DOT[dots].finditer(text, m.end(), end)]
    return out


def disguised(text: str, invisible: re.Pattern) -> _Mapped:
    """The text after the transducers, each of which runs only where searches
    for literal strings show its disguise."""
    mapped = _Mapped(text)
    if not text.isascii():
        mapped.rewrite([(*m.span(), "") for m in invisible.finditer(text)])
    if "&" in text:
        mapped.rewrite(_reference_edits(mapped.text))
    low = mapped.text.lower()
    flat = low.replace("\n", " ").replace("\t", " ").replace("-", " ").replace(",", " ")
    if any(w in flat for w in _WHOLE_WORDS):
        mapped.rewrite(_spelled_edits(mapped.text))
    if sum(flat.count(f" {w} ") for w in _DOT_WORDS) >= 3:
        mapped.rewrite(_address_edits(mapped.text))
    mapped.rewrite([(i, i + 1, _ZERO_ONE[mapped.text[i]]) for m in _LETTER_DIGIT.finditer(mapped.text)
                    for i in range(*m.span())])
    if any(c in low for c in "[({<"):
        mapped.rewrite([(*m.span(), "@") for m in _BRACKET_AT.finditer(mapped.text)])
        mapped.rewrite([(*m.span(), ".") for m in _BRACKET_DOT.finditer(mapped.text)])
    if "-at-" in low and "-dot-" in low:
        mapped.rewrite(_hyphened_edits(mapped.text))
    if any(w in low for w in _SHOWS_AT):
        mapped.rewrite(_bare_edits(mapped.text))
    return mapped


def all_spans(text: str, table: np.ndarray, invisible: re.Pattern) -> list[tuple[str, int, int, bool]]:
    """Spans ``(kind, start, end, base)``, by kind, then start; ``table`` and
    ``invisible`` are those of :func:`look_alikes`."""
    base = find_spans(text)
    out = [(*s, True) for s in base]
    flat = flattened(text, table)
    mapped = disguised(flat, invisible)
    if not mapped.pieces and flat is text:
        return out
    marks = mapped.marks()
    # of one kind, base spans follow each other: the last to start can hold a span
    of_kind = [([a for k, a, _ in base if k == kind], [b for k, _, b in base if k == kind]) for kind in KINDS]

    def within_base(a: int, b: int) -> bool:
        return any((i := bisect_right(starts, a)) and b <= ends[i - 1] for starts, ends in of_kind)

    for kind, a, b in find_spans(mapped.text):
        start, end = mapped.source(a, b)
        i = bisect_left(marks, a)
        new = i < len(marks) and marks[i] < b or flat[start:end] != text[start:end]
        if new and not within_base(start, end):
            out.append((kind, start, end, False))
    out.sort(key=lambda s: (_KIND_ORDER[s[0]], s[1], s[2]))
    return out


def _spans(texts: bool):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("base", pa.bool_())]))

    def run(batches):
        table, invisible = look_alikes()
        for batch in (part for batch in batches for part in slices(batch, batch.num_columns - 1)):
            found = [all_spans(t or "", table, invisible) for t in batch.column(batch.num_columns - 1).to_pylist()]
            rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in f] for f in found]
            kept = batch.columns if texts else batch.columns[:-1]
            names = batch.schema.names if texts else batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, type=span)], names=[*names, "pii_spans"])
    return run


_SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, pii_spans)`` for every row of ``docs``: spans ``(kind, start,
    end, base)`` by kind (email, ip, card, phone), then start, in code points
    of the source text, end exclusive; ``base`` tells the patterns' own finds
    from those behind a disguise.

    Null or empty text: no spans. Every row counts by itself, so null or
    repeated ids need no rule; other columns are not read. Searches take
    linear time, so one very long text costs what its length costs. An empty
    table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(_spans(False), f"`{id_col}` {kind}, pii_spans {_SPANS}")


def mask_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by ``[KIND]`` (of overlapping spans the
    one that starts first, then the longer one). All columns and rows stay; a
    null text stays null."""
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*rest).alias("rest") if rest else F.lit(None).cast("string").alias("rest"),
                         text_col)
    schema = f"rest {packed.schema['rest'].dataType.simpleString()}, text string, pii_spans {_SPANS}"
    found = packed.withColumnRenamed(text_col, "text").mapInArrow(_spans(True), schema)
    order = F.array_sort(F.transform("pii_spans", lambda s: F.struct(
        s["start"].alias("a"), (-s["end"]).alias("e"), F.upper(s["kind"]).alias("k"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def put(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, s["a"] - acc["at"])
        return F.when(s["a"] < acc["at"], acc).otherwise(F.struct(
            (-s["e"]).alias("at"), F.concat(acc["out"], gap, F.lit("["), s["k"], F.lit("]")).alias("out")))

    masked = F.aggregate(order, start, put, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    masked = F.when(F.size("pii_spans") == 0, text).otherwise(masked)
    return found.select(*[F.col(f"rest.`{c}`").alias(c) if c != text_col else masked.alias(c)
                          for c in docs.columns])
