"""Texts cut into pieces that byte-level tokenizers never merge across.

The tokenizers' own pattern starts a new pre-token at every white-space run
(its last space may go with the word that follows). ``PIECE`` makes just those
cuts, so a piece's tokens depend on the piece alone and can be remembered.
Texts with characters on whose class the regex engines differ (``ODD``) are
left to the tokenizer's own pattern as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable

PIECE = re.compile(r" ?\S+|\s+(?!\S)|\s+")
# White space for one engine and not for another, or next to it.
ODD = re.compile("[\x1c-\x1f\x85᠎​-‏⁠﻿]")
# Pieces remembered at most, the longest one remembered, and text looked up at once.
MEMO_PIECES = 200_000
MEMO_CHARS = 48
LOOKUP_CHARS = 1 << 20
# ASCII symbols that end a word's pre-token (an apostrophe may begin a contraction).
_SYMBOLS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_split(piece: str) -> list[str] | None:
    """Pre-tokens of a piece of Latin letters with symbols after them at most;
    None for any other piece."""
    word = piece.rstrip(_SYMBOLS)
    letters = word[1:] if word[:1] == " " else word
    if letters.isalpha() and max(letters) < "\u0250":
        return [word] if len(word) == len(piece) else [word, piece[len(word):]]
    return None


class Memo:
    """Values of pieces, worked out in batches and remembered.

    ``encode`` gives the value of each pre-token of a list, ``split`` the
    pre-tokens of a piece, ``combine`` one value from several.
    """

    def __init__(self, encode: Callable[[list[str]], list], split: Callable[[str], list[str]],
                 combine: Callable):
        self.encode, self.split, self.combine = encode, split, combine
        self.pieces: dict = {}
        self.tokens: dict = {}

    def _learn(self, new: set[str]) -> dict:
        """Adds the pieces; returns those too long to remember."""
        cut = {p: self.split(p) for p in new}
        unknown = list({t for ts in cut.values() for t in ts if t not in self.tokens})
        got = dict(zip(unknown, self.encode(unknown), strict=True)) if unknown else {}
        value = lambda t: got[t] if t in got else self.tokens[t]
        worked = {p: value(ts[0]) if len(ts) == 1 else self.combine(map(value, ts)) for p, ts in cut.items()}
        if len(self.pieces) + len(worked) > MEMO_PIECES or len(self.tokens) + len(got) > MEMO_PIECES:
            self.pieces, self.tokens = {}, {}
        self.tokens.update((t, v) for t, v in got.items() if len(t) <= MEMO_CHARS)
        self.pieces.update((p, v) for p, v in worked.items() if len(p) <= MEMO_CHARS)
        return worked

    def values(self, texts: list[str]) -> list:
        """The combined value of every text's pieces."""
        out, i = [], 0
        while i < len(texts):
            part, size = [], 0
            while i < len(texts) and (not part or size + len(texts[i]) <= LOOKUP_CHARS):
                part.append(PIECE.findall(texts[i]))
                size += len(texts[i])
                i += 1
            seen = set().union(*part)
            known = {p: self.pieces[p] for p in seen if p in self.pieces}
            known.update(self._learn(seen - known.keys()))
            out += [self.combine(map(known.__getitem__, pieces)) for pieces in part]
        return out


def read_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver (some MB, the same for any input)."""
    with open(path, "rb") as f:
        return f.read()
