"""Splitting texts into pre-tokens and encoding each distinct pre-token once.

A byte-pair tokenizer encodes each pre-token by itself, so a cache from pre-token to result gives the library's own
answer without running the library on every word. The splitting here covers texts in ``SAFE`` characters, where the
categories and lower-case forms are settled; every other text, and one holding a special token's string, goes whole
to the library.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable
from operator import attrgetter

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Ranges whose characters are unchanged by NFC next to each other and lower-cased to one character.
SAFE_RANGES = ((0x20, 0x7E), (0xA1, 0x12F), (0x131, 0x17F), (0x410, 0x44F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20AC, 0x20AC), (0x4E00, 0x9FA5))
SPACES = "\t\n\r "


def _class(kind: str) -> str:
    """The members of a category among the safe characters, as ranges for a regular expression."""
    found, start = [], None
    for low, high in SAFE_RANGES:
        for c in range(low, high + 2):
            inside = c <= high and unicodedata.category(chr(c))[0] == kind
            if inside and start is None:
                start = c
            elif not inside and start is not None:
                found.append(f"\\u{start:04x}-\\u{c - 1:04x}")
                start = None
    return "".join(found)


LETTERS, NUMBERS = _class("L"), _class("N")
UNSAFE = re.compile("[^\\t\\n\\r" + "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in SAFE_RANGES) + "]")
ENDINGS = "'(?:s|t|re|ve|m|ll|d)"
#: The byte-level pattern: a piece takes one space before it, white space goes to the next word but for its last character.
BYTE_LEVEL = re.compile(
    f" ?[{LETTERS}]+|{ENDINGS}| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: The word pattern: lower-cased text, white space dropped, each digit by itself.
WORD_ENDS = re.compile(f"[{LETTERS}]+|{ENDINGS}|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


#: The characters that stand for the bytes of UTF-8 in a byte-level vocabulary: printable ones for themselves.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTES = {b: chr(b) for b in _SHOWN} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(0x100) if b not in _SHOWN)}


class _Shown(dict):
    """Code point -> the characters that stand for its bytes; for ``str.translate``."""

    def __missing__(self, c: int) -> str:
        self[c] = "".join(_BYTES[b] for b in chr(c).encode())
        return self[c]


class Pieces(dict):
    """Pre-token -> ``measure`` of its ids, encoded when first met, besides those it began with.

    There are two generations of at most ``most`` entries: a full one becomes the older, whose entries come back when
    they are met again. So memory is bounded, and frequent pre-tokens are not encoded anew when room is made.
    """

    def __init__(self, encode: Callable[[str], object], frequent: dict | None = None, most: int = 200_000):
        super().__init__(frequent or {})
        self.encode, self.frequent, self.most, self.older = encode, frequent or {}, most, {}

    def __missing__(self, piece: str):
        value = self.older.get(piece)
        if value is None:
            value = self.encode(piece)
        if len(self) >= self.most + len(self.frequent):
            self.older = dict(self)
            self.clear()
            self.update(self.frequent)
        self[piece] = value
        return value


ID = attrgetter("id")


class Encoder:
    """Encodes texts by looking up their words: ``join`` of the ``measure`` of all ids.

    A word is what stands between spaces. It is looked up with the space before it, as the byte-level pattern has it;
    the other pattern drops white space. A word of several pre-tokens is encoded from those.
    """

    def __init__(self, path: str, measure: Callable[[list[int]], object], join: Callable[[object], object], frequent: dict | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.measure, self.join = measure, join
        self.lowered = "Lowercase" in str(self.tokenizer.normalizer)
        self.split = (WORD_ENDS if self.lowered else BYTE_LEVEL).findall
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.shown = _Shown()
        self.pieces = Pieces(self._piece, most=25_000)
        self.words = Pieces(self._word, frequent)

    def _piece(self, piece: str):
        shown = piece if piece.isascii() and piece.isalnum() else piece.translate(self.shown)
        return self.measure(list(map(ID, self.model.tokenize(shown))))

    def _word(self, word: str):
        if self.lowered and word.isalpha():
            return self._piece(word)
        first, *rest = self.split(word if self.lowered else " " + word)
        if not rest:
            return self._piece(first)
        if self.lowered:  # a word before its comma is a word, too
            head = self.words[first] if first != word and first[0].isalpha() else self.pieces[first]
        else:
            head = self.words[first[1:]] if first != " " else self.pieces[first]
        return self.join([head, *map(self.pieces.__getitem__, rest)])

    def settled(self, text: str) -> bool:
        """Whether the text can be split here."""
        return not ((not text.isascii() or not text.isprintable()) and UNSAFE.search(text) or any(x in text for x in self.special))

    def spaced(self, text: str) -> list[str] | None:
        """The text's words, or None if white space is part of its pre-tokens in another way."""
        if self.lowered:
            return text.lower().split()
        if "  " in text or text[-1:] == " " or text[:1] == " ":
            return None
        return text.split(" ")

    def encoded(self, text: str):
        if not self.settled(text):
            return self.join([self.measure(self.tokenizer.encode(text, add_special_tokens=False).ids)])
        words = self.spaced(text)
        if words is None:
            return self.join(map(self.pieces.__getitem__, self.split(text)))
        if self.lowered:
            return self.join(map(self.words.__getitem__, words))
        # The first word has no space before it.
        return self.join([*map(self.pieces.__getitem__, self.split(words[0])), *map(self.words.__getitem__, words[1:])])
