"""Token ids of whole texts with a public tokenizer, inside tasks."""

from __future__ import annotations

import os
import re
from array import array

CACHED_UNITS = 300_000  # most words, as they stand between spaces, that a worker remembers
CACHED_BODIES = 600_000  # most plain words
CACHED_MARKS = 10_000    # most runs of marks; all bound a worker's memory to some 150 MB

#: A single space between two characters that are not white space, where both tokenizers
#: cut whatever comes before and after.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: A word of Latin letters, alone or before marks, and perhaps another one in the next line.
#: Pre-tokenizers cut between letters, marks and line ends, and normalising such letters is
#: plain lower-casing. The apostrophe is left out: contractions are cut otherwise.
_MARKS = r"[!-&(-/:-@\[-`{-~]{0,4}"
_PLAIN = re.compile(rf"([A-Za-zÀ-ÖØ-öø-ÿ]+)({_MARKS})(?:(\n)([A-Za-zÀ-ÖØ-öø-ÿ]+)({_MARKS}))?")

#: Byte-level vocabularies write printable bytes as themselves and the others, in order,
#: as the characters from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHER = [b for b in range(256) if b not in _PRINTED]
_BYTE = {**{b: chr(b) for b in _PRINTED}, **{b: chr(0x100 + i) for i, b in enumerate(_OTHER)}}


class _Known(dict):
    """Remembers what a function gave."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        value = self[key] = self.make(key)
        return value


_encoders: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit numbers.

    Pre-tokenizers never join what a single space between words separates, so a text is
    encoded word by word and a worker remembers the words it has met. ``spaced``: the
    space belongs to the word behind it (a case-sensitive byte-level vocabulary); else it
    is dropped and words are lower-cased. Plain words go straight to the tokenizer's model,
    all else through the whole tokenizer; the ids are those of encoding the text at once. A
    text that holds the string of an added token, which may stand anywhere, is encoded at once.
    """

    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.lead = " " if spaced else ""
        self.model = self.tokenizer.model
        self.known = _Known(self._unit)    # of words as they stand between spaces
        self.bodies = _Known(self._body)   # of plain words, with their space if it belongs to them
        self.marks = _Known(self._whole)   # of marks and line ends
        self.marks[""] = self.marks[None] = b""

    @classmethod
    def of(cls, path: str, spaced: bool) -> Encoder:
        """The encoder of this worker process."""
        if (path, spaced) not in _encoders:
            _encoders[path, spaced] = cls(path, spaced)
        return _encoders[path, spaced]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _body(self, text: str) -> bytes:
        letters = text if self.lead else text.lower()
        if self.lead or not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(_BYTE)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        if unit.isascii() and unit.isalpha():
            return self.bodies[self.lead + unit]
        plain = _PLAIN.fullmatch(unit)
        if not plain:
            return self._whole(self.lead + unit)
        word, mark, line, second, last = plain.groups()
        out = self.bodies[self.lead + word] + self.marks[mark]
        return out + self.marks[line] + self.bodies[second] + self.marks[last] if line else out

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        for cache, most in ((self.known, CACHED_UNITS), (self.bodies, CACHED_BODIES), (self.marks, CACHED_MARKS)):
            if len(cache) > most:
                cache.clear()
        self.marks[""] = self.marks[None] = b""
        get, out = self.known.__getitem__, []
        for text in texts:
            if text and any(s in text for s in self.special):
                out.append(self._whole(text))
                continue
            first, *rest = self._split(text or "")
            out.append(self._whole(first) + b"".join(map(get, rest)))
        return out

    @staticmethod
    def _split(text: str) -> list[str]:
        # As many words as single blanks and line ends, and one: there is no other white space.
        if len(text.split()) == text.count(" ") + text.count("\n") + 1:
            return text.split(" ")
        return _CUT.split(text)
