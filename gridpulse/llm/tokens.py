"""Token ids of whole texts by the tokenizers library, with bounded caches.

Both vocabularies in use cut a text into words before they merge, and a word
gets the same ids wherever it stands.  So a text is cut at single blanks, the
parts into words, and each word goes to the library's model once and then
comes from the cache.  This is done for texts of plain Latin characters,
where the word patterns below agree with the library's; any other text goes
through the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

# Latin-1 without the odd blanks: what the word patterns below are valid for.
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\xff]*")
_L = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_N = "0-9\xb2\xb3\xb9\xbc-\xbe"
# The word patterns of the two public tokenizers, over plain characters.
WORDS = {
    "byte": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"),
    "word": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+"),
}
# A blank between two other characters ends a word in both patterns.
GAP = re.compile(r"(?<=\S) (?=\S)")


# Two blanks in a row of any kind: such a text is not cut at its blanks.
WILD = tuple(a + b for a in " \t\r\n" for b in " \t\r\n" if " " in (a, b))


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet of the vocabularies: printable bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {b: chr(b) for b in own}
    for n, b in enumerate(x for x in range(256) if x not in letter):
        letter[b] = chr(256 + n)
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in range(256)}


class Cached(dict):
    """A dict that computes what it lacks, and keeps it while there is room."""

    def __init__(self, compute: Callable[[str], bytes], room: int):
        super().__init__()
        self.compute, self.room = compute, room

    def __missing__(self, key: str) -> bytes:
        found = self.compute(key)
        if len(self) < self.room:
            self[key] = found
        return found


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str, kind: str, room: int = 400_000, chunk: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.cut, self.lower, self.chunk = WORDS[kind].findall, kind == "word", chunk
        self.words = Cached(self._word, room)
        self.parts = Cached(self._part, room)

    def library(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(word.translate(self.letters))]).tobytes()

    def _run(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.cut(text)))

    def _part(self, part: str) -> bytes:
        # Of plain characters, letters alone are one word in both patterns (only the byte pattern has the blank in it).
        if part.isalpha():
            return self.words[part if self.lower else " " + part]
        return self._run(" " + part)

    def _pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about ``chunk`` characters that can be encoded apart."""
        lo = 0
        while len(text) - lo > self.chunk and (gap := GAP.search(text, lo + self.chunk)):
            yield text[lo : gap.start()]
            lo = gap.start()
        yield text[lo:]

    def _piece(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text):
            return self.library(text)
        if self.lower:
            text = text.lower()
        if text[-1:].isspace() or any(w in text for w in WILD):
            return self._run(text)
        first, *parts = text.split(" ")
        return self._run(first) + b"".join(map(self.parts.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._piece, self._pieces(text)))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, kind: str) -> Encoder:
    """This worker's encoder: loaded once, its cache kept from task to task."""
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, kind)
    return _ENCODERS[path, kind]
