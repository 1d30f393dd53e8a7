"""Token ids of whole texts by the ``tokenizers`` library, with a bounded memo of words.

Byte-level BPE cuts a text into words before it merges bytes, and a space that touches a non-space always begins a
word. Texts are therefore cut at such spaces, each distinct piece is encoded once, and a text's ids are its pieces'
ids in a row. The result is exactly ``encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from string import punctuation
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The pre-tokenizer of byte-level BPE (fixed value); pieces with characters from U+0250 on are left to the library.
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: A space with white space on both sides, or on its left at the end, need not begin a word.
_DOUBTFUL = re.compile(r"\s (?:\s|\Z)")
_SPACES = tuple(c for c in map(chr, range(0x3001)) if c.isspace() and c != " ")
_PLAIN = tuple(c for c in _SPACES if c.isascii())
#: Finds characters that are left to the library.
_FAR = re.compile("[^\0-\u024f]").search
#: Added tokens may hold these, and characters that Python and the library class differently.
_ODD = ("<|", "\x1c", "\x1d", "\x1e", "\x1f", "\x85")

#: How byte-level BPE writes a space (fixed value).
_SPACE = "\u0120"
#: Characters of the longest words that are memoised.
LONGEST = 64
#: Characters that are cut together.
GROUP = 4_000_000

_LOADED: dict[str, Any] = {}


def _byte_letters() -> dict[int, str]:
    """How byte-level BPE writes each byte as a printable letter: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class _Words:
    """Ids, as little-endian bytes, of pieces after a space: a memo of words, and one of parts of mixed pieces.

    A full half of the words becomes the older one, from which words in use come back, so frequent ones outlast rare ones.
    """

    def __init__(self, tokenizer: Any, most: int) -> None:
        self.tokenizer, self.model, self.half = tokenizer, tokenizer.model, most // 2
        self.letters = {b: ord(c) for b, c in _byte_letters().items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def merged(self, word: str, lead: str = "") -> bytes:
        """Ids of one word of the pre-tokenizer, after ``lead``, merged by the library's model."""
        letters = word if word.isascii() and word.isalnum() else word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(lead + letters)]).tobytes()

    def part(self, word: str) -> bytes:
        if word[0] == " " and word[1:].isalpha():
            return self.piece(word[1:])
        found = self.inner.get(word)
        if found is None:
            found = self.merged(word)
            if len(word) <= LONGEST:
                if len(self.inner) >= self.half // 2:
                    self.inner.clear()
                self.inner[word] = found
        return found

    def piece(self, piece: str) -> bytes:
        """Ids of a space and the piece."""
        found = self.known.get(piece)
        if found is not None:
            return found
        if not piece.isascii() and _FAR(piece):
            return self.whole(" " + piece)
        if piece.isalpha():
            found = self.older.get(piece) or self.merged(piece, _SPACE)
            if len(piece) <= LONGEST:
                if len(self.known) >= self.half:
                    self.known, self.older = {}, self.known
                self.known[piece] = found
            return found
        bare = piece.rstrip(punctuation)
        if bare.isalpha():
            return self.piece(bare) + self.part(piece[len(bare) :])
        above, line, below = piece.partition("\n")
        if above and below and not above[-1].isspace() and not below[0].isspace():
            return self.piece(above) + self.part(line) + self.start(below)
        return b"".join(map(self.part, _WORD.findall(" " + piece)))

    def start(self, piece: str) -> bytes:
        """Ids of a piece that begins a line, which has no space before it."""
        if piece.isalpha():
            return self.part(piece)
        bare = piece.rstrip(punctuation)
        if bare.isalpha():
            return self.part(bare) + self.part(piece[len(bare) :])
        return b"".join(map(self.part, _WORD.findall(piece)))


class Encoder:
    """Encodes texts; holds one tokenizer and at most ``most`` memoised words."""

    def __init__(self, path: str, most: int = 400_000) -> None:
        from tokenizers import Tokenizer

        self.words = _Words(Tokenizer.from_file(path), most)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; none for a null or empty text.

        Texts are cut in groups of about ``GROUP`` characters; each distinct piece of a group is looked up once.
        """
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text or "")
            size += len(group[-1])
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        heads, tails = [], []
        for text in texts:
            if any(x in text for x in _ODD) or _spaced(text) and _DOUBTFUL.search(text):
                head, tail = self.words.whole(text), None
            else:
                first, space, rest = text.partition(" ")
                head, tail = self.words.whole(first) if first else b"", rest if space else None
            heads.append(head)
            tails.append(tail)
        cut = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [self.words.piece(p) if f is None else f for p, f in zip(pieces, map(self.words.known.get, pieces), strict=True)]
        ids = pa.array(known, pa.large_binary()).take(coded.indices)
        data, places = memoryview(ids.buffers()[2] or b""), np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        lengths = pc.fill_null(pc.list_value_length(cut), 0).to_numpy()
        ends = places[np.concatenate([[0], np.cumsum(lengths)])].tolist()
        for head, low, high in zip(heads, ends, ends[1:]):
            yield head + data[low:high]
        del cut, coded, pieces, known, ids, data, places
        pa.default_memory_pool().release_unused()


def _spaced(text: str) -> bool:
    """Whether white space comes before a space; a pair is only sought where its first character is found."""
    return "  " in text or any(x in text and x + " " in text for x in (_PLAIN if text.isascii() else _SPACES))


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file, loaded once."""
    if path not in _LOADED:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED[path] = Encoder(path)
    return _LOADED[path]
