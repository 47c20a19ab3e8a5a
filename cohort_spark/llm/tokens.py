"""Token ids of whole texts by a public tokenizer, with a cache of words.

The tokenizer's normaliser and splitter never look across ASCII white space, so the ids of a text are those of its
words, one after another.  The library encodes each distinct word once per worker; the cache has a bounded size.
"""

from __future__ import annotations

import re
import string
import struct
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
CACHED_WORDS = 250_000


def _byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself where it can be seen, else one from 256 on."""
    seen = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in seen else next(others)) for b in range(256)]


# Letters that the normaliser only turns to lower case: Latin ones below 0x100.  The splitter keeps runs of them together.
_BYTES = _byte_characters()
_LATIN = [chr(c) for c in range(0x41, 0x100) if chr(c).isalpha() and chr(c) not in "\xaa\xb5\xba"]
_SPELLED = str.maketrans({c: "".join(_BYTES[b] for b in c.lower().encode()) for c in _LATIN})
_LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch


class Encoder(dict):
    """Maps the UTF-8 bytes of a word to the bytes of its ids (little-endian, unsigned, 32 bits)."""

    def __init__(self, path: str, most: int = CACHED_WORDS):
        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.most = most
        self.older: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            text = word.decode("utf-8", "replace")
            core = text.rstrip(string.punctuation)
            if not _LETTERS(core):
                ids = self._packed(self.library.encode(text, add_special_tokens=False).ids)
            else:  # a run of letters and one of marks: the splitter parts the two whatever they are
                ids = self.letters(core.lower() if core.isascii() else core.translate(_SPELLED))
                if len(core) < len(text):
                    ids += self.marks(text[len(core) :])
        if len(self) >= self.most:  # the words of the last generation stay at hand
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def letters(self, spelled: str) -> bytes:
        """The ids of a run of letters, given as the model spells them."""
        ids = self.parts.get(spelled)
        if ids is None:
            ids = self._kept(spelled, [t.id for t in self.model.tokenize(spelled)])
        return ids

    def marks(self, marks: str) -> bytes:
        """The ids of a run of ASCII marks."""
        ids = self.parts.get(marks)
        if ids is None:
            ids = self._kept(marks, self.library.encode(marks, add_special_tokens=False).ids)
        return ids

    def _kept(self, part: str, ids: list[int]) -> bytes:
        if len(self.parts) >= self.most:
            self.parts.clear()
        packed = self.parts[part] = self._packed(ids)
        return packed

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: bytes) -> bytes:
        """The ids of a whole text."""
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(path or public_tokenizers.path(VOCABULARY))


def text_bytes(column) -> list[bytes]:
    """Texts as UTF-8; null is empty."""
    return column.cast(pa.string()).fill_null("").cast(pa.binary()).to_pylist()
