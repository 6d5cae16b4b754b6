"""Token ids of the ``tokenizers`` library through a table of distinct chunks and a table of pre-tokens.

White space ends every pre-token of the tokenizer and is dropped, so a text may be cut at spaces, line feeds and
tabs and the parts encode independently. A chunk of printable ASCII and precomposed Latin letters is lower-cased, cut
by the tokenizer's own pattern and given to its BPE model; any other chunk goes through the whole library call.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable

import numpy as np

from hitlens.llm.common import held

TABLE_SIZE = 250_000  # entries of a generation
LONG = 100  # characters; longer keys are not kept
# letters of this range have no other composed form and lower-case one by one; U+0130 and U+0149 do not
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-įı-ňŊ-ž]+")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ž]+|[0-9]|[^a-z0-9ß-öø-ž]+")


def _byte_letters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free letter from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


class Generations(dict):
    """A bounded table: a full generation becomes the old one, and what is used again moves to the young one.

    Frequent words stay whatever the length of the corpus; rare ones go, and long ones (text without blanks) are never kept,
    which bounds the bytes too. ``make`` computes a missing value.
    """

    def __init__(self, make: Callable[[str], bytes], size: int) -> None:
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > LONG:
            return value
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def token_type(path: str) -> np.dtype:
    """The smallest unsigned type that fits the ids of a tokenizer."""
    from tokenizers import Tokenizer

    return np.dtype("<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else "<u4")


class WordTable:
    """Ids by distinct chunk, as bytes of the smallest fitting unsigned type; lives as long as its Python worker."""

    def __init__(self, path: str, size: int = TABLE_SIZE) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.chunks = Generations(self._chunk, size)
        self.pieces = Generations(self._piece, size)
        with open(path, encoding="utf-8") as file:
            self.specials = [t["content"] for t in json.load(file)["added_tokens"]]

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else "".join(map(self.letters.__getitem__, piece.encode()))
        return self.packed([t.id for t in self.model.tokenize(letters)])

    def _chunk(self, chunk: str) -> bytes:
        if not chunk:
            return b""
        if chunk.isalpha() and chunk.isascii():  # one pre-token
            return self.packed([t.id for t in self.model.tokenize(chunk.lower())])
        if _PLAIN.fullmatch(chunk) and not ("<|" in chunk and any(s in chunk for s in self.specials)):
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(chunk.lower())))
        return self.packed(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text without special tokens, as packed bytes."""
        parts = text.replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self.chunks.__getitem__, parts))


def word_table(path: str) -> WordTable:
    return held(("words", path), lambda: WordTable(path))
