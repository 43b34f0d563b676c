"""Token ids and their number from the tokenizers library, which is asked once for each piece that is not remembered."""

from __future__ import annotations

import os
from array import array
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from payx.llm.bpe import REMEMBER, SHORT, byte_alphabet, load

#: New pieces that are turned into the vocabulary's characters as the lines of one text.
LINES = 1_000
_id = attrgetter("id")


class Known(dict):
    """Ids of pieces; those used since the last turn, and in `old` those used between the last two turns.

    A piece that is in neither gets an empty place, which stands for its ids until they are filled in; `new` has these.
    """

    def __init__(self):
        self.old: dict[str, bytes] = {}
        self.new: dict[str, bytearray] = {}

    def __missing__(self, piece: str) -> bytes | bytearray:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.new[piece] = bytearray()
        self[piece] = ids
        return ids

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()


class Library:
    """Ids of texts from the tokenizers library, asked once for each pre-tokenizer piece that is not remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merged = self.tokenizer.model.tokenize
        self.bpe = load(path)
        self.known = Known()
        self.alphabet = "".join(sorted(alphabet := byte_alphabet(), key=alphabet.__getitem__))
        self.newline = self.alphabet[ord("\n")]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text. Pieces are looked up once; the library's model then merges the new ones of all texts."""
        get, out = self.known.__getitem__, []
        for text in texts:
            parts: list[bytes | bytearray] = []
            for pieces, special in self.bpe.pieces(text):
                parts += map(get, pieces)
                if special is not None:
                    parts.append(np.array([special], "<u4").tobytes())
            out.append(parts)
        self._fill()
        return [np.frombuffer(b"".join(parts), "<u4") for parts in out]

    def _fill(self) -> None:
        known, new = self.known, self.known.new
        if new:
            pieces = [*new]
            made = [x for k in range(0, len(pieces), LINES) for x in self._lines(pieces[k : k + LINES])]
            for place, ids in zip(new.values(), made, strict=True):
                place += ids
            known.update(zip(pieces, made, strict=True))
            for p in pieces:
                if len(p) > SHORT:
                    del known[p]
            known.new = {}
        if len(known) > REMEMBER:
            known.turn()

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces from the library's model, which takes them in the printable characters that stand for bytes.

        They are turned into these as the lines of one text, or one by one if a piece has line ends of its own.
        """
        lines = self._printable("\n".join(pieces)).split(self.newline)
        if len(lines) != len(pieces):
            lines = map(self._printable, pieces)
        return [array("I", map(_id, self.merged(x))).tobytes() for x in lines]

    def _printable(self, text: str) -> str:
        return charmap_decode(text.encode(), "strict", self.alphabet)[0]

    def in_turn(self, texts: list[str], room: int = 1 << 20) -> Iterator[np.ndarray]:
        """Ids of each text, so many texts at once as have about `room` characters."""
        a = 0
        while a < len(texts):
            b, left = a, room
            while b < len(texts) and (b == a or left > 0):
                left -= len(texts[b])
                b += 1
            yield from self.encode(texts[a:b])
            a = b


@lru_cache(2)
def library(path: str) -> Library:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    return Library(path)


def token_count(text: Column, path: str) -> Column:
    """Number of ids of a text; 0 for null."""

    @F.pandas_udf("long")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([len(x) for x in library(path).in_turn(texts.fillna("").tolist())], dtype="int64")

    return run(text)
