"""Byte-level BPE encoding with forced boundaries, and decoding.

A pair of bytes that no vocabulary token holds side by side can never end up in one token, so every such pair is a
certain cut: the fragments between cuts are merged one by one, independently, and their ids concatenated. Fragments
come from the pieces of the vocabulary's pre-tokenizer, and both are remembered in a bounded table, as most recur.

Null text counts as empty: no ids, empty decoded text. Repeated rows each have a row; other columns than doc_id and
text are ignored; no rows give none. Texts are encoded whole: a piece of n bytes takes n log n steps.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payx.llm.common import small_batches

# The pre-tokenizer pattern of the public byte-level vocabulary, with its white space written out.
_SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
# The same for texts of characters below U+0250, with their letters and numbers written out, for the faster `re`.
LATIN = r"A-Za-zªµºÀ-ÖØ-öø-ɏ"
NUMBERS = r"0-9²³¹¼½¾"
LATIN_PATTERN = rf"'(?:[stmd]|re|ve|ll)| ?[{LATIN}]+| ?[{NUMBERS}]+| ?[^{_SPACE}{LATIN}{NUMBERS}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
_beyond = re.compile("[^\x00-ɏ]").search
_latin_pieces, _any_pieces = re.compile(LATIN_PATTERN).findall, regex.compile(PATTERN).findall
#: Twice so many pieces or fragments are remembered at most, each of at most SHORT characters or bytes.
REMEMBER, SHORT = 250_000, 40
#: Longer fragments, such as runs of one letter, are merged with a heap.
LONG_FRAGMENT = 64


def split(text: str) -> list[str]:
    """The pre-tokenizer's pieces of a text."""
    return (_any_pieces if _beyond(text) else _latin_pieces)(text)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files: itself, or one from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Bpe:
    """The vocabulary of one tokenizer file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_alphabet()
        raw = lambda token: bytes(to_byte[c] for c in token)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        # A merge's rank and its token, in one number, by its two parts, in one number.
        self.merge: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            a, b = raw(a), raw(b)
            self.merge.setdefault(vocab[a] << 32 | vocab[b], rank << 32 | vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in vocab.items():
            self.token[i] = t
        for t, i in self.special.items():
            self.token[i] = t.encode()
        joined = np.zeros((256, 256), bool)
        for t in vocab:
            x = np.frombuffer(t, np.uint8)
            joined[x[:-1], x[1:]] = True
        self.joined = joined.tobytes()
        self.outer = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")").split if self.special else None
        self.fragments = Recent(self.merged)

    def cut(self, data: bytes) -> list[bytes]:
        """data at its forced boundaries."""
        joined = self.joined
        at = [i for i, (x, y) in enumerate(pairwise(data), 1) if not joined[x << 8 | y]]
        return [data[i:j] for i, j in pairwise([0, *at, len(data)])] if at else [data]

    def merged(self, data: bytes) -> list[int]:
        """The ids of one fragment: the earliest merge first, leftmost among equals."""
        if len(data) > LONG_FRAGMENT:
            return self.merged_long(data)
        ids = [self.byte_id[b] for b in data]
        get = self.merge.get
        never = 1 << 62
        pairs = [get(a << 32 | b, never) for a, b in pairwise(ids)]
        while pairs and (best := min(pairs)) != never:
            i = pairs.index(best)
            ids[i] = new = best & 0xFFFFFFFF
            del ids[i + 1], pairs[i]
            if i:
                pairs[i - 1] = get(ids[i - 1] << 32 | new, never)
            if i < len(pairs):
                pairs[i] = get(new << 32 | ids[i + 1], never)
        return ids

    def merged_long(self, data: bytes) -> list[int]:
        """The same for a fragment of any length, in n log n steps: a heap of pairs over a linked list of parts."""
        ids: list[int | None] = [self.byte_id[b] for b in data]
        n, get = len(ids), self.merge.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # A pair's rank with its place, in one number; the token it makes is looked up again when it is taken.
        heap = [(m >> 32) * n + i for i, m in enumerate(get(a << 32 | b) for a, b in pairwise(ids)) if m is not None]
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), n)
            j = after[i]
            if ids[i] is None or j == n or (m := get(ids[i] << 32 | ids[j])) is None or m >> 32 != rank:
                continue  # one of the two has been merged since
            ids[i], ids[j] = m & 0xFFFFFFFF, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := get(ids[i] << 32 | ids[k])) is not None:
                    heappush(heap, (m >> 32) * n + i)
            if (h := before[i]) >= 0 and (m := get(ids[h] << 32 | ids[i])) is not None:
                heappush(heap, (m >> 32) * n + h)
        return [i for i in ids if i is not None]

    def encode_piece(self, piece: str) -> list[int]:
        parts = self.cut(piece.encode())
        if len(parts) == 1:
            return self.merged(parts[0])
        known, out = self.fragments, []
        for part in parts:
            out += known[part]
        return out

    def pieces(self, text: str) -> Iterator[tuple[list[str], int | None]]:
        """Runs of pre-tokenizer pieces, each with the special token after it."""
        if self.outer is None or not any(t in text for t in self.special):
            yield split(text), None
            return
        parts = self.outer(text)
        for i in range(0, len(parts), 2):
            yield split(parts[i]), self.special[parts[i + 1]] if i + 1 < len(parts) else None

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids in UTF-8, invalid bytes replaced; special tokens are written out."""
        raw = b"".join(map(self.token.__getitem__, ids.tolist()))
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()


@lru_cache(2)
def load(path: str) -> Bpe:
    return Bpe(path)


class Recent(dict):
    """Remembers what `make` gives for keys of at most SHORT characters, those used last: between REMEMBER and twice that.

    When it is full, what it holds becomes the older half, and what the older half held before is forgotten.
    """

    def __init__(self, make: Callable):
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= SHORT:
            if len(self) >= REMEMBER:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


@lru_cache(2)
def _pieces(path: str) -> Recent:
    """piece -> (its ids as little-endian 32-bit integers, the same in decimal with commas)."""
    encode_piece = load(path).encode_piece

    def make(piece: str) -> tuple[bytes, str]:
        ids = encode_piece(piece)
        return array("I", ids).tobytes(), ",".join(map(str, ids))

    return Recent(make)


def encode(path: str, text: str | None) -> tuple[np.ndarray, str]:
    """(ids, the ids in decimal joined by commas) of one text."""
    bpe, known = load(path), _pieces(path)
    raw, said = [], []
    for run, special in bpe.pieces(text or ""):
        got = [known[p] for p in run]
        raw += [x[0] for x in got]
        said += [x[1] for x in got]
        if special is not None:
            raw.append(np.array([special], "<u4").tobytes())
            said.append(str(special))
    return np.frombuffer(b"".join(raw), "<u4"), ",".join(said)


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids of every row."""

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([encode(path, t)[0].astype(np.int32) for t in texts])

    return docs.select("doc_id", run(F.col("text")).alias("ids"))


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, text of every row of (doc_id, ids); null for null ids."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        return pd.Series([load(path).decode(np.asarray(x, np.int64)).decode() if x is not None else None for x in ids])

    return tokens.select("doc_id", run(F.col("ids")).alias("text"))


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: encoded, then decoded from the ids."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(path)
        for texts in parts:
            n, ids_sha, text_sha = [], [], []
            for text in texts:
                ids, said = encode(path, text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(said.encode()).hexdigest())
                text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pd.DataFrame({"n_tokens": np.array(n, np.int64), "ids_sha256": ids_sha, "decoded_sha256": text_sha})

    return small_batches(docs).select("doc_id", run(F.col("text")).alias("r")).select("doc_id", "r.*")
