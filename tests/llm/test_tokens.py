import random

import numpy as np
import public_tokenizers
import pytest

from payx.llm import bpe, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["'s", "'", " '", "'ll", "é", "é", "́", " ́x", "中文", " 中", "​", "\x1c", "\x85", "\xa0", " ", "﻿", "\x00", "𝒳", "!?\x7f", "Ċ", "a" * 300, "½", "<|", "|>"]
SPACES = ["\n", " ", "  ", "\r\n", "\t", "\n\n", " \n", "　"]


class Counting:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **more):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **more)


def whole(library, texts):
    return [e.ids for e in library.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


def test_new_pieces_go_to_the_library_as_lines():
    library = tokens.Library(PATH)
    want = whole(library, texts := [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(10)])
    library.tokenizer = Counting(library.tokenizer)
    assert [x.tolist() for x in library.encode(texts)] == want
    assert library.tokenizer.texts < 20  # not one for each of the pieces


@pytest.mark.parametrize("lines", [1, 3, 1000])
def test_odd_pieces_keep_their_ids(monkeypatch, lines):
    monkeypatch.setattr(tokens, "LINES", lines)
    rng = random.Random(7)
    texts = ["".join(rng.choices(ODD + SPACES + [" the", "x", "<|endoftext|>"], k=rng.randrange(30))) for _ in range(400)]
    library = tokens.Library(PATH)
    want = whole(library, texts)
    for _ in range(2):
        assert [x.tolist() for x in library.in_turn(texts, 500)] == want
    pieces = [p for t in texts for p in bpe.split(t)]
    assert [np.frombuffer(x, "<u4").tolist() for x in library._lines(pieces)] == whole(library, pieces)


def test_remembered_pieces_are_forgotten_in_turn(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 50)
    library = tokens.Library(PATH)
    texts = [" ".join(f"{i % 7}a{j}" for j in range(40)) for i in range(60)]
    assert [x.tolist() for x in library.in_turn(texts, 200)] == whole(library, texts)
    assert len(library.known) + len(library.known.old) < 300 and not library.known.new


def test_new_pieces_skip_the_library_s_own_cutting():
    library = tokens.Library(PATH)
    texts = [" ".join(f"w{i}x{j}" for j in range(300)) + "\r\n\n é中" for i in range(10)]
    want = whole(library, texts)
    library.tokenizer = Counting(library.tokenizer)
    assert [x.tolist() for x in library.encode(texts)] == want
    assert library.tokenizer.texts == 0  # cut once already; to be cut again took more than to merge
