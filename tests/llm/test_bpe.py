import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from payx.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library(vocabulary):
    t = tokenizers.Tokenizer.from_file(vocabulary)
    t.no_truncation()
    t.no_padding()
    return t


def digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    said = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


def test_whole_table(spark, sf_dir, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op4_bpe(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digests(library, docs[r["doc_id"]])


def test_odd_texts(odd, pairs, vocabulary, library):
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(odd, vocabulary).collect()}
    assert got == {i: digests(library, t) for i, t in pairs}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    path = queries.vocabulary()
    ids = bpe.encode(path, text)[0]
    if not hasattr(test_any_text, "library"):
        test_any_text.library = tokenizers.Tokenizer.from_file(path)
    assert ids.tolist() == test_any_text.library.encode(text, add_special_tokens=False).ids
    assert bpe.load(path).decode(ids).decode() == text


def test_cuts_are_pairs_of_no_token(vocabulary):
    b = bpe.load(vocabulary)
    data = "xqzéñ漢".encode()
    parts = b.cut(data)
    assert b"".join(parts) == data and len(parts) > 1
    inside = {t[i : i + 2] for t in b.token for i in range(len(t) - 1)}
    assert all(p[-1:] + q[:1] not in inside for p, q in zip(parts, parts[1:]))


def test_stray_ids_decode_to_replacement_marks(vocabulary, library):
    ids = [i for i, t in enumerate(bpe.load(vocabulary).token) if t == b"\xc3"] + [64]
    assert bpe.load(vocabulary).decode(np.array(ids)).decode() == library.decode(ids)


def test_frames_of_ids(odd, vocabulary, pairs):
    tokens = bpe.encoded(odd, vocabulary)
    assert {r["doc_id"]: r["text"] for r in bpe.decoded(tokens, vocabulary).collect()} == {i: t or "" for i, t in pairs}


def test_empty_and_repeated(empty, repeated, vocabulary):
    assert bpe.round_trip(empty, vocabulary).count() == 0
    assert bpe.round_trip(repeated, vocabulary).count() == repeated.count()


def test_latin_pattern_is_the_pattern_below_its_bound():
    for c in map(chr, range(0x250)):
        for text in (c, f"a{c}b", f" {c} ", f"'{c}s", f"1{c}2", f"{c}{c}'ll  x"):
            assert bpe.split(text) == bpe._any_pieces(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "-" * 100_000, " " * 100_000, "ab" * 60_000, "xyzé" * 20_000, "0" * 90_000])
def test_long_repeats(vocabulary, library, text):
    assert bpe.encode(vocabulary, text)[0].tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text("abcthenig", min_size=1, max_size=64))
def test_both_ways_of_merging(text):
    b = bpe.load(queries.vocabulary())
    data = text.encode()[: bpe.LONG_FRAGMENT]
    assert b.merged_long(data) == b.merged(data)
