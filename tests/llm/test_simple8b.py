import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from payx.llm import queries, simple8b
from payx.llm.tokens import library
from tests.llm import brute

tokenizers = pytest.importorskip("tokenizers")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60_000), st.integers(0, 2**64 - 1)), max_size=400))
def test_round_trip(ids):
    ids = np.array(ids, np.uint64)
    assert (simple8b.unpack(simple8b.pack(ids)) == ids).all()


def test_runs_of_zeros_and_escapes():
    ids = np.array([0] * 500 + [2**63] * 3 + [7] + [2**64 - 1] + [0] * 121, np.uint64)
    words = simple8b.pack(ids)
    assert len(words) < 40 and (simple8b.unpack(words) == ids).all()


def test_small_ids_take_few_words():
    ids = np.arange(4000, dtype=np.uint64) % np.uint64(50_000)
    assert len(simple8b.pack(ids)) <= 4000 / 5 + 1


def test_records_cut_documents_anywhere_and_blocks_decode_alone():
    docs = [(5, np.arange(10)), (None, np.empty(0, int)), (7, np.arange(33)), (9, np.arange(4))]
    got = list(simple8b.segments(((d, x.astype(np.uint32)) for d, x in docs), 3, block=4, most=2))
    content = b"".join(v + b"\n" for v in got)
    ids, ends, every = {}, set(), []
    for number, record, before, table, parts, words in simple8b.records(content):
        values = simple8b.decoded(table, words)
        assert number == 3 and before == len(every) and len(table) <= 2
        assert values.tolist() == [x for i in range(len(table)) for x in simple8b.decoded(table, words, i).tolist()]
        every += values.tolist()
        at = 0
        for p in parts:
            ids.setdefault(int(p["place"]), []).extend(values[at : at + p["ids"]].tolist())
            at += int(p["ids"])
            if p["flags"] & 2:
                ends.add(int(p["place"]))
    assert ids == {0: list(range(10)), 1: [], 2: list(range(33)), 3: list(range(4))} and ends == set(ids)


def test_checksums_of_parts_join():
    for n, m in ((0, 0), (0, 5), (7, 0), (400, 4), (3, 5000)):
        a, b = bytes(range(256)) * 2, bytes(reversed(range(256))) * 20
        a, b = a[:n], b[:m]
        assert simple8b.joined_crc(zlib.crc32(a), zlib.crc32(b), m) == zlib.crc32(a + b)


@pytest.fixture(scope="module")
def encode(vocabulary):
    t = tokenizers.Tokenizer.from_file(vocabulary)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def got(df):
    return {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in df.collect()}


def test_whole_table(spark, sf_dir, encode):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got(queries.op10_simple8b(spark, sf_dir)) == brute.id_index(docs, encode)


def test_odd_texts(odd, pairs, vocabulary, encode):
    assert got(simple8b.document_index(odd, vocabulary)) == brute.id_index(pairs, encode)


def test_many_ranges_records_and_files(spark, vocabulary, encode):
    docs = [(i * 7 - 300, "word " * (i % 5)) for i in range(200)] + [(2000, "long text, " * 300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    path = simple8b.write(df, vocabulary, rows_per_range=20, block=16, segment=2, file_records=3)
    rows = simple8b.read(spark, path).orderBy("range", "place").collect()
    assert [r["doc_id"] for r in rows] == sorted(i for i, _ in docs) and len({r["range"] for r in rows}) > 5
    want = brute.id_index(docs, encode)
    assert {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in rows} == {i: x[1:] for i, x in want.items()}
    base = {}
    for r in rows:
        base.setdefault(r["range"], want[r["doc_id"]][0])
        assert r["start"] + base[r["range"]] == want[r["doc_id"]][0]


def test_one_id_is_dealt_to_many_ranges(spark, vocabulary):
    df = spark.createDataFrame([(7 if i % 3 else None, f"text {i}") for i in range(400)], "doc_id long, text string").repartition(4)
    rows = simple8b.read(spark, simple8b.write(df, vocabulary, rows_per_range=40)).collect()
    assert len(rows) == 400 and len({r["range"] for r in rows if r["doc_id"] == 7}) > 2


def test_pieces_are_those_of_the_library_for_every_kind_of_character(vocabulary, encode):
    by: dict[str, list[str]] = {}
    for c in range(0x30000):
        if not 0xD800 <= c < 0xE000:
            by.setdefault(unicodedata.category(chr(c)), []).append(chr(c))
    known = library(vocabulary)
    for kind, chars in by.items():
        some = chars[:: max(1, len(chars) // 40)]
        texts = ["".join(f"a{c}1 {c}b{c}{c} '{c}s  {c}\n" for c in some), "".join(some), " ".join(some)]
        for text, ids in zip(texts, known.encode(texts)):
            assert ids.tolist() == encode(text), kind


def test_repeated_rows_missing_ids_and_no_rows(repeated, empty, vocabulary):
    rows = simple8b.document_index(repeated, vocabulary).collect()
    starts = sorted((r["start"], r["n_tokens"]) for r in rows)
    assert len(rows) == repeated.count() and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert simple8b.document_index(empty, vocabulary).count() == 0
