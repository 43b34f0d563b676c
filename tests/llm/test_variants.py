import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from payx.llm import queries, variants
from tests.llm.brute import lower

RUN = re.compile("[a-zÀ-ÿ]+")


def near(a, b):
    """Whether exactly one code point inserted, deleted or replaced makes b of a."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts):
    """{word: n} -> {word: (form, root, n, n_near, form_n)}"""
    out = {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        ok = best is not None and counts[best] >= 10 * n
        out[w] = (best if ok else None, n, len(others), counts[best] if ok else None)

    def root(w):
        return root(out[w][0]) if out[w][0] else w

    return {w: (f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


def counted(docs):
    c = Counter()
    for i, text in docs:
        for run in RUN.findall(lower(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            c[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def got(df):
    assert sorted(df.columns) == ["form", "form_n", "n", "n_near", "root", "word"]
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def vocabulary(n, letters, seed):
    """Words with many near ones, runs of one letter among them."""
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(7, 10))) for _ in range(n)}
    for w in list(words)[: n // 2]:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]}
    return sorted(w for w in words if len(w) >= 7)


@pytest.mark.parametrize(("letters", "n"), [("ab", 60), ("abcd", 150), ("aéÿz", 150), ("abcdefghijklmnopqrstuvwxyz", 80)])
def test_searches_find_what_shares_a_half(letters, n):
    words = vocabulary(n, letters, n)
    index = variants.Index(words)
    q = np.arange(len(words))
    for first in (True, False):
        own, found = index.near(q, first)
        same = lambda a, b: a[: len(a) // 2] == b[: len(a) // 2] if first else b.endswith(a[len(a) // 2 :])
        assert set(zip(own.tolist(), found.tolist(), strict=True)) == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if near(a, b) and same(a, b)}
        assert len(own) == len(set(zip(own.tolist(), found.tolist(), strict=True)))


def test_rotations_and_ranks():
    rng = np.random.default_rng(1)
    codes = np.append(rng.integers(1, 4, 200), 0)
    order = variants.rotations(codes, 2)
    ring = codes.tolist()
    assert order.tolist() == sorted(range(201), key=lambda i: ring[i:] + ring[:i])
    w = variants.Wavelet(codes, 2)
    for lo, hi in [(0, 201), (5, 5), (17, 120)]:
        for c in range(4):
            a = w.one(np.array([c]), np.array([lo]), np.array([hi]))
            assert [int(x[0]) for x in a] == [ring[:lo].count(c), ring[lo:hi].count(c), sum(x < c for x in ring[lo:hi])]
        own, c, before, n, less = w.every(np.array([lo]), np.array([hi]))
        assert sorted(zip(c.tolist(), before.tolist(), n.tolist(), less.tolist(), strict=True)) == [(x, ring[:lo].count(x), ring[lo:hi].count(x), sum(y < x for y in ring[lo:hi])) for x in sorted(set(ring[lo:hi]))]


@pytest.mark.parametrize(("shard", "cap"), [(40_000, 40_000), (50, 40), (10, 3)])
def test_groups_equal_brute_force(spark, shard, cap):
    rng = random.Random(2)
    counts = {w: rng.choice([2, 3, 25, 40, 300, 5000]) for w in vocabulary(150, "abcé", 4)}
    counts |= {"x" * k: 2 + k for k in (7, 8, 9, 700, 701)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert got(variants.grouped(df, shard=shard, cap=cap)) == brute(counts)


def test_texts(spark, odd, pairs, repeated, empty):
    assert got(variants.spelled(odd)) == brute(counted(pairs))
    assert got(variants.spelled(repeated)) == brute(counted([tuple(r) for r in repeated.select("doc_id", "text").collect()]))
    assert got(variants.spelled(empty)) == {}
    words = ["Straßen-Überquerung", "receive recieve RECEIVE receives", "ÀÉÎabcd ÀÉÎabcd Àéîabcd", "receive " * 40]
    docs = [(i, words[i % 4]) for i in range(200)]
    assert got(variants.spelled(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(counted(docs))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf_dir, size):
    sf = os.path.join(os.path.dirname(sf_dir), size)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(queries.oracle_sql()["op12_variants"])
    rows = [dict(zip(want.columns, r, strict=True)) for r in want.fetchall()]
    assert got(queries.op12_variants(spark, sf)) == {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
