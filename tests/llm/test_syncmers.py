from collections import Counter

import numpy as np

from payx.llm import queries, syncmers
from tests.llm import brute


def sketch(text):
    return syncmers.sketch(syncmers.syncmers(text)[1])


def check(rows, docs):
    want = brute.edited(docs)
    texts = dict(docs)
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        n, sha, edited, following = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        own, other, after = (sketch(t) for t in (texts[r["doc_id"]], edited, texts[following]))
        assert r["fingerprint"] == syncmers.fingerprint(own) and r["edited_fingerprint"] == syncmers.fingerprint(other)
        assert r["near_edited"] == syncmers.likeness(own, other) and r["near_next"] == syncmers.likeness(own, after)
        full = [syncmers.syncmers(t) for t in (texts[r["doc_id"]], edited, texts[following])]
        assert (r["aligned_edited"], r["aligned_next"]) == (plain_aligned(full[0], full[1]), plain_aligned(full[0], full[2]))


def plain_aligned(a, b):
    """Share of a's anchors that b has at one displacement, by loops."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    first, other = {}, {}
    for places, (at, h) in ((first, a), (other, b)):
        for p, x in zip(at.tolist(), h.tolist()):
            places.setdefault(x, p)
    moved = Counter(other[x] - first[x] for x in first if x in other)
    return max(moved.values(), default=0) / len(first)


def test_whole_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(queries.op1_syncmers(spark, sf_dir).collect(), docs)


def test_odd_texts_over_many_ranges(odd, pairs):
    check(syncmers.edited_fingerprints(odd, rows_per_range=2).collect(), pairs)


def test_repeated_rows_and_missing_ids(repeated):
    assert syncmers.edited_fingerprints(repeated, rows_per_range=2).count() == repeated.count()


def test_empty_table(empty):
    assert syncmers.edited_fingerprints(empty).count() == 0


def test_closed_syncmers_against_the_definition():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcd"), 400))
    codes = syncmers.mix(np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1))
    inner = syncmers._grams(codes, syncmers.S)
    want = []
    for i in range(len(text) - syncmers.K + 1):
        part = inner[i : i + syncmers.K - syncmers.S + 1]
        if part[0] == part.min() or part[-1] == part.min():
            want.append(i)
    assert syncmers.syncmers(text)[0].tolist() == want
    # Free of context: the same passage selects the same anchors wherever it stands.
    at, h = syncmers.syncmers("zz" + text)
    assert set(zip(np.array(want) + 2, syncmers.syncmers(text)[1])) <= set(zip(at, h))


def test_anchors_have_places(odd):
    got = syncmers.anchors(odd.where("doc_id = 33")).collect()
    assert {r["place"] for r in got} == set(syncmers.syncmers("the quick brown fox jumps over the lazy dog. " * 3)[0].tolist())


def test_likeness_follows_resemblance():
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abcdefghij "), 3000))
    assert syncmers.likeness(sketch(text), sketch(text)) == 1
    part = syncmers.likeness(sketch(text), sketch(text[:2000] + "".join(rng.choice(list("klmnop "), 1000))))
    assert 0.35 < part < 0.65
    assert syncmers.likeness(sketch(text), sketch("".join(rng.choice(list("klmnop "), 3000)))) == 0


def test_long_texts_keep_a_share_of_their_anchors():
    rng = np.random.default_rng(3)
    text = "".join(rng.choice(list("abcdefghij "), 200_000))
    values, every = sketch(text), np.unique(syncmers.syncmers(text)[1])
    assert 0.1 < len(values) / len(every) < 0.15
    half = text[:100_000] + "".join(rng.choice(list("klmnop "), 100_000))
    assert abs(syncmers.likeness(values, sketch(half)) - 1 / 3) < 0.02


def test_a_moved_passage_is_aligned():
    rng = np.random.default_rng(4)
    make = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    passage = make(1500)
    a, b = passage + make(1500), make(777) + passage + make(200)
    share, shift = syncmers.aligned(syncmers.syncmers(a), syncmers.syncmers(b))
    assert shift == 777 and 0.4 < share < 0.6
    assert syncmers.aligned(syncmers.syncmers(a), syncmers.syncmers(make(3000)))[0] == 0
