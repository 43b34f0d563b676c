import random

import pytest
from pyspark.sql import functions as F

from payx.llm import bottomk, queries
from payx.llm.common import salted
from tests.llm import brute


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_whole_table(spark, sf_dir, width, percent):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute.near_duplicates([(r["doc_id"], r["text"]) for r in docs.collect()], width, percent)
    df = bottomk.near_duplicates(docs, width, percent)
    assert got(df) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in df.collect())


def family(rng, words, copies, edits, first):
    """A text and copies with words replaced, each made from an earlier one, so that links form chains."""
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(words)]
    made = [base]
    for _ in range(copies):
        x = list(rng.choice(made))
        for _ in range(rng.randint(0, edits)):
            x[rng.randrange(len(x))] = f"n{rng.randint(0, 10**6)}"
        made.append(x)
    return [(first + i, " ".join(x)) for i, x in enumerate(made)]


def test_large_groups_take_the_block_path(spark):
    rng = random.Random(8)
    docs = family(rng, 90, 420, 3, 0) + family(rng, 300, 60, 9, 1000) + family(rng, 12, 40, 1, 2000)
    passage = " ".join(f"p{i}" for i in range(80))
    docs += [(5000 + i, passage + " " + " ".join(f"q{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 40)))) for i in range(200)]
    docs += [(9000 + i, docs[0][1]) for i in range(300)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert got(bottomk.near_duplicates(df, 3, 85)) == brute.near_duplicates(docs, 3, 85)


def test_odd_texts(odd, pairs):
    assert got(bottomk.near_duplicates(odd, 3, 85)) == brute.near_duplicates(pairs, 3, 85)


def test_repeated_rows_and_missing_ids(repeated):
    rows = bottomk.near_duplicates(repeated, 3, 85).collect()
    assert len(rows) == repeated.count()
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] == 3} == {3}


def test_empty_table(empty):
    assert bottomk.near_duplicates(empty).count() == 0


def test_case_is_folded_for_ascii_only(spark):
    df = spark.createDataFrame([(1, "Ab Cd EF"), (2, "ab cD ef"), (3, "É b c"), (4, "é b c")], "doc_id long, text string")
    assert got(bottomk.near_duplicates(df, 3, 85)) == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 4)}


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7)]
    rows = bottomk.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in rows} == {i: 1 for i in range(2, 41)} | {x: 100 for x in range(101, 160)}


def test_query_has_one_row_for_each_document(spark, sf_dir):
    df = queries.op7_near_dedup(spark, sf_dir)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"] and df.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()


def test_joins_of_a_key_with_most_rows(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("k"), "id")
    right = spark.createDataFrame([(i, i * 2) for i in range(-1, 3000, 2)], "k long, x long")
    counts = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for how in ("inner", "left"):
        want = left.join(right, "k", how)
        got = salted(left, right, "k", "id", counts, 3000, how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    assert "__salt" in got._jdf.queryExecution().toString()


def test_smallest_overlaps_of_true_links():
    for percent in (80, 85):
        f = bottomk.floors(percent, 64)
        assert all(100 * f[u] >= percent * u > 100 * (f[u] - 1) for u in range(1, 64))
        assert all(a <= b for a, b in zip(f[64:], f[65:])) and f[64] > 20


def test_many_different_texts_with_one_passage(spark):
    """A passage that 3,000 texts share makes no list of all of them, whether it is a small or a large part of each."""
    rng = random.Random(1)
    passage = " ".join(f"p{i}" for i in range(60))
    word = lambda: f"q{rng.randint(0, 10**7)}"
    docs = [(i, passage + " " + " ".join(word() for _ in range(90 if i % 2 else 30))) for i in range(3000)]
    docs += [(5000 + i, docs[i][1] + " end") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    components = {i: c for i, (_, c) in got(bottomk.near_duplicates(df, 3, 85)).items()}
    assert components == {i: i if i < 5000 else i - 5000 for i, _ in docs}
