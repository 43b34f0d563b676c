"""The pipeline against plain stages: decisions of each stage recomputed from what it was given."""

import corpus_pipeline
from pyspark.sql import functions as F

from payx.llm import langid
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("quality_score", F.lit("clash")).withColumn("language", F.lit("clash")).persist()
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    stages = dict(corpus_pipeline.STAGES)

    first = stages["language_id"](spark, docs, SF).persist()
    samples = langid.learn(docs.select("doc_id", "text", "lang"))
    parser = langid.Parser(samples)
    texts = {r["doc_id"]: langid.normal(r["text"]) for r in docs.collect()}
    n = parser.phrases(list(texts.values()))
    want = {i for (i, t), k in zip(texts.items(), n) if t and (k.min() - 1) / len(t) <= samples[k.argmin()].limit}
    assert first.columns == docs.columns and {r["doc_id"] for r in first.collect()} == want
    assert len(want) > 0.99 * len(texts)

    second = stages["quality"](spark, first, SF).persist()
    kept = {r["doc_id"] for r in second.collect()}
    clean = {i for i in want if quality.get(i) == 1}
    junk = {i for i in want if quality.get(i) == 0}
    assert second.columns == docs.columns and len(clean & kept) >= 0.98 * len(clean) and len(junk & kept) <= 0.15 * len(junk)

    third = stages["near_dedup"](spark, second, SF).persist()
    groups = brute.near_duplicates([(r["doc_id"], r["text"]) for r in second.collect()], 5, 80)
    assert third.columns == docs.columns and {r["doc_id"] for r in third.collect()} == {i for i, (_, c) in groups.items() if i == c}

    last = stages["packing"](spark, third, SF)
    assert {r["doc_id"] for r in last.collect()} == {r["doc_id"] for r in third.collect()}


def test_odd_tables(spark):
    rows = [(1, None, None), (2, "", "en"), (3, "some plain words here", "en"), (3, "some plain words here", "en"), (None, "encore des mots", "fr"), (5, "123", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"source": F.lit("s"), "n_chars": F.lit(1).cast("long")})
    for table in (docs, docs.limit(0)):
        x = table
        for _, stage in corpus_pipeline.STAGES:
            x = stage(spark, x, SF)
        assert x.count() <= table.count()


def test_run_is_the_stages_in_turn(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_repeated_rows_and_missing_ids_leave_one_of_each_group(spark):
    text, other, third = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(None, text), (7, text), (7, text), (5, text), (9, other), (9, other), (None, third), (None, third), (None, None), (None, None), (1, "x y z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF)
    assert got.columns == docs.columns
    want = [(5, text), (9, other), (None, third), (None, None), (None, None), (1, "x y z")]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
