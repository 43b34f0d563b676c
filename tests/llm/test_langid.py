import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from payx.llm import langid, queries


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op8_langid(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in rows if r["held_out"]]) > 0.97


def phrases(sample, text):
    """Greedy longest matches, by substring search."""
    n = i = 0
    while i < len(text):
        j = i + 1
        while j <= len(text) and text[i:j] in sample:
            j += 1
        n, i = n + 1, max(i + 1, j - 1)
    return n


def test_parser_against_substring_search():
    rng = random.Random(2)
    samples = tuple(langid.Sample(f"l{k}", "".join(rng.choice("abcd ") for _ in range(400))) for k in range(3))
    texts = ["".join(rng.choice("abcdxé ") for _ in range(rng.randint(0, 1500))) for _ in range(30)]
    texts += ["a" * 2000, samples[0].text * 5, samples[1].text[100:] + samples[2].text * 3, "x" * 800, "ab" * 900]
    got = langid.Parser(samples).phrases(texts)
    for row, text in zip(got, texts, strict=True):
        assert row.tolist() == [phrases(s.text, text) for s in samples]


def test_a_very_long_text_is_parsed_as_one():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    sample = " ".join(rng.choice(words) for _ in range(2000))
    text = " ".join(rng.choice(words) for _ in range(20_000)) + sample * 3
    assert len(text) > 100_000
    assert langid.Parser((langid.Sample("x", sample),)).phrases([text])[0, 0] == phrases(sample, text)


def test_transitions_are_those_of_the_automaton():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnop 漢字") for _ in range(3000))
    go, code = langid.suffix_automaton(text), {c: i for i, c in enumerate(sorted(set(text)), 1)}
    place, table = langid.displaced(go, code)
    for s in range(1, len(go)):
        for c, k in code.items():
            e = int(table[place[s] + k])
            assert (e & 0xFFFFFFFF if e >> 32 == s else None) == go[s].get(c)


def test_seventy_languages(spark):
    rng = random.Random(4)
    rows = []
    for k in range(70):
        letters = [chr(0x4E00 + 40 * k + i) for i in range(40)]
        rows += [(k * 10 + i, "".join(rng.choice(letters) for _ in range(60)), f"l{k:02}") for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = langid.learn(df)
    assert [s.lang for s in samples] == sorted({r[2] for r in rows})
    got = df.select("lang", langid.judge(F.col("text"), samples).alias("l")).collect()
    assert all(r["lang"] == r["l"]["lang_pred"] for r in got)


SAMPLES = (langid.Sample("x", "abc abd abe cab dab"), langid.Sample("y", "mno mnp mnq omn pmn"))


def test_odd_texts(odd):
    rows = odd.select("text", langid.judge(F.col("text"), SAMPLES).alias("l")).collect()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["l"]["lang_pred"] == "und") == (not letters) and (letters or r["l"]["score"] == 0)


def test_nothing_learned(spark, odd):
    none = spark.createDataFrame([(1, "abc", None), (2, None, "x"), (3, "  ", "x")], "doc_id long, text string, lang string")
    assert langid.learn(none) == ()
    assert {r[0]["lang_pred"] for r in odd.select(langid.judge(F.col("text"), ())).collect()} == {"und"}


def test_learning_is_bounded_and_ignores_row_order(spark):
    rows = [(i, f"word{i % 7} " * 400, "x" if i % 2 else "y") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = langid.learn(df), langid.learn(df.orderBy(F.desc("doc_id")).repartition(5))
    assert a == b and [x.lang for x in a] == ["x", "y"] and all(len(x.text) <= langid.DOCS * langid.PIECES * (langid.WIDTH + 1) for x in a)


def test_rejection(spark):
    df = spark.createDataFrame([(1, "abc abd abe"), (2, "123 !"), (3, "zzzz qqqq rrrr")], "doc_id long, text string")
    got = langid.identify(df, SAMPLES, "l").where(langid.accept("l")).collect()
    assert [r["doc_id"] for r in got] == [1]


def test_short_texts_are_not_rejected_for_their_length(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["a", "ab", "b", "no", "ca mn"])], "doc_id long, text string")
    assert langid.identify(df, SAMPLES, "l").where(langid.accept("l")).count() == 5


def test_one_id_of_many_texts_draws_no_more_rows(spark):
    df = spark.createDataFrame([(1, f"text number {i} of one id", "x") for i in range(500)] + [(2, "another", "x")], "doc_id long, text string, lang string")
    (sample,) = langid.learn(df)
    assert sample.text.count("number") <= langid.DOCS


def test_repeated_rows_missing_ids_and_no_rows(repeated, empty):
    assert langid.identify(repeated, SAMPLES).count() == repeated.count() and langid.identify(empty, SAMPLES).count() == 0


def test_marks_alone_are_no_letters():
    assert langid.normal("\u0301 \u0301") == "" and langid.normal("a\u0301!B") == "a\u0301 b"
