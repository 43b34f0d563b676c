import random

import duckdb
import pytest
from pyspark.sql import functions as F

from payx.llm import linerules, queries
from tests.llm import brute


def base(df):
    return {r["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in df.collect()}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = base(queries.op3_linerules(spark, sf_dir))
    assert got == {r["doc_id"]: brute.base_rules(r["text"]) for r in docs.collect()}


def test_odd_texts(odd, pairs):
    rows = linerules.filtered(odd)
    assert base(rows) == {i: brute.base_rules(t) for i, t in pairs}
    assert all(r["kept"] is not None for r in rows.collect())


def test_random_repeats(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice("ab" if i % 2 else "abcdef") for _ in range(rng.randint(0, 60))) + "\n" * (i % 3)) for i in range(300)]
    assert base(linerules.filtered(spark.createDataFrame(docs, "doc_id long, text string"))) == {i: brute.base_rules(t) for i, t in docs}


@pytest.mark.parametrize(
    ("line", "rule"),
    [("A sentence that ends.", None), ("A question?", None), ("Shout!", None), ("no end here", "punctuation"), ("LOUD!! WORDS!! ALL!! OVER!!", "punctuation"), ("a*** b### c$$$ d.", "punctuation"), ("one | two | three | four.", "navigation"), ("Home", "navigation"), ("All rights reserved.", "boilerplate"), ("Click here to go on.", "boilerplate"), ("Alle Rechte vorbehalten.", "boilerplate"), ("Zurück", "navigation"), ("» Plan du site «", "navigation"), ("See https://a.example/x https://b.example/y.", "links"), ("One link, https://a.example/x, in a long sentence of many words is no fault.", None), ("12 345 67 890 (x): 2345.", "numbers")],
)
def test_line_rules(spark, line, rule):
    assert spark.createDataFrame([(line,)], "x string").select(linerules.line_fails(F.col("x"))).first()[0] == rule


def test_lost_text_decides(spark):
    rng = random.Random(7)
    many = "\n".join(" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(12)) + "." for _ in range(9))
    bad = "\n".join(f"menu | item | number {i} | more | of | this" for i in range(30))
    df = linerules.filtered(spark.createDataFrame([(1, many), (2, many + "\n" + bad), (3, many + "\nmenu | a | b | c")], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in df.collect()}
    assert got[1]["kept"] and not got[2]["kept"] and got[3]["kept"]
    assert got[3]["cleaned"] == many and got[3]["chars_lost"] == 16


ENGLISH = "The lines of this paragraph were wrapped at seventy-two columns, as mails\nand many plain text books are, so that most of them have no mark of an\nend; a rule that looks at each line alone would take all but one of the\nlines for rubbish and throw the whole of the document away with them.\n"
SCRIPTS = {
    "Chinese": "\n".join(" ".join("学习 知识 世界 时间 语言".split()[(i * k + k) % 5] for k in range(19)) + f" 第{i}。" for i in range(20)),
    "Japanese": "\n".join(" ".join("これは 言葉 です から 本".split()[(i + k * k) % 5] for k in range(12)) + f" {i}番！" for i in range(9)),
    "Hindi": "\n".join(" ".join("यह एक वाक्य है और".split()[(i * 3 + k) % 5] for k in range(12)) + f" शब्द{i}।" for i in range(9)),
    "Arabic": "\n".join(" ".join("هذا نص طويل جدا هنا".split()[(i * 2 + k) % 5] for k in range(12)) + f" سؤال{i}؟" for i in range(9)),
    "Thai": "\n".join(" ".join("นี่ คือ ภาษา ไทย ครับ".split()[(i + k) % 5] for k in range(12)) + f" บท{i}" for i in range(9)),
    "wrapped": ENGLISH + "\n" + ENGLISH.replace("lines", "rows").replace("many", "most"),
}


@pytest.mark.parametrize("name", SCRIPTS)
def test_every_script_and_wrapped_prose_keep_their_lines(spark, name):
    text = SCRIPTS[name]
    r = linerules.filtered(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r["chars_lost"] == 0 and r["cleaned"] == "\n".join(x for x in text.split("\n") if x)
    assert r["kept"] == (not r["base_failed"])


def test_long_lines_without_an_end_are_lost_where_none_follows(spark):
    long = "these are words of a line that is long and has no end at all"
    cases = [(long, len(long)), (long + "\n\nAn end.", len(long)), (long + "\nHome\nAn end.", len(long) + 4), (long + "\n" + long + "\nAn end.", 0), (long + "\nshort\nAn end.", len(long) + 5), (("x" * 31 + "\n") * 200_000, 31 * 200_000)]
    df = linerules.filtered(spark.createDataFrame(list(enumerate(t for t, _ in cases)), "doc_id long, text string"))
    assert [r["chars_lost"] for r in df.orderBy("doc_id").collect()] == [n for _, n in cases]


def test_sql_on_wrapped_and_other_scripts(spark):
    docs = list(enumerate([*SCRIPTS.values(), ENGLISH * 2 + "Home\n" + ENGLISH[:140], "\n\n", ENGLISH.replace(".", "")]))
    con = duckdb.connect()
    con.sql("CREATE TABLE documents(doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    rel = con.sql(linerules.oracle())
    rows = linerules.filtered(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r[c] for c in rel.columns)) for r in rows)


def test_no_python_in_the_plan(spark, sf_dir):
    plan = linerules.filtered(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_empty_and_repeated(empty, repeated):
    assert linerules.filtered(empty).count() == 0
    assert linerules.filtered(repeated).count() == repeated.count()


def test_query_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    rel = con.sql(linerules.oracle())
    rows = queries.op3_linerules(spark, sf_dir).collect()
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r[c] for c in rel.columns)) for r in rows)
