import pytest
from pyspark.sql import functions as F

from payx.llm import queries

#: Texts with every odd case: null, empty, blanks, one character, ties, repeated rows, many alphabets, very long.
TEXTS = [None, "", " \n\t ", "a", "Ab", "a", "one two", "one two three", "ONE two three", "é漢字🙂 mixed <|endoftext|> text", "x" * 3000, "the quick brown fox jumps over the lazy dog. " * 3, "word " * 70_000, "\x00\x1c odd \x85 controls\r\n", None]


@pytest.fixture(scope="session")
def odd(spark):
    """(doc_id, text) with odd texts, and columns that have the names of results."""
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("score", "fingerprint", "n", "v", "rep", "bucket", "range", "kept", "length", "group", "language"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3).persist()


@pytest.fixture(scope="session")
def repeated(spark):
    """Repeated rows, an id with two texts and rows without an id."""
    a = "some words that are long enough to be a document of their own, with an end."
    return spark.createDataFrame([(1, a), (1, a), (2, a), (3, "other " * 30), (3, "third " * 30), (None, a), (None, None), (4, None)], "doc_id long, text string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture(scope="session")
def vocabulary():
    pytest.importorskip("public_tokenizers")
    return queries.vocabulary()


@pytest.fixture(scope="session")
def pairs(odd):
    return [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
