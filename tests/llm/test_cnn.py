import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from payx.llm import cnn, queries
from payx.llm.kernels import utf8_batches


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op5_cnn(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert np.mean([b == 0 for a, b in held if a == 0]) > 0.8


def test_features_against_plain_loops():
    net = cnn.Net(3)
    texts = ["", "short", "x" * 255, "y" * 256, "z" * 257, "abc " * 400]
    column = pa.array(texts)
    got = np.concatenate([net.features(d, o, net.pairs()) for _, d, o in utf8_batches(column)])
    for row, text in zip(got, texts, strict=True):
        data = text.encode()
        starts = [0]
        while starts[-1] + cnn.CHUNK < len(data):
            starts.append(starts[-1] + cnn.STRIDE)
        padded = np.frombuffer(data + b"\0" * (cnn.CHUNK + cnn.WIDTH), np.uint8)
        sums, fill = np.zeros(cnn.FILTERS), 0.0
        for s in starts:
            e = max(min(s + cnn.CHUNK, len(data)), s + 1)
            act = np.max([sum(net.p[0][j][padded[i + j]] for j in range(cnn.WIDTH)) for i in range(s, e)], axis=0)
            sums += np.maximum(act + net.p[1], 0)
            fill += (e - s) / cnn.CHUNK
        assert np.allclose(row, np.append(sums, fill) / len(starts), atol=1e-4)


def test_odd_texts(odd, spark):
    net = cnn.Net()
    got = odd.select("doc_id", cnn.score(F.col("text"), net).alias("s")).collect()
    assert len(got) == odd.count() and all(0 <= r["s"] <= 1 for r in got)


def test_one_label_or_none_gives_the_known_share(spark, odd):
    rows = lambda q: spark.createDataFrame([(0, "a", None), (1, "b", q), (2, None, q)], "doc_id long, text string, quality int")
    assert (cnn.learn(rows(None)), cnn.learn(rows(1)), cnn.learn(rows(0))) == (None, 1.0, 0.0)
    for net, want in ((None, 0.5), (1.0, 1.0), (0.0, 0.0)):
        assert {r[0] for r in odd.select(cnn.score(F.col("text"), net)).collect()} == {want}


def test_learning_draws_the_same_rows_in_any_order(spark):
    rows = [(i % 50, f"text {i} " * (1 + i % 7), i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    a, b = cnn.learn(df, 20), cnn.learn(df.orderBy(F.desc("text")).repartition(5), 20)
    assert all((x == y).all() for x, y in zip(a.p, b.p)) and (a.slope, a.shift) == (b.slope, b.shift)


def test_training_with_null_and_empty_texts(spark):
    rows = [(i, "*** ### !!!" * 9 if i % 2 else "a plain line of text. " * 9, 1 - i % 2) for i in range(40)] + [(90, None, 0), (91, "", 1), (92, "x", 7)]
    net = cnn.learn(spark.createDataFrame(rows, "doc_id long, text string, quality int"))
    df = spark.createDataFrame([(1, "a plain line of text. " * 20), (2, "*** ### !!!" * 20)], "doc_id long, text string")
    a, b = (r[0] for r in df.orderBy("doc_id").select(cnn.score(F.col("text"), net)).collect())
    assert a > 0.5 > b
