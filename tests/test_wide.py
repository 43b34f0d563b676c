"""Numbers of up to 256 bits against Python's."""

import random

from pyspark.sql import functions as F

from payx.functions import wide
from payx.operators import cube


def test_words_sums_and_order(spark):
    rng = random.Random(2)
    numbers = [0, 1, 10**9 - 1, 10**9, 10**18, 2**64, 10**38, 2**255 - 1, 2**255, 2**256 - 1, *[rng.getrandbits(rng.randrange(1, 257)) for _ in range(200)]]
    df = spark.createDataFrame([(i % 7, f"{n:064x}", str(n)) for i, n in enumerate(numbers)], "k int, w string, n string").withColumn("v", wide.from_word("w")).repartition(5)
    rows = df.select("n", wide.digits(F.col("v")).alias("d"), wide.text(wide.digits(F.col("v"))).alias("t"), wide.text(wide.digits(F.col("v")), 6).alias("p")).collect()
    assert all(r["t"] == r["n"] for r in rows)
    assert [r["n"] for r in sorted(rows, key=lambda r: r["d"])] == [str(n) for n in sorted(numbers)]
    assert all(r["p"] == f"{int(r['n']) // 10**6}.{int(r['n']) % 10**6:06d}" for r in rows)
    sums = df.groupBy("k").agg(*wide.limb_sums("v")).select("k", wide.text(wide.digits(wide.total("v"))).alias("t"))
    assert {r["k"]: int(r["t"]) for r in sums.collect()} == {k: sum(numbers[k::7]) for k in range(7)}


def test_many_of_the_largest(spark):
    df = spark.range(3000).select(F.lit("f" * 64).alias("w")).withColumn("v", wide.from_word("w"))
    assert df.agg(*wide.limb_sums("v")).select(wide.text(wide.digits(wide.total("v")))).first()[0] == str(3000 * (2**256 - 1))


def test_short_numbers_and_others(spark):
    numbers = [0, 7, 999_999_999, 10**9, 10**18 - 1, 123_456_789_012_345_678]
    got = spark.createDataFrame([(n,) for n in numbers], "n long").select(wide.text(wide.digits(wide.from_long(F.col("n"))))).collect()
    assert [int(r[0]) for r in got] == numbers
    odd = spark.createDataFrame([(None,), ("",), ("0x1",), ("g" * 64,), ("f" * 63,)], "w string")
    assert [r[0] for r in odd.select(wide.from_word("w")).collect()] == [None] * 5
    assert odd.where("w = 'none'").withColumn("v", wide.from_word("w")).agg(*wide.limb_sums("v")).select(wide.text(wide.digits(wide.total("v")), 6)).first()[0] == "0.000000"


def test_sums_of_words(spark):
    rng = random.Random(3)
    numbers = [0, 1, 2**32 - 1, 2**32, 2**256 - 1, 2**256 - 1, *[rng.getrandbits(rng.randrange(1, 257)) for _ in range(300)]]
    df = spark.createDataFrame([(i % 5, f"{n:064x}") for i, n in enumerate(numbers)] + [(9, None), (0, None)], "k int, w string").repartition(5)
    sums = df.groupBy("k").agg(*wide.word_sums("w")).select("k", wide.text(wide.digits(wide.word_total("w"))).alias("t"))
    assert {r["k"]: int(r["t"]) for r in sums.collect()} == {k: sum(numbers[k::5]) for k in range(5)} | {9: 0}
    many = spark.range(3000).select(F.lit("f" * 64).alias("w")).agg(*wide.word_sums("w")).select(wide.text(wide.digits(wide.word_total("w"))))
    assert many.first()[0] == str(3000 * (2**256 - 1))


def test_cube_turns_no_row_into_limbs(spark):
    """Between a row and the first partial sum there are only texts: limbs of each row took nearly all of the cube's time."""
    rows = [(None, "F" * 64), (5, "00"), (10**18 - 1, None), (10**18, f"{10**18:064x}"), (None, "0x1"), (-1, f"{7:064x}"), (None, None)]
    p = spark.createDataFrame([(1, "base", "f", True, 1, *r) for r in rows], "day int, chain string, facilitator string, facilitator_known boolean, methodology_version int, amount_raw long, value_hex string")
    got = cube.wide_cube(p)
    want = 2**256 - 1 + 5 + 10**18 - 1 + 10**18 + 7
    r = got.first()
    assert (r["txn_count"], r["volume_usdc"].replace(".", ""), r["max_amount_usdc"].replace(".", "")) == (7, str(want), str(2**256 - 1))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan[plan.index("Aggregate [") :]
    none = cube.wide_cube(p.where("value_hex = '0x1'")).first()
    assert (none["volume_usdc"], none["max_amount_usdc"]) == ("0.000000", None)
