"""Boundaries of scalar functions, from the hand-checked tables."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from payx.functions import amounts, hexes


def one(spark, column, **values):
    kinds = {int: "long", str: "string", float: "double", Decimal: "decimal(38,6)"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(("x", "band"), [("0.009", "dust"), ("0.01", "micro"), ("0.999999", "micro"), ("1", "small"), ("99.999999", "small"), ("100", "mid"), ("999.999999", "mid"), ("1000", "whale")])
def test_amount_band(spark, x, band):
    assert one(spark, amounts.amount_band(F.col("x")), x=Decimal(x)) == band


@pytest.mark.parametrize(("n", "bucket"), [(1, "1"), (2, "2-10"), (10, "2-10"), (11, "11-100"), (100, "11-100"), (1000, "101-1000"), (100000, "1001-100000"), (100001, "100000+")])
def test_entity_bucket(spark, n, bucket):
    assert one(spark, amounts.entity_bucket(F.col("n")), n=n) == bucket


@pytest.mark.parametrize(("t", "c", "a", "v", "kind"), [(20, 1, 1, 200000.0, "otc"), (1000, 1, 1, 10.0, "sink"), (1000, 1, 2, 5000.0, "fleet"), (60, 50, 10, 60.0, "service"), (5, 1, 1, 5.0, "tail"), (0, 0, 0, 0.0, "tail")])
def test_behavior(spark, t, c, a, v, kind):
    assert one(spark, amounts.behavior_class(F.col("t"), F.col("c"), F.col("a"), F.col("v")), t=t, c=c, a=a, v=v) == kind


@pytest.mark.parametrize("n", [0, 1, 10**6, 2**64 - 1, 2**64, 2**100 + 7, 10**38 - 1, 10**38, 2**127, 2**128, 2**256 - 1])
def test_wide_words(spark, n):
    want = Decimal(n) if n < 10**38 else None
    assert one(spark, hexes.word_to_decimal(F.col("x")), x=f"{n:064x}") == want


@pytest.mark.parametrize(("x", "want"), [("0x0", 0), ("0x10", 16), ("0x7fffffffffffffff", 2**63 - 1), ("0x", 0), ("", 0), ("0xzz", None), ("10", None), ("0x" + "f" * 17, None), ("0x" + "0" * 30 + "5", 5)])
def test_quantity(spark, x, want):
    assert one(spark, hexes.quantity(F.col("x")), x=x) == want


def test_nullable_quantity(spark):
    assert one(spark, hexes.quantity(F.lit(None).cast("string"), None), x="") is None


def test_exact_usdc(spark):
    assert one(spark, amounts.usdc(F.col("x")), x=123456789012345678) == Decimal("123456789012.345678")


def test_query_kinds(spark):
    assert one(spark, amounts.query_kind(F.col("x")), x="0x" + "a" * 40) == "address"
    assert one(spark, amounts.query_kind(F.col("x")), x="0x" + "a" * 64) == "tx"
    assert one(spark, amounts.query_kind(F.col("x")), x="a" * 64) is None


def test_sql_functions_equal_column_functions(spark):
    from payx.functions import amounts, sqlfunctions

    sqlfunctions.register(spark)
    values = [("0.009", 0), ("0.01", 1), ("0.999999", 2), ("1", 10), ("99.999999", 11), ("100", 100), ("999.999999", 101), ("1000", 1000), ("5", 100000), ("7", 100001), (None, None)]
    df = spark.createDataFrame(values, "a string, n long").withColumn("a", F.col("a").cast("decimal(38,6)"))
    df = df.select("*", amounts.amount_band(F.col("a")).alias("b1"), amounts.entity_bucket(F.col("n")).alias("e1"), amounts.batch_bucket(F.col("n")).alias("c1"), amounts.usdc(F.col("n")).alias("u1"))
    got = spark.sql("SELECT *, amount_band(a) AS b2, entity_bucket(n) AS e2, batch_bucket(n) AS c2, usdc(n) AS u2 FROM {df}", df=df).collect()
    assert all((r["b1"], r["e1"], r["c1"], r["u1"]) == (r["b2"], r["e2"], r["c2"], r["u2"]) for r in got)
    assert [r["b2"] for r in got[:8]] == ["dust", "micro", "micro", "small", "small", "mid", "mid", "whale"]
    assert [r["e2"] for r in got[1:10]] == ["1", "2-10", "2-10", "11-100", "11-100", "101-1000", "101-1000", "1001-100000", "100000+"]


def test_ties_are_rounded_as_in_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    ties = [(n * 10**12 + 5 * 10**11) / 1e18 for n in range(1, 2000)]
    df = spark.createDataFrame([(x,) for x in ties], "x double")
    got = dict(df.select("x", amounts.rounded(F.col("x"), 6)).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t (x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?)", [(x,) for x in ties])
    assert got == dict(con.execute("SELECT x, round(x, 6) FROM t").fetchall())
    assert got != dict(df.select("x", F.round("x", 6)).collect())
