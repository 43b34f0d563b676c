"""Registered entity queries take every role."""

import datetime

from payx import catalog
from payx.operators import graph


def test_densified_takes_every_role(spark, sf_dir):
    df = catalog.queries()["gr2_densified"](spark, sf_dir)
    assert {r["role"] for r in df.select("role").distinct().collect()} == {"payer", "payee", "facilitator"}


def test_gaps_of_every_role_are_filled(spark):
    day = lambda n: datetime.date(2024, 2, n)
    rows = [("base", a, role, day(n), True, 2, 1) for a, role in (("0xa", "payer"), ("0xe", "payee"), ("0xf", "facilitator")) for n in (27, 29)]
    days = spark.createDataFrame(rows, "chain string, address string, role string, day date, facilitator_known boolean, txn_count long, volume_usdc int").withColumn("volume_usdc", graph.F.col("volume_usdc").cast("decimal(38,6)"))
    got = {(r["role"], r["lens"], r["day"].day): r["txn_count"] for r in graph.densified(days).collect()}
    assert got == {(role, lens, n): 0 if n == 28 else 2 for role in ("payer", "payee", "facilitator") for lens in ("all", "known") for n in (27, 28, 29)}


def test_rows_that_fill_gaps_are_not_joined(spark):
    days = spark.createDataFrame([], "chain string, address string, role string, day date, facilitator_known boolean, txn_count long, volume_usdc decimal(38,6)")
    assert "Join" not in graph.densified(days)._jdf.queryExecution().optimizedPlan().toString()


EDGE = "chain string, payer string, payee string, facilitator_known boolean, txn_count long, volume_usdc decimal(38,6), first_seen timestamp, last_seen timestamp"


def test_pairs_are_summed_before_they_become_rows_of_lists(spark):
    edge = spark.createDataFrame([], EDGE)
    settled = spark.createDataFrame([], EDGE.replace("payer string, payee", "facilitator string, role string, counterparty"))
    plan = graph.counterparties(edge, settled)._jdf.queryExecution().analyzed().toString()
    assert plan.index("Generate") < plan.index("Aggregate")


def test_lists_and_counts_of_both_lenses(spark):
    at = datetime.datetime(2024, 2, 1)
    edge = spark.createDataFrame([("base", "0xa", "0xe", known, 1, n, at, at) for known, n in ((True, 3), (False, 4))] + [("base", "0xb", "0xe", False, 1, 5, at, at)], EDGE.replace("decimal(38,6)", "int")).withColumn("volume_usdc", graph.F.col("volume_usdc").cast("decimal(38,6)"))
    settled = spark.createDataFrame([], EDGE.replace("payer string, payee", "facilitator string, role string, counterparty"))
    got = {(r["direction"], r["subject"], r["lens"], r["counterparty"]): (int(r["volume_usdc"]), r["rank"], r["total_counterparties"]) for r in graph.neighbors(edge, settled).collect()}
    assert got == {
        ("payees", "0xa", "all", "0xe"): (7, 1, 1), ("payees", "0xa", "known", "0xe"): (3, 1, 1), ("payees", "0xb", "all", "0xe"): (5, 1, 1),
        ("payers", "0xe", "all", "0xa"): (7, 1, 2), ("payers", "0xe", "all", "0xb"): (5, 2, 2), ("payers", "0xe", "known", "0xa"): (3, 1, 1),
    }


def test_days_of_both_lenses_are_one_row_until_counted(spark):
    day = lambda n: datetime.date(2024, 2, n)
    rows = [("base", a, "payer", day(n), known, k, 1) for a, n, known, k in (("0xa", 1, True, 2), ("0xa", 1, False, 5), ("0xa", 4, True, 1), ("0xa", 9, False, 3), ("0xb", 2, False, 4))]
    days = spark.createDataFrame(rows, "chain string, address string, role string, day date, facilitator_known boolean, txn_count long, volume_usdc int")
    df = graph.cadence(days)
    got = sorted(tuple(r) for r in df.select("address", "role", "lens", "active_days", "span_days", "median_per_day", "top_day_share").collect())
    assert got == [("0xa", "payer", "all", 3, 9, 3, 0.636364), ("0xa", "payer", "known", 2, 4, 1, 0.666667), ("0xb", "payer", "all", 1, 1, 4, 1.0)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Generate") < plan.index("Aggregate")  # lenses are made last


def test_fingerprints_sum_payments_once_by_pair(spark, sf_dir):
    plan = catalog.queries()["gr5_counterparty_concentration"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    keys = [line.split("Aggregate [")[1].split("]")[0] for line in plan.splitlines() if "Aggregate [" in line]
    assert keys and not any("facilitator#" in k and "payer#" in k for k in keys)  # no sum by all parties before


def test_empty_days_are_counted_in_whole_numbers(spark):
    days = spark.createDataFrame([], "chain string, address string, role string, day date, facilitator_known boolean, txn_count long, volume_usdc decimal(38,6)")
    df = graph.densified(days)
    assert dict(df.dtypes) == {"address": "string", "role": "string", "lens": "string", "day": "date", "txn_count": "bigint", "volume_usdc": "decimal(38,6)"}
    assert "sequence(0," in df._jdf.queryExecution().optimizedPlan().toString()
