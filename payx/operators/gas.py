"""Settlement cost. Cost fields belong to a transaction and are repeated on each of its payments."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payx.functions.amounts import amount_band, membership, rounded, share
from payx.operators.classify import small
from payx.operators.cube import edge_flag
from payx.operators.windows import anchor, in_windows


def per_transaction(p: DataFrame) -> DataFrame:
    """(chain, tx_hash) -> number of payments and its own cost fields."""
    return p.groupBy("chain", "tx_hash").agg(F.count(F.lit(1)).alias("n"), F.max("gas_cost_wei").alias("gas_cost_wei"), F.max(F.coalesce("l1_fee", F.lit(0).cast("long"))).alias("l1_fee"))


def missing_weeks(p: DataFrame, prices: DataFrame) -> DataFrame:
    """ISO weeks with payments and no price, and all of them in one string; empty is as it must be."""
    weeks = p.select(F.to_date(F.date_trunc("week", "block_timestamp")).alias("week")).distinct()
    lost = weeks.exceptAll(prices.select("week").distinct())
    return lost.agg(F.count(F.lit(1)).alias("weeks"), F.array_join(F.sort_array(F.collect_list(F.col("week").cast("string"))), ",").alias("missing"))


def apportioned(p: DataFrame, prices: DataFrame) -> DataFrame:
    """Payments with their share of the transaction's cost: l2_wei, l1_wei, cost_usd (exact decimals, summable in any order).

    The transaction's number of payments and cost come from windows over its payments: one shuffle, no self join.
    """
    tx = Window.partitionBy("chain", "tx_hash")
    x = p.withColumns({"n": F.count(F.lit(1)).over(tx), "tx_gas": F.max("gas_cost_wei").over(tx), "tx_l1": F.max(F.coalesce("l1_fee", F.lit(0).cast("long"))).over(tx)})
    x = x.withColumn("week", F.to_date(F.date_trunc("week", "block_timestamp"))).join(small(prices.select("week", "usd")), "week")
    part = lambda c: (F.col(c).cast("decimal(28,0)") / F.col("n").cast("decimal(10,0)")).cast("decimal(38,10)")
    cost = (F.col("tx_gas") + F.col("tx_l1")).cast("double") / F.col("n") * F.col("usd").cast("double") / F.lit(1e18)
    return x.withColumns({"l2_wei": part("tx_gas"), "l1_wei": part("tx_l1"), "cost_usd": cost.cast("decimal(38,12)")})


def gas_daily(p: DataFrame, prices: DataFrame) -> DataFrame:
    """(day, membership, band) -> payments, wei of both kinds, cost, volume and payments that cost more than they moved."""
    x = apportioned(p, prices).withColumns({"membership": membership(F.col("facilitator_known")), "band": amount_band(F.col("amount_usdc"))})
    return x.groupBy("day", "membership", "band").agg(F.count(F.lit(1)).alias("txn_count"), F.sum("l2_wei").alias("l2_gas_cost_wei"), F.sum("l1_wei").alias("l1_fee_wei"), F.sum("cost_usd").alias("cost_usd"), F.count_if(F.col("cost_usd") > F.col("amount_usdc")).alias("breakeven_count"), F.sum("amount_usdc").alias("volume_usdc"))


def _measures(x: DataFrame, *keys: str) -> DataFrame:
    eth = lambda c: rounded(F.sum(c).cast("double") / 1e18, 6)
    usd, volume = F.sum("cost_usd"), F.sum("volume_usdc")
    return x.groupBy(*keys).agg(
        F.sum("txn_count").alias("txn_count"), rounded((F.sum("l2_gas_cost_wei") + F.sum("l1_fee_wei")).cast("double") / 1e18, 6).alias("eth_total"), eth("l2_gas_cost_wei").alias("eth_l2"), eth("l1_fee_wei").alias("eth_l1"),
        rounded(usd.cast("double"), 2).alias("usd"), rounded(F.try_divide(usd.cast("double") * 100, volume.cast("double")), 4).alias("cents_per_dollar"), F.sum("breakeven_count").alias("breakeven_count"),
    )


def gas_windows(daily: DataFrame) -> DataFrame:
    """Known cost of each window and band, and of all bands; windows end with the newest known day."""
    k = daily.where("membership = 'known'")
    x = in_windows(k, anchor(k))
    return _measures(x, "window_name", "band").unionByName(_measures(x.withColumn("band", F.lit("all")), "window_name", "band"))


def cost_per_dollar_daily(daily: DataFrame) -> DataFrame:
    """Cents of cost for each dollar moved, by day; days without volume are left out."""
    k = daily.where("membership = 'known'").groupBy("day").agg(F.sum("cost_usd").alias("usd"), F.sum("volume_usdc").alias("volume")).where("volume > 0")
    return edge_flag(k.select("day", share(F.col("usd").cast("double") * 100, F.col("volume"), 4).alias("cents_per_dollar")), "day")


def breakeven_share(windows: DataFrame) -> DataFrame:
    return windows.select("window_name", "band", share(F.col("breakeven_count") * 100, F.col("txn_count"), 2).alias("pct_below_cost"))


def conservation(p: DataFrame, daily: DataFrame, tolerance: Decimal = Decimal("0.001")) -> DataFrame:
    """Violations: the apportioned wei of all payments, of both kinds, against the transactions' own."""
    own = per_transaction(p).agg(F.sum(F.col("gas_cost_wei").cast("decimal(38,0)")).alias("l2"), F.sum(F.col("l1_fee").cast("decimal(38,0)")).alias("l1"))
    parts = daily.agg(F.sum("l2_gas_cost_wei").alias("l2_parts"), F.sum("l1_fee_wei").alias("l1_parts"), F.sum("txn_count").alias("n"))
    drift = lambda k: F.abs(F.col(k).cast("decimal(38,10)") - F.col(f"{k}_parts"))
    found = lambda k: F.when(drift(k) > F.col("n") * F.lit(tolerance), F.struct(F.lit(f"{k}_conservation").alias("check"), drift(k).cast("double").alias("drift")))
    return own.crossJoin(parts).select(F.explode(F.array_compact(F.array(found("l2"), found("l1")))).alias("x")).select("x.*")
