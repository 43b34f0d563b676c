"""Amounts: window statistics, price points and their breadth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payx.functions.amounts import market_class, share
from payx.operators.cube import edge_flag
from payx.operators.quantiles import quantiles
from payx.operators.windows import anchor, by_membership, in_windows


def window_stats(p: DataFrame) -> DataFrame:
    """(window, membership or all) -> payments and discrete percentiles of the amount; windows end with the newest known day.

    Amounts are first counted, as they recur.
    """
    x = in_windows(p.groupBy("day", "facilitator_known", "amount_usdc").agg(F.count(F.lit(1)).alias("n")), anchor(p, True))
    counts = by_membership(x, ["window_name", "amount_usdc"], F.sum("n").alias("n"))
    keys = ["window_name", "membership"]
    total = counts.groupBy(keys).agg(F.sum("n").alias("txn_count"))
    return total.join(quantiles(counts, keys, "amount_usdc", {"p10_amount_usdc": 0.1, "median_amount_usdc": 0.5, "p90_amount_usdc": 0.9, "p99_amount_usdc": 0.99}), keys)


def price_points(p: DataFrame, top: int = 50) -> DataFrame:
    """The `top` most frequent known amounts of each window with payments, volume and distinct payees; ties by amount."""
    k = p.where("facilitator_known")
    # Two steps: a row for each payee first, so that one frequent amount spreads over its payees.
    pairs = in_windows(k.groupBy("day", "amount_usdc", "payee").agg(F.count(F.lit(1)).alias("n")), anchor(k)).groupBy("window_name", "amount_usdc", "payee").agg(F.sum("n").alias("n"))
    x = pairs.groupBy("window_name", "amount_usdc").agg(F.sum("n").alias("txn_count"), F.count(F.lit(1)).alias("payee_count"))
    order = Window.partitionBy("window_name").orderBy(F.desc("txn_count"), "amount_usdc")
    x = x.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return x.select("window_name", "rank", "amount_usdc", "txn_count", (F.col("amount_usdc") * F.col("txn_count")).cast("decimal(38,6)").alias("volume_usdc"), "payee_count")


def price_breadth(p: DataFrame, points: DataFrame, top: int = 12) -> DataFrame:
    """(day, amount) -> distinct payees, for the first `top` amounts of all time."""
    best = points.where((F.col("window_name") == "all") & (F.col("rank") <= top)).select("amount_usdc")
    k = p.where("facilitator_known").join(F.broadcast(best), "amount_usdc", "left_semi")
    return k.select("day", "amount_usdc", "payee").distinct().groupBy("day", "amount_usdc").agg(F.count(F.lit(1)).alias("payee_count"))


def price_breadth_series(breadth: DataFrame, points: DataFrame) -> DataFrame:
    """Breadth with the amount's rank and class, and the edge flag."""
    rank = points.where("window_name = 'all'").select("amount_usdc", "rank", F.col("payee_count").alias("payees"))
    x = breadth.join(F.broadcast(rank), "amount_usdc").withColumn("market", market_class(F.col("payees"))).drop("payees")
    return edge_flag(x, "day")


def breadth_trend(series: DataFrame) -> DataFrame:
    """Each amount's payees on its first and last complete day, and whether they widen, narrow or stay (by a fifth)."""
    x = series.where("complete").groupBy("amount_usdc").agg(F.min_by("payee_count", "day").alias("first"), F.max_by("payee_count", "day").alias("last"))
    return x.withColumn("trend", F.when(F.col("last") > F.col("first") * 1.2, "widening").when(F.col("last") < F.col("first") * 0.8, "narrowing").otherwise("flat"))


def typical_payment(stats: DataFrame, economy: DataFrame, cube: DataFrame) -> DataFrame:
    """Known payments of each window: mean, percentiles, largest and the ratio of mean to median."""
    k = cube.where("membership = 'known'")
    largest = in_windows(k, anchor(k)).groupBy("window_name").agg(F.max("max_amount_usdc").alias("largest_usdc"))
    total = economy.where("band = 'all'").select("window_name", "volume_usdc", F.col("txn_count").alias("n"))
    x = stats.where("membership = 'known'").join(total, "window_name").join(largest, "window_name")
    mean = share(F.col("volume_usdc"), F.col("n"))
    return x.select("window_name", mean.alias("mean_usdc"), "median_amount_usdc", "p10_amount_usdc", "p90_amount_usdc", "p99_amount_usdc", "largest_usdc", share(mean, F.col("median_amount_usdc"), 4, None).alias("mean_to_median"))


def price_point_shares(points: DataFrame, economy: DataFrame) -> DataFrame:
    """Price points with their share of the window's known payments, in percent."""
    total = economy.where("band = 'all'").select("window_name", F.col("txn_count").alias("n"))
    return points.join(F.broadcast(total), "window_name").select("window_name", "rank", "amount_usdc", "txn_count", "volume_usdc", "payee_count", share(F.col("txn_count") * 100, F.col("n"), 2).alias("pct_of_txns"))
