"""Payers and payees: aggregates, ranks, size buckets, concentration and behaviour classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payx.functions.amounts import behavior_class, entity_bucket, share
from payx.operators.windows import PAIR, anchor, first_by, first_by_any, in_windows, unpivot
from payx.schema import CLASSES


def entity_aggregate(p: DataFrame) -> DataFrame:
    """(window, role, address) over known payments: volume, payments, distinct counterparties and amounts, first and last time.

    Windows end with the newest day of all payments. Distinct counts go through one row for each (entity, counterparty)
    and one for each (entity, amount), so a busy entity is spread over these and partly summed before each shuffle.
    p may be summed already by day, parties and amount, with n, first_seen and last_seen.
    """
    x = in_windows(unpivot(p.where("facilitator_known"), *PAIR), anchor(p))
    n, v, a, b = (F.sum("n"), F.sum(F.col("amount_usdc") * F.col("n")), "first_seen", "last_seen") if "n" in p.columns else (F.count(F.lit(1)), F.sum("amount_usdc"), "block_timestamp", "block_timestamp")
    key = ["window_name", "role", "address"]
    amounts = x.select(*key, "amount_usdc").distinct().groupBy(key).agg(F.count(F.lit(1)).alias("distinct_amounts"))
    others = x.groupBy(*key, "counterparty").agg(n.alias("n"), v.cast("decimal(38,6)").alias("v"), F.min(a).alias("a"), F.max(b).alias("b"))
    total = others.groupBy(key).agg(F.sum("v").cast("decimal(38,6)").alias("volume_usdc"), F.sum("n").alias("txn_count"), F.count(F.lit(1)).alias("distinct_counterparties"), F.min("a").alias("first_seen"), F.max("b").alias("last_seen"))
    return total.join(amounts, key).withColumn("known_volume_usdc", F.col("volume_usdc"))


def entity_rank(agg: DataFrame, top: int = 150) -> DataFrame:
    """The `top` by volume and the `top` by payments of each window and role."""
    return first_by_any(agg, ["window_name", "role"], ["volume_usdc", "txn_count"], top)


def entity_buckets(agg: DataFrame) -> DataFrame:
    return agg.groupBy("window_name", "role", entity_bucket(F.col("txn_count")).alias("bucket")).agg(F.count(F.lit(1)).alias("entity_count"), F.sum("txn_count").alias("txn_sum"), F.sum("volume_usdc").cast("decimal(38,6)").alias("volume_sum"))


def concentration(agg: DataFrame) -> DataFrame:
    """Totals of each window and role, and what the top 10 and top 100 hold of them.

    Totals are partial sums; only the first 100 and 10 rows of a group are ever put in order.
    """
    keys = ["window_name", "role"]
    money = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,6)")
    total = agg.groupBy(keys).agg(F.count(F.lit(1)).alias("total_entities"), money("volume_usdc").alias("total_volume"), F.sum("txn_count").alias("total_txns"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("volume_usdc"), "address"))
    by_volume = agg.withColumn("r", place).where("r <= 100").groupBy(keys).agg(money(F.when(F.col("r") <= 10, F.col("volume_usdc"))).alias("top10_volume"), money("volume_usdc").alias("top100_volume"))
    by_txns = first_by(agg, keys, "txn_count", 10).groupBy(keys).agg(F.sum("txn_count").alias("top10_txns"))
    return total.join(by_volume, keys).join(by_txns, keys).select(*keys, "total_entities", "total_volume", "total_txns", "top10_volume", "top10_txns", "top100_volume")


def concentration_shares(c: DataFrame) -> DataFrame:
    return c.select("window_name", "role", share(F.col("top10_volume"), F.col("total_volume")).alias("top10_share"), share(F.col("top100_volume"), F.col("total_volume")).alias("top100_share"), share(F.col("top10_txns"), F.col("total_txns")).alias("top10_txn_share"))


def classified(rank: DataFrame) -> DataFrame:
    return rank.withColumn("behavior", behavior_class(F.col("txn_count"), F.col("distinct_counterparties"), F.col("distinct_amounts"), F.col("volume_usdc")))


def class_counts(rank: DataFrame) -> DataFrame:
    """Entities and volume of each class in each window and role, with zeros for classes that have none."""
    x = classified(rank).groupBy("window_name", "role", "behavior").agg(F.count(F.lit(1)).alias("entities"), F.sum("volume_usdc").cast("decimal(38,6)").alias("volume_usdc"))
    every = x.select("window_name", "role").distinct().withColumn("behavior", F.explode(F.array(*[F.lit(c) for c in CLASSES])))
    return every.join(x, ["window_name", "role", "behavior"], "left").select("window_name", "role", "behavior", F.coalesce("entities", F.lit(0)).alias("entities"), F.coalesce("volume_usdc", F.lit(0)).cast("decimal(38,6)").alias("volume_usdc"))


def dust_sinks(rank: DataFrame, top: int = 20) -> DataFrame:
    """Payees of class sink over all time, the busiest first."""
    x = classified(rank).where("window_name = 'all' and role = 'payee' and behavior = 'sink'")
    return x.orderBy(F.desc("txn_count"), "address").limit(top).select("address", "txn_count", "volume_usdc")


def entity_page(rank: DataFrame, buckets: DataFrame, conc: DataFrame) -> DataFrame:
    """One row for each window and role: leaderboard, buckets and concentration nested."""
    key = ["window_name", "role"]
    board = rank.groupBy(key).agg(F.sort_array(F.collect_list(F.struct((-F.col("txn_count")).alias("order"), "address", "txn_count", "volume_usdc", "distinct_counterparties", "distinct_amounts"))).alias("leaderboard"))
    sizes = buckets.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("bucket", "entity_count", "txn_sum", "volume_sum"))).alias("buckets"))
    return board.join(sizes, key).join(conc.select(*key, F.struct(*[c for c in conc.columns if c not in key]).alias("concentration")), key)
