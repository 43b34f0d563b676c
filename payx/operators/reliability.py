"""How long settlements take and how many miss their authorization's window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payx.functions.amounts import membership, share
from payx.operators.quantiles import quantiles
from payx.operators.windows import anchor, by_membership, in_windows

# Lower bounds of the latency buckets in seconds.
BUCKETS = (("sub1s", 0, 1), ("1_10s", 1, 10), ("10_60s", 10, 60), ("1_10m", 60, 600), ("gt10m", 600, None))


def with_windows(p: DataFrame) -> DataFrame:
    """p with windowed, expired, not_yet_valid and latency_s. All need both bounds; latency of a settlement before its window is null."""
    both = F.col("valid_after").isNotNull() & F.col("valid_before").isNotNull()
    seconds = (F.unix_micros("block_timestamp") - F.unix_micros("valid_after")) / 1e6
    return p.withColumns({
        "windowed": both,
        "expired": both & F.coalesce(F.col("block_timestamp") > F.col("valid_before"), F.lit(False)),
        "not_yet_valid": both & F.coalesce(F.col("block_timestamp") < F.col("valid_after"), F.lit(False)),
        "latency_s": F.when(both & (seconds >= 0), seconds),
    })


def cancellation_windows(cancellations: DataFrame, newest: DataFrame) -> DataFrame:
    """(window, membership or all) -> cancellations, in the windows of the payments."""
    x = in_windows(cancellations.withColumn("day", F.to_date("block_time")), newest)
    return by_membership(x, ["window_name"], F.count(F.lit(1)).alias("cancellation_count"))


def reliability_windows(p: DataFrame, cancellations: DataFrame) -> DataFrame:
    """(window, membership or all) -> settlements, latency percentiles and buckets, misses, cancellations."""
    newest = anchor(p)
    keys = ["window_name", "membership"]
    # One row for each day, side and latency feeds both the counts and the percentiles.
    daily = with_windows(p).groupBy("day", "facilitator_known", "latency_s").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c).alias(c) for c in ("windowed", "expired", "not_yet_valid")])
    x = by_membership(in_windows(daily, newest), ["window_name", "latency_s"], *[F.sum(c).alias(c) for c in ("n", "windowed", "expired", "not_yet_valid")])
    bucket = lambda lo, hi: F.coalesce(F.sum(F.when((F.col("latency_s") >= lo) & (F.col("latency_s") < hi if hi else F.lit(True)), F.col("n"))), F.lit(0))
    out = x.groupBy(keys).agg(F.sum("n").alias("settlement_count"), F.sum("windowed").alias("windowed_count"), *[bucket(lo, hi).alias(f"lat_bucket_{name}") for name, lo, hi in BUCKETS], F.sum("expired").alias("expired_count"), F.sum("not_yet_valid").alias("not_yet_valid_count"))
    out = out.join(quantiles(x, keys, "latency_s", {"latency_p50_s": 0.5, "latency_p90_s": 0.9, "latency_p99_s": 0.99}, continuous=True), keys, "left")
    out = out.join(cancellation_windows(cancellations, newest), keys, "left")
    return out.withColumn("cancellation_count", F.coalesce("cancellation_count", F.lit(0)))


def reliability_daily(p: DataFrame, cancellations: DataFrame) -> DataFrame:
    """(day, chain, membership) -> settlements and misses; cancellations of days without settlements are left out."""
    x = with_windows(p).groupBy("day", "chain", membership(F.col("facilitator_known")).alias("membership"))
    x = x.agg(F.count(F.lit(1)).alias("settlement_count"), F.count_if("windowed").alias("windowed_count"), F.count_if("expired").alias("expired_count"), F.count_if("not_yet_valid").alias("not_yet_valid_count"))
    c = cancellations.groupBy(F.to_date("block_time").alias("day"), "chain", membership(F.col("facilitator_known")).alias("membership")).agg(F.count(F.lit(1)).alias("cancellation_count"))
    return x.join(c, ["day", "chain", "membership"], "left").withColumn("cancellation_count", F.coalesce("cancellation_count", F.lit(0)))


def reliability_rates(windows: DataFrame) -> DataFrame:
    """Shares and rates, 0 where there is nothing to divide by."""
    timed = sum((F.col(f"lat_bucket_{name}") for name, _, _ in BUCKETS), F.lit(0))
    return windows.select(
        "window_name", "membership", share(F.col("windowed_count"), F.col("settlement_count")).alias("windowed_share"), share(F.col("expired_count"), F.col("windowed_count")).alias("expired_rate"),
        share(F.col("not_yet_valid_count"), F.col("windowed_count")).alias("not_yet_valid_rate"), share(F.col("cancellation_count"), F.col("settlement_count") + F.col("cancellation_count")).alias("cancellation_rate"),
        *[share(F.col(f"lat_bucket_{name}"), timed).alias(f"share_{name}") for name, _, _ in BUCKETS],
    )


def reliability_series(daily: DataFrame) -> DataFrame:
    """Known rows by day over all chains."""
    return daily.where("membership = 'known'").groupBy("day").agg(*[F.sum(c).alias(c) for c in ("settlement_count", "windowed_count", "expired_count", "not_yet_valid_count", "cancellation_count")])


def cancellation_attribution(cancellations: DataFrame, top: int = 100) -> DataFrame:
    """The busiest authorizers and submitters of known cancellations (side says which)."""
    k = cancellations.where("facilitator_known")
    side = lambda c: k.groupBy(F.col(c).alias("address")).agg(F.count(F.lit(1)).alias("cancellations"), F.max("block_time").alias("last_seen"), F.bool_or(F.col("authorizer") == F.col("transaction_from")).alias("own")).orderBy(F.desc("cancellations"), "address").limit(top).withColumn("side", F.lit(c))
    return side("authorizer").unionByName(side("transaction_from"))
