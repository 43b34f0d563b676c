"""Derived series and ratios over published tables. Series are day or month grained, so a few thousand rows each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payx.functions.amounts import claim_verdict, share
from payx.schema import BANDS


def trailing(series: DataFrame, n: int, day: str = "day") -> DataFrame:
    """The last n rows by day."""
    return series.orderBy(F.desc(day)).limit(n)


def moving_average(series: DataFrame, value: str, day: str = "day") -> DataFrame:
    """Mean of up to seven rows before and with each, over complete rows; an incomplete one keeps its own value."""
    w = Window.partitionBy("complete").orderBy(day).rowsBetween(-6, 0)
    return series.withColumn("ma7", F.round(F.when(F.col("complete"), F.avg(F.when(F.col("complete"), F.col(value))).over(w)).otherwise(F.col(value)).cast("double"), 6))


def month_over_month(months: DataFrame) -> DataFrame:
    """Volume against the month before; null unless both are complete and the base is positive."""
    w = Window.orderBy("month")
    before, whole = F.lag("volume_usdc").over(w), F.lag("complete").over(w)
    ok = F.col("complete") & F.coalesce(whole, F.lit(False)) & (before > 0)
    return months.withColumn("change", F.when(ok, F.round(F.col("volume_usdc").cast("double") / before.cast("double") - 1, 6)))


def peak_and_median(series: DataFrame, value: str) -> DataFrame:
    """Peak day of complete rows (of all, if none is), upper median, and last complete day (newest, if none is)."""
    done = F.when(F.col("complete"), F.col(value))
    day = F.when(F.col("complete"), F.col("day"))
    key = lambda v: F.struct(v, -F.datediff("day", F.lit("1970-01-01").cast("date")))  # noqa: E731  the first of equal peaks
    values = F.array_sort(F.collect_list(value))
    return series.agg(
        F.coalesce(F.max_by("day", F.when(F.col("complete"), key(F.col(value)))), F.max_by("day", key(F.col(value)))).alias("peak_day"), F.coalesce(F.max(done), F.max(value)).alias("peak_value"),
        F.get(values, F.floor(F.size(values) / 2).cast("int")).alias("upper_median"), F.coalesce(F.max(day), F.max("day")).alias("last_complete_day"),
    )


def momentum(economy: DataFrame) -> DataFrame:
    """Mean daily volume of 7 days against that of 30."""
    pick = lambda w: F.max(F.when((F.col("window_name") == w) & (F.col("band") == "all"), F.col("volume_usdc")))
    return economy.agg(share(pick("7d").cast("double") / 7, pick("30d").cast("double") / 30, 6, None).alias("momentum"))


def dense_bands(economy: DataFrame) -> DataFrame:
    """Every window and band, zeros where there are no payments, with their shares of the window."""
    every = economy.select("window_name").distinct().withColumn("band", F.explode(F.array(*[F.lit(b) for b in BANDS])))
    x = every.join(economy, ["window_name", "band"], "left").select("window_name", "band", F.coalesce("txn_count", F.lit(0)).alias("txn_count"), F.coalesce("volume_usdc", F.lit(0)).cast("decimal(38,6)").alias("volume_usdc"))
    w = Window.partitionBy("window_name")
    return x.withColumns({"txn_share": share(F.col("txn_count"), F.sum("txn_count").over(w)), "volume_share": share(F.col("volume_usdc"), F.sum("volume_usdc").over(w))})


def cohort_shares(cohorts: DataFrame) -> DataFrame:
    new, old = F.col("new_payer_volume_usdc"), F.col("returning_payer_volume_usdc")
    return cohorts.select("window_name", share(new, new + old).alias("new_share"), share(old, new + old).alias("returning_share"))


def claims_resolved(claims: DataFrame, economy: DataFrame) -> DataFrame:
    """Claims with the measured value of their metric total_<txns|volume>_<window>, the ratio and the verdict."""
    total = economy.where("band = 'all'")
    measured = total.select(F.lit("txns").alias("kind"), "window_name", F.col("txn_count").cast("double").alias("measured")).unionByName(total.select(F.lit("volume").alias("kind"), "window_name", F.col("volume_usdc").cast("double").alias("measured")))
    part = F.split("measured_metric", "_")
    x = claims.withColumns({"kind": F.get(part, F.lit(1)), "window_name": F.get(part, F.lit(2))}).join(F.broadcast(measured), ["kind", "window_name"], "left")
    ratio = share(F.col("claimed_value"), F.col("measured"), 6, None)
    return x.select("id", "kind", "window_name", "claimed_value", "measured", F.when(F.col("kind") == "txns", "payments").otherwise("USDC").alias("unit"), ratio.alias("ratio"), claim_verdict(ratio).alias("verdict"))
