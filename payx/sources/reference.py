"""Checks of hand-kept inputs: each returns violations (key, reason); empty is as it must be."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _violations(df: DataFrame, key: str, tests: list[tuple[Column, str]], unique: str | None = None) -> DataFrame:
    found = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(reason)) for bad, reason in tests]))
    out = df.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("reason"))
    if unique:
        out = out.unionByName(df.groupBy(F.col(unique).cast("string").alias("key")).count().where("count > 1").select("key", F.lit("duplicate").alias("reason")))
    return out


def price_violations(prices: DataFrame) -> DataFrame:
    """prices (week, usd, citation as strings): ISO Mondays, positive decimals, cited, no week twice, not empty."""
    week, usd = F.col("week").try_cast("date"), F.col("usd").try_cast("decimal(20,8)")
    tests = [(week.isNull(), "bad date"), (week.isNotNull() & (F.dayofweek(week) != 2), "not a Monday"), (usd.isNull(), "bad decimal"), (usd.isNotNull() & (usd <= 0), "not positive"), (F.coalesce(F.col("citation"), F.lit("")) == "", "no citation")]
    none = prices.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("").alias("key"), F.lit("empty").alias("reason"))
    return _violations(prices, "week", tests, "week").unionByName(none)


def claim_violations(claims: DataFrame) -> DataFrame:
    """claims: unique id, required fields, http(s) source, metric total_<txns|volume>_<7d|30d|all>."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    tests = [(empty(c), f"no {c}") for c in ("id", "source", "claim_text", "claimed_value", "source_url", "lens")]
    tests += [(~empty("source_url") & ~F.col("source_url").rlike("^https?://"), "bad source_url"), (~F.coalesce(F.col("measured_metric").rlike("^total_(txns|volume)_(7d|30d|all)$"), F.lit(False)), "bad measured_metric")]
    return _violations(claims, "id", tests, "id")


def manual_labels(labels: DataFrame) -> DataFrame:
    """labels with addresses in lower case."""
    return labels.withColumn("address", F.lower("address"))


def label_violations(labels: DataFrame, chain: str = "base") -> DataFrame:
    """labels (chain, address, label): the chain, well-formed addresses, a label, one for each address."""
    x = manual_labels(labels).withColumn("k", F.concat_ws(":", "chain", "address"))
    tests = [(F.coalesce(F.col("chain"), F.lit("")) != chain, "bad chain"), (~F.coalesce(F.col("address").rlike("^0x[0-9a-f]{40}$"), F.lit(False)), "bad address"), (F.coalesce(F.col("label"), F.lit("")) == "", "no label")]
    return _violations(x, "k", tests, "k")


def replace_by_source(signals: DataFrame, fresh: DataFrame, source: str = "manual") -> DataFrame:
    """signals with all rows of one source replaced."""
    return signals.where(F.col("source") != source).unionByName(fresh.withColumn("source", F.lit(source)).select(*signals.columns))
