"""Labels of payments by version-scoped dimensions. Dimensions are small, hand-kept lists and joined as broadcasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Sources of identity signals, the first wins.
PRECEDENCE = ("manual", "catalog", "erc8004", "basename", "allowlist")
#: Rows up to which a dimension is sent to every executor; a longer one is joined by shuffle.
SMALL = 100_000


def small(df: DataFrame) -> DataFrame:
    """df as a broadcast if it is small, which is checked."""
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def in_version(dimension: DataFrame, version: int) -> DataFrame:
    """Rows of a dimension that hold in one version of the methodology."""
    return dimension.where((F.col("since_version") <= version) & (F.col("until_version").isNull() | (F.col("until_version") > version)))


def with_membership(payments: DataFrame, allowlist: DataFrame, version: int = 1) -> DataFrame:
    """payments with facilitator_known and methodology_version; no row is lost or doubled."""
    known = in_version(allowlist, version).select("chain", F.col("address").alias("facilitator"), F.lit(True).alias("__known")).distinct()
    return payments.join(small(known), ["chain", "facilitator"], "left").withColumn("facilitator_known", F.coalesce("__known", F.lit(False))).withColumn("methodology_version", F.lit(version)).drop("__known")


def versions(*dimensions: DataFrame) -> DataFrame:
    """The versions from which any row of some dimensions begins or ends to hold: one for each state they have been in."""
    points = [d.select(F.explode(F.array("since_version", "until_version")).alias("methodology_version")) for d in dimensions]
    return reduce(DataFrame.unionByName, points).where("methodology_version is not null").distinct()


def known_by_version(allowlist: DataFrame) -> DataFrame:
    """(chain, facilitator, methodology_version) of all versions in which a facilitator is known, each once."""
    at = F.col("methodology_version")
    holds = (F.col("since_version") <= at) & (F.col("until_version").isNull() | (F.col("until_version") > at))
    return allowlist.join(F.broadcast(versions(allowlist)), holds).select("chain", F.col("address").alias("facilitator"), "methodology_version").distinct()


def with_attribution(payments: DataFrame, allowlist: DataFrame, denylist: DataFrame, version: int = 1) -> DataFrame:
    """payments with attribution: contamination if the called contract is denied, else agentic if allowed, else contested."""
    denied = in_version(denylist, version).select("chain", "called_contract", F.lit(True).alias("__denied")).distinct()
    x = with_membership(payments, allowlist, version).join(small(denied), ["chain", "called_contract"], "left")
    return x.withColumn("attribution", F.when(F.col("__denied"), "contamination").when(F.col("facilitator_known"), "agentic").otherwise("contested")).drop("__denied")


def cancellations_with_membership(cancellations: DataFrame, allowlist: DataFrame, version: int = 1) -> DataFrame:
    """Cancellations known by who submitted them."""
    return with_membership(cancellations.withColumnRenamed("transaction_from", "facilitator"), allowlist, version).withColumnRenamed("facilitator", "transaction_from")


def identities(signals: DataFrame, allowlist: DataFrame, version: int = 1) -> DataFrame:
    """One label for each (chain, address): by precedence of its source, then source, label and URL."""
    named = in_version(allowlist, version).where("label is not null").select("chain", "address", F.lit("allowlist").alias("source"), "label", F.lit(None).cast("string").alias("url"))
    every = signals.select("chain", "address", "source", "label", "url").where("label is not null").unionByName(named)
    rank = F.lit(len(PRECEDENCE))
    for i, source in reversed(list(enumerate(PRECEDENCE))):
        rank = F.when(F.col("source") == source, i).otherwise(rank)
    order = Window.partitionBy("chain", "address").orderBy(rank, "source", "label", F.col("url").asc_nulls_last())
    return every.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")
