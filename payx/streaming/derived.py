"""State kept beside an ingest for figures that don't add up: distinct counts, first days, windows that move.

Three tables follow the log of commits, each brought up by what is new in it:

* `pair_days`: for each day, payments by facilitator, payer, payee and amount. The days of new rows, late ones too, are
  computed anew; other days' folders stay.
* `pairs`: who paid whom through which facilitator, ever. New ones are found by an anti join and appended.
* `first_days`: the first day of each payer, known payments only. New payers and earlier days are appended; the least
  counts.

What is appended lies in a folder named for the line of the log up to which it goes, and counts once that line is among
the marks, which are written last. So a refresh that breaks off leaves nothing that is read, and the next one does its
work again. The state is for one allowlist and version; another one is kept elsewhere, from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payx.operators import classify, cube, entities, graph
from payx.schema import PAYMENT
from payx.streaming import commits

WHO = ["chain", "facilitator", "payer", "payee", "facilitator_known"]
PAIRS = "chain string, facilitator string, payer string, payee string, facilitator_known boolean"
FIRST = "payer string, first_day date"
PAIR_DAYS = f"{PAIRS}, amount_usdc decimal(38,6), n long, first_seen timestamp, last_seen timestamp, day date"


def pair_days(p: DataFrame) -> DataFrame:
    """Payments summed by day, parties and amount: what distinct counts of any window are made from."""
    return p.groupBy(*WHO, "amount_usdc", "day").agg(F.count(F.lit(1)).alias("n"), F.min("block_timestamp").alias("first_seen"), F.max("block_timestamp").alias("last_seen"))


def new_pairs(pairs: DataFrame, changed: DataFrame) -> DataFrame:
    """Pairs of changed rows that are not among the pairs yet."""
    return changed.select(WHO).distinct().join(pairs, WHO, "left_anti")


def new_first_days(first: DataFrame, changed: DataFrame) -> DataFrame:
    """Payers of changed rows that are new, or have an earlier day than before."""
    x = changed.where("facilitator_known").groupBy("payer").agg(F.min("day").alias("first_day"))
    have = first.groupBy("payer").agg(F.min("first_day").alias("__had"))
    return x.join(have, "payer", "left").where("__had is null or first_day < __had").drop("__had")


def payer_cohorts(days: DataFrame, first: DataFrame) -> DataFrame:
    """`cube.payer_cohorts` from the state: of pair_days only the last 30 days count, first days come from their table."""
    return cube.payer_cohorts(days, first.groupBy("payer").agg(F.min("first_day").alias("first_day")))


def entity_counterparties(pairs: DataFrame) -> DataFrame:
    """`graph.entity_counterparties` from the pairs alone."""
    sides = F.array(*[F.struct(F.lit(c).alias("role"), F.col(c).alias("counterparty")) for c in ("payer", "payee")])
    by_facilitator = pairs.select("facilitator", "facilitator_known", F.explode(sides).alias("s")).select("facilitator", "facilitator_known", "s.*")
    return graph.entity_counterparties(pairs, by_facilitator)


def _marks(spark: SparkSession, path: str) -> list[int]:
    return sorted(r[0] for r in commits.existing(spark, f"{path}/marks", "n long").collect())


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of `pair_days`, `pairs` or `first_days` as of the last refresh that ended."""
    if name == "pair_days":
        return commits.existing(spark, f"{path}/pair_days", PAIR_DAYS)
    rows = commits.existing(spark, f"{path}/{name}", f"{PAIRS if name == 'pairs' else FIRST}, upto long")
    marks = _marks(spark, path)
    return rows.where(F.col("upto").isin(marks) if marks else F.lit(False)).drop("upto")


def refresh(spark: SparkSession, base: str, allowlist: DataFrame, path: str) -> None:
    """Bring the state up to the log of the ingest at `base`."""
    last, marks = commits.newest(spark, base), _marks(spark, path)
    upto = marks[-1] if marks else -1
    if last is None or last["n"] <= upto:
        return
    labelled = lambda rows: classify.with_membership(rows, allowlist)
    changed = labelled(commits.visible(spark, base, "payments", PAYMENT, upto))
    fresh_pairs, fresh_first = new_pairs(read(spark, path, "pairs"), changed), new_first_days(read(spark, path, "first_days"), changed)
    whole_days = labelled(commits.visible(spark, base, "payments", PAYMENT)).join(changed.select("day").distinct(), "day", "left_semi")
    for name, rows in (("pairs", fresh_pairs), ("first_days", fresh_first)):
        rows.write.mode("overwrite").parquet(f"{path}/{name}/upto={last['n']}")
    pair_days(whole_days).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{path}/pair_days")
    spark.createDataFrame([(last["n"],)], "n long").coalesce(1).write.mode("append").parquet(f"{path}/marks")


def tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The figures that the state is kept for, without a look at any payment."""
    days = read(spark, path, "pair_days")
    return {
        "active_entities": cube.active_entities(days),
        "payer_cohorts": payer_cohorts(days, read(spark, path, "first_days")),
        "entity_aggregate": entities.entity_aggregate(days),
        "entity_counterparties": entity_counterparties(read(spark, path, "pairs")),
    }
