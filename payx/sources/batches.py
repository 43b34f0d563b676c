"""Raw ledger batches: nested JSON of chunks of logs, transactions and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payx.schema import BATCH, PAYMENT, TOKEN


def read(spark: SparkSession, path: str) -> DataFrame:
    """Batches as they were landed; the schema is fixed."""
    return spark.read.schema(BATCH).option("multiLine", "true").json(path)


def exploded(batches: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(logs, transactions, blocks) of all chunks of all batches, with the logs' topics as an array."""
    chunk = batches.select(F.explode("data").alias("c"))
    part = lambda name: chunk.select(F.explode(f"c.{name}").alias("x")).select("x.*")
    return with_topics(part("logs")), part("transactions"), part("blocks")


def with_topics(logs: DataFrame) -> DataFrame:
    """topic0..topic3 as `topics`, up to the first that is null or empty."""
    wire = F.array(*[F.when(F.col(f"topic{i}") != "", F.col(f"topic{i}")) for i in range(4)])
    end = F.array_position(F.transform(wire, lambda t: t.isNull()), True)
    return logs.withColumn("topics", F.when(end > 0, F.slice(wire, 1, (end - 1).cast("int"))).otherwise(wire)).drop("topic0", "topic1", "topic2", "topic3")


def selected(logs: DataFrame, topics: tuple[str, ...], first_block: int, last_block: int, token: str = TOKEN) -> DataFrame:
    """Logs of blocks first to last, both included, that share a transaction with a log of the token under one of the topics."""
    inside = logs.where(F.col("block_number").between(first_block, last_block))
    hits = inside.where((F.lower("address") == token) & F.get("topics", F.lit(0)).isin(*topics)).select("transaction_hash").distinct()
    return inside.join(hits, "transaction_hash", "left_semi")


def payments(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Stored payments by PAYMENT, of the days since..until, both included; other days' folders are not read."""
    x = spark.read.schema(PAYMENT).parquet(path)
    if since:
        x = x.where(F.col("day") >= F.lit(since).cast("date"))
    return x.where(F.col("day") <= F.lit(until).cast("date")) if until else x


def store_by_transaction(payments_: DataFrame, table: str, buckets: int) -> DataFrame:
    """Payments as a table in buckets by transaction, sorted in each: what is grouped by transaction needs no shuffle.

    A bucket should fit a task: some 10 million payments.
    """
    payments_.repartition(buckets, "tx_hash").write.mode("overwrite").bucketBy(buckets, "tx_hash").sortBy("tx_hash").saveAsTable(table)
    return payments_.sparkSession.table(table)
