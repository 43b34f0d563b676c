"""Payments in each minute from a stream: state until the watermark closes a minute, updates to a table in the meantime.

A repeated payment counts once as long as the watermark hasn't passed it, and so does one that comes late; what comes
later still is left out by Spark, which counts it (`late_rows`). Such rows are in the ingest's own tables, and `again`
counts the minutes of their days anew from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payx.functions.amounts import membership
from payx.streaming import commits

KEY = ["chain", "tx_hash", "log_index"]
MINUTE = ["minute", "membership"]
MINUTES = "minute timestamp, membership string, n long, batch long, day date"


def counted(payments: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(minute, membership) -> payments, each once; a stream's in update mode, a table's as they are."""
    if payments.isStreaming:
        payments = payments.withWatermark("block_timestamp", late).dropDuplicatesWithinWatermark(KEY)
        minute = F.window("block_timestamp", "1 minute").alias("w")
        return payments.groupBy(minute, membership(F.col("facilitator_known")).alias("membership")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("minute"), "membership", "n")
    return payments.dropDuplicates(KEY).groupBy(F.date_trunc("minute", "block_timestamp").alias("minute"), membership(F.col("facilitator_known")).alias("membership")).agg(F.count(F.lit(1)).alias("n"))


def upsert(rows: DataFrame, batch: int, path: str) -> None:
    """Write the new counts of some minutes; a batch that is written again replaces itself."""
    rows.withColumn("day", F.to_date("minute")).write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={batch}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(day, minute, membership) -> payments, by the last update of each."""
    x = commits.existing(spark, path, MINUTES)
    return x.groupBy("day", *MINUTE).agg(F.max_by("n", "batch").alias("n"))


def follow(payments: DataFrame, path: str, checkpoint: str, late: str = "10 minutes") -> StreamingQuery:
    """Keep the table of minutes up with a stream of payments, as far as it has come, then end."""
    stream = counted(payments, late).writeStream.outputMode("update").foreachBatch(lambda df, i: upsert(df, i, path))
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that a query left out as they came after the watermark."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


def again(stored: DataFrame, days: DataFrame, path: str) -> None:
    """Count the minutes of some days anew from stored payments, over what the stream has said of them."""
    last = commits.existing(stored.sparkSession, path, MINUTES).agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
    upsert(counted(stored.join(days, "day", "left_semi")), last + 1, path)
