"""Tables that are written by commits, and the log that makes a commit visible.

Every attempt at a batch writes below folders of its own (`<table>/commit=<id>/`), and the line that is appended to the
log last makes all of them visible at once. Readers take the folders that the log names and no others, so they see all
of a batch or none of it, and what a broken attempt left is never read.

A line of the log also has the blocks that are covered after it, as islands: ranges without a hole between them. The
cursor is the end of the island in which the first commit began. Ranges that land beyond a hole wait in islands of
their own until the hole is filled.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOG = "n long, commit string, batch_id long, origin long, islands array<struct<from_block:long,to_block:long>>, part long"
#: Lines of the log in one folder; the newest folder alone is read for the cursor.
LINES = 500
#: So many commits are named in a filter on folders; more are joined.
NAMED = 2000


def existing(spark: SparkSession, path: str, schema) -> DataFrame:
    """What a table holds so far, none if it is not there; other errors are raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def islands(ranges: DataFrame, *keys: str) -> DataFrame:
    """(keys, from_block, to_block) of merged ranges [from_block, to_block); those that touch or overlap are one.

    Ranges without blocks (or with a null bound) cover nothing. One window for each value of keys; without keys there
    is but one, over as many rows as there are ranges.
    """
    w = Window.partitionBy(*keys).orderBy("from_block", "to_block")
    x = ranges.where("from_block < to_block").select(*keys, "from_block", "to_block")
    before = F.max("to_block").over(w.rowsBetween(Window.unboundedPreceding, -1))
    x = x.withColumn("opens", F.coalesce((before < F.col("from_block")).cast("int"), F.lit(0)))
    x = x.withColumn("island", F.sum("opens").over(w))
    return x.groupBy(*keys, "island").agg(F.min("from_block").alias("from_block"), F.max("to_block").alias("to_block")).drop("island")


def log(spark: SparkSession, base: str) -> DataFrame:
    return existing(spark, f"{base}/commits", LOG)


def newest(spark: SparkSession, base: str):
    """The last line of the log, or None."""
    x = log(spark, base)
    last = x.agg(F.max("part")).first()[0]  # folders alone
    return None if last is None else x.where(F.col("part") == last).orderBy(F.desc("n")).first()


def new_commit(batch_id: int) -> str:
    return f"{batch_id:012d}-{uuid.uuid4().hex[:12]}"


def append(spark: SparkSession, base: str, commit: str, batch_id: int, ranges: DataFrame) -> None:
    """Make a commit visible, with the ranges of blocks that it covers. One writer at a time."""
    last = newest(spark, base)
    have = spark.createDataFrame([tuple(i) for i in last["islands"]] if last else [], "from_block long, to_block long")
    merged = sorted(tuple(r) for r in islands(have.unionByName(ranges.select("from_block", "to_block"))).collect())
    n = last["n"] + 1 if last else 0
    origin = last["origin"] if last and last["origin"] is not None else min((a for a, _ in merged), default=None)
    spark.createDataFrame([(n, commit, batch_id, origin, merged, n // LINES)], LOG).coalesce(1).write.mode("append").partitionBy("part").parquet(f"{base}/commits")


def cursor(spark: SparkSession, base: str) -> int:
    """The last block before the first hole after the start; 0 before anything is covered."""
    last = newest(spark, base)
    return next((b - 1 for a, b in last["islands"] if a <= last["origin"] < b), 0) if last else 0


def holes(spark: SparkSession, base: str) -> DataFrame:
    """Ranges of blocks between what is covered."""
    last = newest(spark, base)
    found = [tuple(i) for i in last["islands"]] if last else []
    return spark.createDataFrame([(a[1], b[0]) for a, b in zip(found, found[1:], strict=False)], "from_block long, to_block long")


def visible(spark: SparkSession, base: str, name: str, schema: str, since: int = -1) -> DataFrame:
    """Rows of a table of the commits in the log, from line `since` + 1 on; other commits' folders are not read."""
    rows = existing(spark, f"{base}/{name}", f"{schema}, commit string")
    known = log(spark, base).where(F.col("n") > since).select("commit")
    some = [r[0] for r in known.limit(NAMED + 1).collect()]
    if len(some) > NAMED:
        return rows.join(known, "commit", "left_semi").drop("commit")
    return rows.where(F.col("commit").isin(some) if some else F.lit(False)).drop("commit")


def write(rows: DataFrame, base: str, name: str, commit: str, partition: str | None = None) -> None:
    """Write rows of one commit; they are seen once it is in the log."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).parquet(f"{base}/{name}/commit={commit}")
