"""Resumable ingest of landed batches: check, decode, pair, guard, write, commit.

A micro-batch writes its payments, cancellations, rejects and oversized amounts below a commit of its own and appends
that to the log last (`commits`), which makes them visible together. A key that a visible row has is left out, so a
batch that is replayed, or a range that is read again, adds nothing; what a broken attempt left is never read.

Nothing is lost silently. A file that is not a batch, or has no next block, stops the ingest with the log unmoved; with
`skip_files` it is listed in the rejects, and as its range is not covered, the cursor stops before it. A malformed log,
transaction or block goes to the rejects with its reason, and takes its transaction's authorizations out of pairing:
they are quarantined, counted and never payments. Payments of over 38 digits go to a table of their own, as the amount
column can't hold them; `every_payment` has both, and `cube.wide_cube` adds them up exactly.

A landed file states the blocks it covers: from `from_block`, or else its own lowest block, up to `next_block`.
Tables derived from payments catch up with the log (`derived`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payx.operators import classify, decode, pairing
from payx.operators.cube import daily_cube
from payx.schema import LANDED, PAYMENT
from payx.sources.batches import exploded
from payx.streaming import commits

KEY = ["chain", "tx_hash", "log_index"]
REJECT = "kind string, key string, reason string"
CANCELLATION = "chain string, tx_hash string, log_index int, authorizer string, transaction_from string, nonce string, block_number long, block_time timestamp, day date"
SCHEMAS = {"payments": PAYMENT, "oversized": PAYMENT, "cancellations": CANCELLATION, "rejects": REJECT}


class CandidatesLost(RuntimeError):
    """Every authorization of a batch that was neither denied nor quarantined failed to pair."""


class CursorStuck(RuntimeError):
    """A landed batch does not lead beyond its own newest block, so what follows it would never be read."""


class Malformed(RuntimeError):
    """A landed file is not a batch."""


def absent(rows: DataFrame, have: DataFrame, key: list[str] = KEY, partition: str | None = "day") -> DataFrame:
    """Rows whose key is neither in the table nor twice in the batch. Only days of the batch are compared."""
    rows = rows.dropDuplicates(key)
    if partition:
        have = have.join(rows.select(partition).distinct(), partition, "left_semi")
    return rows.join(have.select(key), key, "left_anti")


def cursor(spark: SparkSession, base: str) -> int:
    return commits.cursor(spark, base)


def stored(spark: SparkSession, base: str, name: str = "payments") -> DataFrame:
    """Visible rows of a table of an ingest."""
    return commits.visible(spark, base, name, SCHEMAS[name])


def every_payment(spark: SparkSession, base: str) -> DataFrame:
    """Visible payments with those whose amount has over 38 digits, for `cube.wide_cube`."""
    return stored(spark, base).unionByName(stored(spark, base, "oversized"))


def covered(batches: DataFrame) -> DataFrame:
    """(from_block, to_block) of every landed file."""
    low = F.array_min(F.transform(F.flatten(F.transform("data", lambda c: F.coalesce(c["blocks"], F.array()))), lambda b: b["number"]))
    start = F.coalesce(F.col("from_block"), low) if "from_block" in batches.columns else low
    return batches.select(start.alias("from_block"), F.col("next_block").alias("to_block"))


def malformed_files(batches: DataFrame) -> DataFrame:
    """(kind, key, reason) of files that are no batch; the key is the file's name."""
    broken = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in batches.columns else F.lit(False)
    reason = F.when(broken, "not a batch").when(F.col("data").isNull(), "no data").when(F.col("next_block").isNull(), "no next block")
    name = F.col("file") if "file" in batches.columns else F.lit(None).cast("string")
    return batches.select(F.lit("file").alias("kind"), name.alias("key"), reason.alias("reason")).where("reason is not null")


def write_batch(batches: DataFrame, batch_id: int, base: str, allow_loss: bool = False, cube: str | None = None, allowlist: DataFrame | None = None, skip_files: bool = False) -> None:
    """One micro-batch: rejects, oversized, payments and cancellations below one commit, then the log, then the cube."""
    spark = batches.sparkSession
    batches = batches.persist()
    done = None
    try:
        files = malformed_files(batches)
        if not skip_files and (broken := files.first()):
            raise Malformed(f"batch {batch_id}: {broken}")
        good = batches.join(F.broadcast(files.select("key")), F.col("file") == F.col("key"), "left_anti") if "file" in batches.columns else batches
        if stuck := cursor_gaps(good).first():
            raise CursorStuck(f"batch {batch_id}: {stuck}")
        logs, transactions, blocks = exploded(good)
        bad = decode.rejects(logs, transactions, blocks).dropDuplicates()
        spoiled = decode.quarantined(logs, transactions, blocks)
        transactions, blocks = transactions.dropDuplicates(["hash"]), blocks.dropDuplicates(["number"])
        logs = logs.dropDuplicates(["transaction_hash", "log_index"])
        done = pairing.assembled(logs, transactions, blocks, spoiled).persist()
        if not allow_loss and (lost := pairing.all_lost(pairing.fates(done)).first()):
            raise CandidatesLost(f"batch {batch_id}: {lost}")
        commit = commits.new_commit(batch_id)
        cancelled = pairing.cancellations(logs, transactions, blocks).join(spoiled, F.col("tx_hash") == F.col("transaction_hash"), "left_anti").withColumn("day", F.to_date("block_time"))
        commits.write(absent(bad.unionByName(files), stored(spark, base, "rejects"), ["kind", "key", "reason"], None), base, "rejects", commit)
        commits.write(absent(pairing.oversized(done), stored(spark, base, "oversized")), base, "oversized", commit, "day")
        commits.write(pairing.ordered(absent(pairing.payments(done), stored(spark, base)), "day"), base, "payments", commit, "day")
        commits.write(absent(cancelled, stored(spark, base, "cancellations")), base, "cancellations", commit, "day")
        commits.append(spark, base, commit, batch_id, covered(good))
    finally:
        if done is not None:
            done.unpersist()
        batches.unpersist()
    if cube is not None and allowlist is not None:
        refresh_cube(spark, base, allowlist, cube)


def status(spark: SparkSession, base: str) -> DataFrame:
    """Visible rows of each table of an ingest, its cursor, and the blocks that are missing before what it covers."""
    out = spark.createDataFrame([("cursor", cursor(spark, base))], "name string, n long")
    for name in SCHEMAS:
        out = out.unionByName(stored(spark, base, name).agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n")))
    return out.unionByName(commits.holes(spark, base).agg(F.lit("missing_blocks").alias("name"), F.coalesce(F.sum(F.col("to_block") - F.col("from_block")), F.lit(0)).cast("long").alias("n")))


def landed(spark: SparkSession, path: str, files: int = 16) -> DataFrame:
    """Landed files as they are, each with its name; one that is no JSON is a row with `_corrupt_record` alone."""
    x = spark.readStream.schema(LANDED).option("multiLine", "true").option("mode", "PERMISSIVE").option("maxFilesPerTrigger", files).json(path)
    return x.withColumn("file", F.col("_metadata.file_name"))


def ingest(spark: SparkSession, path: str, base: str, allow_loss: bool = False, cube: str | None = None, allowlist: DataFrame | None = None, skip_files: bool = False, files: int = 16) -> StreamingQuery:
    """Ingest all that has landed and is not yet ingested, then end. With a path and an allowlist for it, keep the daily cube too."""
    return landed(spark, path, files).writeStream.foreachBatch(lambda df, i: write_batch(df, i, base, allow_loss, cube, allowlist, skip_files)).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()


def cursor_gaps(batches: DataFrame) -> DataFrame:
    """Batches whose next block does not lie beyond their own newest one, or beyond the block they begin with."""
    top = F.array_max(F.transform(F.flatten(F.transform("data", lambda c: F.coalesce(c["blocks"], F.array()))), lambda b: b["number"]))
    top = F.greatest(top, F.col("from_block")) if "from_block" in batches.columns else top
    return batches.withColumn("top", top).where(F.col("next_block") <= F.col("top")).select("next_block", "top")


def refresh_cube(spark: SparkSession, base: str, allowlist: DataFrame, path: str) -> None:
    """Bring the daily cube up to the log: the days of all commits that it has not taken up are computed anew.

    The number of the last line that it has taken up is written after the days, so that a refresh that breaks off is
    done again by the next one.
    """
    last = commits.newest(spark, base)
    upto = existing_mark(spark, path)
    if last is None or last["n"] <= upto:
        return
    refresh_days(classify.with_membership(stored(spark, base), allowlist), commits.visible(spark, base, "payments", PAYMENT, upto), path)
    spark.createDataFrame([(last["n"],)], "n long").coalesce(1).write.mode("append").parquet(f"{path}_taken")


def existing_mark(spark: SparkSession, path: str) -> int:
    return commits.existing(spark, f"{path}_taken", "n long").agg(F.coalesce(F.max("n"), F.lit(-1))).first()[0]


def refresh_days(payments: DataFrame, changed: DataFrame, path: str) -> None:
    """Recompute the daily cube for the days of changed rows only; other days' partitions stay."""
    days = changed.select("day").distinct()
    daily_cube(payments.join(days, "day", "left_semi")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
