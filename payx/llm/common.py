"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of anything but blanks; as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    A local session without that setting (tests) gets a temporary folder. On a cluster that would be a folder of one
    machine, so there the setting is needed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="payx-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Keys with many rows are those with more than 1 of HEAVY of all, so there are at most HEAVY of them.
HEAVY_FROM, HEAVY_TO = 1000, 100_000


def salted(left: DataFrame, right: DataFrame, key: str, by: str, counts: DataFrame, total: int, how: str = "inner") -> DataFrame:
    """left joined with right, which has a row for each key, where some keys may have very many rows of left.

    counts (key, n) has the number of left's rows for each key and total that of all. Keys with many rows are dealt to
    several tasks by the hash of left's column `by`, and their row of right goes to each. The keys of that kind are at
    most HEAVY, four for each shuffle partition within bounds: so many are collected and broadcast.
    """
    spark = left.sparkSession
    heavy = min(HEAVY_TO, max(HEAVY_FROM, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    most = max(64, total // heavy)
    if total <= most:
        return left.join(right, key, how)
    keys = counts.where(F.col("n") > most).select(F.col(key).alias("__key"), F.ceil(F.col("n") / most).cast("int").alias("__parts")).collect()
    if not keys:
        return left.join(right, key, how)
    parts = F.broadcast(spark.createDataFrame(keys, counts.select(F.col(key).alias("__key"), F.lit(1).alias("__parts")).schema))
    number = lambda df: df.join(parts, df[key].eqNullSafe(F.col("__key")), "left").drop("__key")
    one = number(left).withColumn("__salt", F.pmod(F.xxhash64(by), F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    two = number(right).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return one.join(two, [key, "__salt"], how).drop("__salt")


#: Texts that go to a Python worker in one batch, at most; Spark's default of 10,000 takes hundreds of MB.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """df, after lowering the session's rows for each Arrow batch to BATCH_ROWS; a smaller setting stays.

    Spark bounds batches in bytes too (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB unless set). The setting holds
    for what runs later in the session, as it counts when a query starts; results do not depend on it.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(df.sparkSession.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """(key, its rows in order) of rows that are sorted by their first column; every group is read to its end."""
    rows = ((r[batch.schema.names[0]], r) for batch in batches for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist())
    ahead = next(rows, None)

    def group(key):
        nonlocal ahead
        while ahead and ahead[0] == key:
            row, ahead = ahead[1], None
            yield row
            ahead = next(rows, None)

    while ahead:
        key = ahead[0]
        own = group(key)
        yield key, own
        for _ in own:
            pass


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_windows(text: Column, count: int, width: int) -> Column:
    """`count` pieces of at most `width` characters, spread evenly over the whole text (array<string>)."""
    body = F.coalesce(text, F.lit(""))
    room = F.greatest(F.length(body) - width, F.lit(0))
    starts = [F.floor(room * i / max(count - 1, 1)).cast("int") + 1 for i in range(count)]
    return F.array_distinct(F.array(*[F.substring(body, s, F.lit(width)) for s in starts]))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; null ids count as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def binomial_floor(k: int, p: float, miss: float) -> int:
    """Largest c with P(Binomial(k, p) < c) <= miss."""
    total, c = 0.0, 0
    while c <= k:
        total += math.comb(k, c) * p**c * (1 - p) ** (k - c)
        if total > miss:
            return c
        c += 1
    return k


#: More ranges than this are told apart by binary search in a small vectorised function, not by one expression.
TREE = 1024
#: And there are at most so many ranges; beyond, ranges are longer. Rows stream through a range, so that costs no memory.
MOST_RANGES = 100_000


def range_buckets(df: DataFrame, key: str, rows: int) -> tuple[Column, int]:
    """A column that deals the whole numbers `key` into contiguous ranges of about `rows` rows, and their number.

    Bounds are quantiles of the key, one for each range; they hold however often the plan is run, so that a retried
    task sees the same ranges. Null keys go to range 0. Rows of one key share a range.
    """
    n = df.count()
    count = min(max(1, math.ceil(n / rows)), MOST_RANGES)
    if count == 1:
        return F.lit(0), 1
    ids = df.select(F.col(key).cast("long").alias("k")).where("k is not null")
    if count <= TREE:
        bounds = sorted({int(b) for b in ids.approxQuantile("k", [i / count for i in range(1, count)], 0.1 / count)})
        return F.when(F.col(key).isNull(), 0).otherwise(_tree(F.col(key), bounds, 0, len(bounds))), len(bounds) + 1
    some = sorted(r[0] for r in ids.sample(min(1.0, 20 * count / n), seed=1).collect())
    bounds = np.array(sorted({some[len(some) * i // count] for i in range(1, count)}), np.int64)

    @F.pandas_udf("int")
    def search(k: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, k.fillna(bounds[0]).astype("int64"), "left").astype("int32"))

    return F.when(F.col(key).isNull(), 0).otherwise(search(F.col(key))), len(bounds) + 1


def _tree(key: Column, bounds: list[int], lo: int, hi: int) -> Column:
    """Number of bounds below the key, by halves."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(key <= bounds[mid], _tree(key, bounds, lo, mid)).otherwise(_tree(key, bounds, mid + 1, hi))
