"""Long lists stored in order with a sparse index, so that a page reads the files and row groups of its own range.

A listing holds many lists, told apart by their keys, each in one order. Rows are dealt to files by ranges of keys and
order, so a list of any length spreads over files and a file may hold many lists. `seq` numbers the rows of a file. The
index has a row for each step, which is up to `every` rows of one list in one file: its file, its first number, its
first values of the order, and how many rows of the list come before it. Keys and order must not be null, which is
refused, and the order should be total; rows that are equal in it are next to each other in any order.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


class Listing(NamedTuple):
    path: str
    keys: tuple[str, ...]
    order: tuple[tuple[str, bool], ...]  # column, and whether it falls
    every: int = 1000


def store(rows: DataFrame, to: Listing, files: int, *totals: Column) -> None:
    """Write the lists in one shuffle of their rows, then the index and each list's `total` of rows and other totals."""
    spark, keys = rows.sparkSession, list(to.keys)
    types = dict(rows.dtypes)
    checked = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null in {c}")).cast(types[c])) for c in (*keys, *(c for c, _ in to.order))}
    sort = [*keys, *(F.desc(c) if falling else F.asc(c) for c, falling in to.order)]
    placed = rows.withColumns(checked).repartitionByRange(files, *sort).sortWithinPartitions(*sort).withColumn("seq", F.monotonically_increasing_id())
    placed.write.option("maxRecordsPerFile", 0).parquet(f"{to.path}/rows")
    stored = spark.read.schema(placed.schema).parquet(f"{to.path}/rows")
    first = F.min_by(F.struct(*[c for c, _ in to.order]), F.col("seq"))
    # Numbers of different files lie apart, so a step is of one file. Steps are found once; the rest is made from them.
    steps = stored.groupBy(*keys, _step(to).alias("step")).agg(F.min("_metadata.file_name").alias("file"), F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n"), first.alias("first"))
    steps.write.parquet(f"{to.path}/steps")
    steps = spark.read.parquet(f"{to.path}/steps")
    # Rows before a step: those of the list in files before, of which there is one number each, and in its own.
    parts = steps.groupBy(*keys, "file").agg(F.sum("n").alias("__m"), F.min("first_seq").alias("__at"))
    before = parts.select(*keys, "file", (F.sum("__m").over(Window.partitionBy(*keys).orderBy("__at")) - F.col("__m")).alias("__before"))
    inside = F.sum("n").over(Window.partitionBy(*keys, "file").orderBy("first_seq")) - F.col("n")
    index = steps.withColumn("__inside", inside).join(before, [*keys, "file"]).withColumn("base", F.col("__before") + F.col("__inside")).drop("__before", "__inside")
    few = max(1, files // 16)
    index.repartitionByRange(few, *keys, "base").sortWithinPartitions(*keys, "base").write.parquet(f"{to.path}/index")
    summed = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), *totals) if totals else steps.groupBy(*keys).agg(F.sum("n").alias("total"))
    summed.repartitionByRange(few, *keys).sortWithinPartitions(*keys).write.parquet(f"{to.path}/totals")


def totals(spark: SparkSession, of: Listing) -> DataFrame:
    """A row for each list."""
    return spark.read.parquet(f"{of.path}/totals")


def page(spark: SparkSession, of: Listing, key: dict, offset: int, limit: int) -> DataFrame:
    """Rows offset+1 to offset+limit of the list of one key, with their place; none where there is no such list.

    The index names the files and numbers of the page: no other file is opened, and in those the numbers are a filter on
    sorted values that Parquet skips row groups and pages by. What is collected is a row for each step of the page.
    """
    steps = _only(_index(spark, of), key).where((F.col("base") < offset + limit) & (F.col("base") + F.col("n") > offset)).select("file", "first_seq", "n", "base").collect()
    schema = spark.read.parquet(f"{of.path}/rows").schema
    if not steps:
        return spark.createDataFrame([], schema).drop("seq").withColumn("place", F.lit(0).cast("long"))
    shifts: dict[str, tuple[int, int, int]] = {}  # in a file, a list's numbers are in a row, and so are its places
    for r in steps:
        low, high, _ = shifts.get(r["file"], (r["first_seq"], 0, 0))
        low, high = min(low, r["first_seq"]), max(high, r["first_seq"] + r["n"] - 1)
        shifts[r["file"]] = (low, high, r["base"] + 1 - r["first_seq"])
    seq = F.col("seq")
    x = _only(spark.read.schema(schema).parquet(*[f"{of.path}/rows/{f}" for f in sorted(shifts)]), key)
    x = x.where(seq.between(min(low for low, _, _ in shifts.values()), max(high for _, high, _ in shifts.values())))
    place = F.coalesce(*[F.when(seq.between(low, high), seq + shift) for low, high, shift in shifts.values()])
    return x.withColumn("place", place).where((F.col("place") > offset) & (F.col("place") <= offset + limit)).drop("seq")


def page_after(spark: SparkSession, of: Listing, key: dict, cursor: tuple, limit: int) -> DataFrame:
    """The `limit` rows of one list that come after a cursor, values of its order that need not be there."""
    value = {c: F.lit(v) for (c, _), v in zip(of.order, cursor, strict=True)}
    behind = _after(of, lambda c: F.col(f"first.{c}"), value.__getitem__)
    base = _only(_index(spark, of), key).where(~behind).agg(F.max("base")).first()[0] or 0
    # The last step that begins at the cursor or before has `every` rows at most, and the page follows those.
    x = page(spark, of, key, base, of.every + limit).where(_after(of, F.col, value.__getitem__))
    return x.orderBy("place").limit(limit)


def pages(spark: SparkSession, of: Listing, offset: int, limit: int, only: Column | None = None) -> DataFrame:
    """Rows offset+1 to offset+limit of every list, or of those whose keys meet a condition; nothing is ranked."""
    steps = _index(spark, of).where((F.col("base") < offset + limit) & (F.col("base") + F.col("n") > offset))
    x = _placed(spark, of, steps if only is None else steps.where(only), only)
    return x.where((F.col("place") > offset) & (F.col("place") <= offset + limit))


def pages_after(spark: SparkSession, of: Listing, cursors: DataFrame, limit: int) -> DataFrame:
    """The `limit` rows of every list after its own cursor, numbered from 1 as place; lists without a cursor have none.

    cursors has the keys and the order, one row for each list.
    """
    keys, index = list(of.keys), _index(spark, of)
    at = cursors.select(*keys, F.struct(*[c for c, _ in of.order]).alias("__cursor"))
    behind = _after(of, lambda c: F.col(f"first.{c}"), lambda c: F.col(f"__cursor.{c}"))
    start = index.join(at, keys).groupBy(*keys, "__cursor").agg(F.coalesce(F.max(F.when(~behind, F.col("base"))), F.lit(0)).alias("__from"))
    steps = index.join(start, keys).where((F.col("base") >= F.col("__from")) & (F.col("base") < F.col("__from") + of.every + limit))
    x = _placed(spark, of, steps, None, "__cursor").where(_after(of, F.col, lambda c: F.col(f"__cursor.{c}"))).drop("__cursor")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) if falling else F.asc(c) for c, falling in of.order]))
    return x.withColumn("place", place).where(F.col("place") <= limit)


def _step(of: Listing) -> Column:
    return F.col("seq") - F.col("seq") % of.every


def _index(spark: SparkSession, of: Listing) -> DataFrame:
    return spark.read.parquet(f"{of.path}/index")


def _only(df: DataFrame, key: dict) -> DataFrame:
    for name, value in key.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def _placed(spark: SparkSession, of: Listing, steps: DataFrame, only: Column | None, *more: str) -> DataFrame:
    """Rows of some steps with their place in their list; a step has `every` rows at most, so no key is hot."""
    rows = spark.read.parquet(f"{of.path}/rows")
    shift = steps.select(*of.keys, "step", (F.col("base") + 1 - F.col("first_seq")).alias("__shift"), *more)
    x = (rows if only is None else rows.where(only)).withColumn("step", _step(of)).join(shift, [*of.keys, "step"])
    return x.withColumn("place", F.col("seq") + F.col("__shift")).drop("seq", "step", "__shift")


def _after(of: Listing, row: Callable[[str], Column], cursor: Callable[[str], Column]) -> Column:
    """Whether a row comes after a cursor in the order of the lists."""
    out = F.lit(False)
    for c, falling in reversed(of.order):
        a, b = row(c), cursor(c)
        out = (a < b if falling else a > b) | (a == b) & out
    return out
