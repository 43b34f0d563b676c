"""Exact quantiles of many values in few groups, without one task that holds a group.

Values are counted first. A coarse histogram (a bucket is a factor of 2**(1/32) wide) of each group, some hundred
rows, tells in which bucket each wanted rank lies; only the values of those buckets are then put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _coarse(value: Column) -> Column:
    """A bucket that never falls as the value rises."""
    v = value.cast("double")
    size = F.floor(F.log2(F.abs(v) + 1) * 32)
    return F.when(v < 0, -size).otherwise(size)


def quantiles(counts: DataFrame, keys: list[str], value: str, wanted: dict[str, float], continuous: bool = False) -> DataFrame:
    """keys and a column for each wanted quantile, from counts (keys, value, n); null values are left out.

    Discrete: the first value whose share of rows up to it reaches the quantile. Continuous: linear between the two
    values around the rank 1 + q * (rows - 1), as a double.
    """
    x = counts.where(F.col(value).isNotNull()).withColumn("__c", _coarse(F.col(value)))
    bins = x.groupBy(*keys, "__c").agg(F.sum("n").alias("__n"))
    up = Window.partitionBy(*keys).orderBy("__c")
    bins = bins.withColumn("__upto", F.sum("__n").over(up)).withColumn("__total", F.sum("__n").over(Window.partitionBy(*keys)))
    ranks = []
    for name, q in wanted.items():
        if continuous:
            place = F.lit(q) * (F.col("__total") - 1) + 1
            ranks += [(name, 0, F.floor(place)), (name, 1, F.ceil(place))]
        else:
            ranks.append((name, 0, F.greatest(F.ceil(F.col("__total") * round(q * 10000) / 10000), F.lit(1))))
    asked = F.explode(F.array(*[F.struct(F.lit(n).alias("q"), F.lit(s).alias("side"), r.cast("long").alias("rank")) for n, s, r in ranks]))
    targets = bins.withColumn("__t", asked).where((F.col("__t.rank") > F.col("__upto") - F.col("__n")) & (F.col("__t.rank") <= F.col("__upto")))
    targets = targets.select(*keys, "__c", "__t.q", "__t.side", "__t.rank", (F.col("__upto") - F.col("__n")).alias("__before"), "__total")
    near = x.join(targets, [*keys, "__c"])
    order = Window.partitionBy(*keys, "q", "side").orderBy(value)
    near = near.withColumn("__run", F.col("__before") + F.sum("n").over(order)).where(F.col("__run") >= F.col("rank"))
    at = near.groupBy(*keys, "q", "side").agg(F.min(value).alias("v"), F.first("__total").alias("t"))
    pick = lambda name, side: F.max(F.when((F.col("q") == name) & (F.col("side") == side), F.col("v")))
    if not continuous:
        return at.groupBy(*keys).agg(*[pick(n, 0).alias(n) for n in wanted])
    out = []
    for name, q in wanted.items():
        place = F.lit(q) * (F.max("t") - 1)
        low, high = pick(name, 0).cast("double"), pick(name, 1).cast("double")
        mixed = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        out.append(F.round(F.when(low == high, low).otherwise(mixed), 6).alias(name))
    return at.groupBy(*keys).agg(*out)
