"""Trailing windows and the membership axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payx.functions.amounts import membership
from payx.schema import WINDOWS


def anchor(p: DataFrame, known_only: bool = False, day: str = "day") -> DataFrame:
    """One row: the newest day, of known rows only or of all (column anchor)."""
    return (p.where("facilitator_known") if known_only else p).agg(F.max(day).alias("anchor"))


def window_names(day: Column, last: Column, windows=WINDOWS) -> Column:
    """Names of the windows that hold a day; there is no upper bound."""
    return F.array_compact(F.array(*[F.lit(name) if days == 0 else F.when(day >= F.date_sub(last, days - 1), name) for name, days in windows]))


def in_windows(p: DataFrame, newest: DataFrame, day: str = "day", windows=WINDOWS) -> DataFrame:
    """A row of p for each window that holds it (column window_name). One row of anchors, so the cross join is a projection."""
    return p.crossJoin(F.broadcast(newest)).withColumn("window_name", F.explode(window_names(F.col(day), F.col("anchor"), windows)))


def by_membership(p: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Aggregates by keys and membership (known, unknown, and all), in one pass over grouping sets."""
    x = p.withColumn("membership", membership(F.col("facilitator_known")))
    sets = [[*keys, "membership"], keys]
    out = x.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in keys], F.col("membership")).agg(F.grouping("membership").alias("__all"), *aggs)
    return out.withColumn("membership", F.when(F.col("__all") == 1, "all").otherwise(F.col("membership"))).drop("__all")


def with_lenses(p: DataFrame) -> DataFrame:
    """A row for lens all and, if the facilitator is known, one for lens known."""
    return p.withColumn("lens", F.explode(F.when(F.col("facilitator_known"), F.array(F.lit("all"), F.lit("known"))).otherwise(F.array(F.lit("all")))))


def unpivot(p: DataFrame, *roles: tuple[str, str, str]) -> DataFrame:
    """A row for each (role, column of the address, column of the counterparty)."""
    sides = [F.struct(F.lit(role).alias("role"), F.col(own).alias("address"), F.col(other).alias("counterparty")) for role, own, other in roles]
    return p.withColumn("__s", F.explode(F.array(*sides))).select("*", "__s.*").drop("__s")


PAIR = (("payer", "payer", "payee"), ("payee", "payee", "payer"))
TRIPLE = (*PAIR, ("facilitator", "facilitator", "payer"))


def first_by(x: DataFrame, keys: list[str], column: str, top: int, tie: str = "address") -> DataFrame:
    """The `top` rows of each key by falling column. Nothing else is in the window, so rows beyond go before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc(column), tie)
    return x.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= top).drop("__r")


def first_by_any(x: DataFrame, keys: list[str], columns: list[str], top: int, tie: str = "address") -> DataFrame:
    """The rows of each key that are among its `top` by any of some columns, each once."""
    parts = [first_by(x, keys, c, top, tie) for c in columns]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.dropDuplicates([*keys, tie])
