"""Data-quality checks. Each returns the violations it finds; empty is as it must be."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _named(df: DataFrame, check: str, *detail: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.concat_ws("|", *[F.col(c).cast("string") for c in detail]).alias("detail"))


def bands_equal_windows(economy: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """Bands of a window add up to it: counts exactly, volume within a tolerance."""
    parts = economy.where("band <> 'all'").groupBy("window_name").agg(F.sum("txn_count").alias("n"), F.sum("volume_usdc").alias("v"))
    x = economy.where("band = 'all'").join(parts, "window_name")
    return _named(x.where((F.col("n") != F.col("txn_count")) | (F.abs(F.col("v") - F.col("volume_usdc")) > tolerance)), "bands_equal_windows", "window_name")


def buckets_equal_concentration(buckets: DataFrame, conc: DataFrame) -> DataFrame:
    key = ["window_name", "role"]
    x = conc.join(buckets.groupBy(key).agg(F.sum("entity_count").alias("e"), F.sum("txn_sum").alias("n"), F.sum("volume_sum").alias("v")), key, "full")
    return _named(x.where(~(F.col("e").eqNullSafe(F.col("total_entities")) & F.col("n").eqNullSafe(F.col("total_txns")) & F.col("v").eqNullSafe(F.col("total_volume")))), "buckets_equal_concentration", *key)


def concentration_equals_economy(conc: DataFrame, economy: DataFrame) -> DataFrame:
    """Payers' and payees' totals of all time equal the economy's."""
    e = economy.where("window_name = 'all' and band = 'all'").select(F.col("txn_count").alias("n"), F.col("volume_usdc").alias("v"))
    x = conc.where("window_name = 'all'").crossJoin(F.broadcast(e))
    return _named(x.where((F.col("n") != F.col("total_txns")) | (F.col("v") != F.col("total_volume"))), "concentration_equals_economy", "role")


def reliability_consistent(windows: DataFrame) -> DataFrame:
    return _named(windows.where("windowed_count > settlement_count or expired_count + not_yet_valid_count > windowed_count"), "reliability_consistent", "window_name", "membership")


def settlements_equal_economy(windows: DataFrame, economy: DataFrame, check: str = "settlements_equal_economy") -> DataFrame:
    """Known settlements of all time equal the economy's payments; for reliability and mechanics tables."""
    x = windows.where("window_name = 'all' and membership = 'known'").select("settlement_count").crossJoin(F.broadcast(economy.where("window_name = 'all' and band = 'all'").select("txn_count")))
    return _named(x.where("settlement_count <> txn_count"), check, "settlement_count", "txn_count")


def batches_equal_settlements(b: DataFrame, mechanics: DataFrame) -> DataFrame:
    """Batched payments add up to known settlements, and no transaction type is counted twice."""
    parts = b.groupBy("window_name").agg(F.sum("payment_count").alias("n"))
    x = mechanics.where("membership = 'known'").join(parts, "window_name", "left")
    return _named(x.where("n is null or n <> settlement_count or type0_count + type1_count + type2_count > settlement_count"), "batches_equal_settlements", "window_name")


def cube_equals_view(cube: DataFrame, p: DataFrame) -> DataFrame:
    """The cube has every payment once: known, unknown and together."""
    a = cube.groupBy("membership").agg(F.sum("txn_count").alias("n"), F.sum("volume_usdc").alias("v"))
    b = p.groupBy(F.when(F.col("facilitator_known"), "known").otherwise("unknown").alias("membership")).agg(F.count(F.lit(1)).alias("m"), F.sum("amount_usdc").alias("w"))
    x = a.join(b, "membership", "full")
    return _named(x.where(~(F.col("n").eqNullSafe(F.col("m")) & F.col("v").eqNullSafe(F.col("w")))), "cube_equals_view", "membership")


def days_equal_view(days: DataFrame, p: DataFrame) -> DataFrame:
    """Every role's days hold every payment once, known and unknown."""
    a = days.groupBy("role", "facilitator_known").agg(F.sum("txn_count").alias("n"), F.sum("volume_usdc").alias("v"))
    b = p.groupBy("facilitator_known").agg(F.count(F.lit(1)).alias("m"), F.sum("amount_usdc").alias("w"))
    return _named(a.join(b, "facilitator_known", "full").where(~(F.col("n").eqNullSafe(F.col("m")) & F.col("v").eqNullSafe(F.col("w")))), "days_equal_view", "role", "facilitator_known")


def edges_equal_view(edge: DataFrame, p: DataFrame) -> DataFrame:
    a = edge.groupBy("facilitator_known").agg(F.sum("txn_count").alias("n"), F.sum("volume_usdc").alias("v"))
    b = p.groupBy("facilitator_known").agg(F.count(F.lit(1)).alias("m"), F.sum("amount_usdc").alias("w"))
    return _named(a.join(b, "facilitator_known", "full").where(~(F.col("n").eqNullSafe(F.col("m")) & F.col("v").eqNullSafe(F.col("w")))), "edges_equal_view", "facilitator_known")


def facilitator_edges_equal_view(edge: DataFrame, p: DataFrame) -> DataFrame:
    """Each role's facilitator edges hold every payment once, known and unknown."""
    a = edge.groupBy("role", "facilitator_known").agg(F.sum("txn_count").alias("n"), F.sum("volume_usdc").alias("v"))
    b = p.groupBy("facilitator_known").agg(F.count(F.lit(1)).alias("m"), F.sum("amount_usdc").alias("w"))
    b = b.crossJoin(a.sparkSession.createDataFrame([("payer",), ("payee",)], "role string"))
    return _named(a.join(b, ["role", "facilitator_known"], "full").where(~(F.col("n").eqNullSafe(F.col("m")) & F.col("v").eqNullSafe(F.col("w")))), "facilitator_edges_equal_view", "role", "facilitator_known")


def known_only(facilitators: DataFrame, p: DataFrame) -> DataFrame:
    """Published facilitators that are not known."""
    known = p.where("facilitator_known").select("chain", "facilitator").distinct()
    return _named(facilitators.join(known, ["chain", "facilitator"], "left_anti"), "known_only", "facilitator")


def finite(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without a finite number in one of the columns."""
    bad = [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")) for c in columns]
    cond = bad[0]
    for b in bad[1:]:
        cond = cond | b
    return _named(df.where(cond), "finite", *columns)


def classification_keeps_rows(payments: DataFrame, classified: DataFrame) -> DataFrame:
    x = payments.agg(F.count(F.lit(1)).alias("n")).crossJoin(classified.agg(F.count(F.lit(1)).alias("m")))
    return _named(x.where("n <> m"), "classification_keeps_rows", "n", "m")


def stats_add_up(stats: DataFrame) -> DataFrame:
    return _named(stats.where("auth_logs <> denied + kept + dropped"), "stats_add_up", "auth_logs", "denied", "kept", "dropped")


def one_version(*tables: DataFrame) -> DataFrame:
    """Number of distinct versions over all tables, and the smallest."""
    x = tables[0].select("methodology_version")
    for t in tables[1:]:
        x = x.unionByName(t.select("methodology_version"))
    return x.agg(F.count_distinct("methodology_version").alias("versions"), F.min("methodology_version").alias("methodology_version"))


def ends_with_the_data(facilitator_known_days: DataFrame, as_of: str) -> DataFrame:
    """A publication day that is not the newest known day (days has day and facilitator_known)."""
    edge = facilitator_known_days.where("facilitator_known").agg(F.max("day").alias("edge"))
    return _named(edge.where(~F.col("edge").eqNullSafe(F.lit(as_of).cast("date"))), "ends_with_the_data", "edge")


#: Tables with a row for every day that has payments; others may end earlier, but none later.
EVERY_DAY = ("metrics_daily", "active_entities", "gas_daily", "reliability_daily", "entity_day")


def tables_end_with_the_data(tables: dict[str, DataFrame], as_of: object) -> DataFrame:
    """Tables by day that end on another day than the publication's, or later. A table has its known rows by membership
    or by facilitator_known, or holds known rows only."""
    out, day = None, F.lit(str(as_of)).cast("date")
    for name, df in tables.items():
        if "day" not in df.columns:
            continue
        known = df.where("membership = 'known'") if "membership" in df.columns else df.where("facilitator_known") if "facilitator_known" in df.columns else df
        edge = known.agg(F.max("day").alias("edge"))
        one = edge.where(~F.col("edge").eqNullSafe(day) if name in EVERY_DAY else F.col("edge") > day).select(F.lit("ends_with_the_data").alias("check"), F.concat_ws("|", F.lit(name), F.col("edge").cast("string")).alias("detail"))
        out = one if out is None else out.unionByName(one)
    return out
