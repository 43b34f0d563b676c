"""Daily cube and the series read from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payx.functions import wide
from payx.functions.amounts import amount_band, membership
from payx.operators.classify import known_by_version, small, versions
from payx.operators.windows import anchor, in_windows


def daily_cube(p: DataFrame, label: str = "membership") -> DataFrame:
    """(day, chain, facilitator, label, band, version) -> txn_count, volume_usdc, max_amount_usdc.

    label is membership or another column of p, such as attribution.
    """
    x = p.withColumn("membership", membership(F.col("facilitator_known"))) if label == "membership" else p
    x = x.withColumn("band", amount_band(F.col("amount_usdc")))
    return x.groupBy("day", "chain", "facilitator", label, "band", "methodology_version").agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount_usdc").alias("volume_usdc"), F.max("amount_usdc").alias("max_amount_usdc"))


def every_version_cube(payments: DataFrame, allowlist: DataFrame) -> DataFrame:
    """The daily cubes of all versions of the allowlist, from one pass over payments.

    Payments are summed by day, facilitator and band first, which no version changes; only these sums are taken once
    for each version and labelled by the versions in which their facilitator is known.
    """
    keys = ["day", "chain", "facilitator"]
    sums = payments.groupBy(*keys, amount_band(F.col("amount_usdc")).alias("band")).agg(F.count(F.lit(1)).alias("txn_count"), F.sum("amount_usdc").alias("volume_usdc"), F.max("amount_usdc").alias("max_amount_usdc"))
    known_ = small(known_by_version(allowlist).withColumn("__known", F.lit(True)))
    x = sums.crossJoin(small(versions(allowlist))).join(known_, ["chain", "facilitator", "methodology_version"], "left")
    return x.select(*keys, membership(F.coalesce("__known", F.lit(False))).alias("membership"), "band", "methodology_version", "txn_count", "volume_usdc", "max_amount_usdc")


def wide_cube(p: DataFrame, label: str = "membership") -> DataFrame:
    """The daily cube without bands for amounts of up to 256 bits: volume and maximum are exact decimal text.

    p has `value_hex` and, where it fits, `amount_raw` of every payment, those stored apart for their size included.
    Amounts of up to 18 digits count where they are there, others by their hex. Hex is summed 32 bits at a time, and its
    largest text is the largest amount: only sums and maxima of groups, not rows, are turned into decimal digits.
    """
    x = p.withColumn("membership", membership(F.col("facilitator_known"))) if label == "membership" else p
    short = F.coalesce(F.col("amount_raw").between(0, 10**18 - 1), F.lit(False))
    plain = F.lpad(F.lower(F.hex(F.when(short, F.col("amount_raw")).cast("long"))), 64, "0")
    x = x.withColumn("wide", F.when(short, plain).when(F.col("value_hex").rlike(wide.WORD), F.lower("value_hex")))
    keys = ["day", "chain", "facilitator", label, "methodology_version"]
    x = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("txn_count"), F.max("wide").alias("most"), *wide.word_sums("wide"))
    return x.select(*keys, "txn_count", wide.text(wide.digits(wide.word_total("wide")), 6).alias("volume_usdc"), wide.text(wide.digits(wide.from_word("most")), 6).alias("max_amount_usdc"))


def known(cube: DataFrame) -> DataFrame:
    return cube.where("membership = 'known'")


def window_economy(cube: DataFrame) -> DataFrame:
    """Known payments for each window and band, and for all bands (band 'all'), counted back from the newest known day."""
    k = known(cube).withColumn("facilitator_known", F.lit(True))
    x = in_windows(k, anchor(k)).rollup("window_name", "band").agg(F.grouping("band").alias("g"), F.sum("txn_count").alias("txn_count"), F.sum("volume_usdc").alias("volume_usdc"))
    return x.where("window_name is not null").select("window_name", F.when(F.col("g") == 1, "all").otherwise(F.col("band")).alias("band"), "txn_count", "volume_usdc")


def daily_series(cube: DataFrame) -> DataFrame:
    """Known payments by day; the newest day is incomplete."""
    x = known(cube).groupBy("day").agg(F.sum("txn_count").alias("txn_count"), F.sum("volume_usdc").alias("volume_usdc"))
    return edge_flag(x, "day")


def edge_flag(series: DataFrame, day: str) -> DataFrame:
    """series with complete: false on its newest row. The newest day is one row, so nothing is sorted in one place."""
    return series.crossJoin(F.broadcast(series.agg(F.max(day).alias("__edge")))).withColumn("complete", F.col(day) != F.col("__edge")).drop("__edge")


def monthly_series(cube: DataFrame) -> DataFrame:
    """Known payments by month; complete if the data span the whole month."""
    k = known(cube)
    span = k.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    x = k.groupBy(F.trunc("day", "month").alias("month")).agg(F.sum("txn_count").alias("txn_count"), F.sum("volume_usdc").alias("volume_usdc"))
    return x.crossJoin(F.broadcast(span)).select("month", "txn_count", "volume_usdc", ((F.col("month") >= F.col("a")) & (F.last_day("month") <= F.col("b"))).alias("complete"))


def excluded_totals(cube: DataFrame) -> DataFrame:
    """What the published figures leave out."""
    return cube.where("membership = 'unknown'").agg(F.coalesce(F.sum("txn_count"), F.lit(0)).alias("txn_count"), F.coalesce(F.sum("volume_usdc"), F.lit(0).cast("decimal(38,6)")).cast("decimal(38,6)").alias("volume_usdc"))


def active_entities(p: DataFrame) -> DataFrame:
    """Distinct payers and payees by day, known payments only, with the edge flag. Each side is first made distinct."""
    k = p.where("facilitator_known")
    one = lambda c: k.select("day", c).distinct().groupBy("day").agg(F.count(F.lit(1)).alias(f"active_{c}s"))
    return edge_flag(one("payer").join(one("payee"), "day"), "day")


def velocity(p: DataFrame, time: str = "block_timestamp") -> DataFrame:
    """(day, membership) -> payments, most in a minute and 99th percentile over minutes with any."""
    return velocity_of(p.groupBy(F.to_date(time).alias("day"), membership(F.col("facilitator_known")).alias("membership"), F.date_trunc("minute", time).alias("minute")).agg(F.count(F.lit(1)).alias("n")))


def velocity_of(minutes: DataFrame) -> DataFrame:
    """The same from the payments n of each (day, membership, minute)."""
    return minutes.groupBy("day", "membership").agg(F.sum("n").alias("txn_count"), F.max("n").alias("max_per_minute"), F.expr("percentile_disc(0.99) within group (order by n)").cast("long").alias("p99_per_minute"))


def velocity_windows(daily: DataFrame) -> DataFrame:
    """Most known payments in a minute for each window."""
    k = daily.where("membership = 'known'")
    return in_windows(k, anchor(k)).groupBy("window_name").agg(F.max("max_per_minute").alias("max_per_minute"))


def facilitators(cube: DataFrame) -> DataFrame:
    """Facilitators with known payments: counts and volumes for each window, by known volume."""
    k = known(cube)
    last = anchor(k)
    x = k.crossJoin(F.broadcast(last))
    inside = lambda d: F.col("day") >= F.date_sub("anchor", d - 1)
    part = lambda c, d: F.coalesce(F.sum(F.when(inside(d), F.col(c))), F.lit(0))
    return x.groupBy("chain", "facilitator").agg(
        F.sum("txn_count").alias("txns_all"), F.sum("volume_usdc").alias("volume_all"),
        part("txn_count", 7).alias("txns_7d"), part("volume_usdc", 7).cast("decimal(38,6)").alias("volume_7d"),
        part("txn_count", 30).alias("txns_30d"), part("volume_usdc", 30).cast("decimal(38,6)").alias("volume_30d"),
    )


def payer_cohorts(p: DataFrame, first: DataFrame | None = None) -> DataFrame:
    """New and returning known payers and their volumes in the trailing 7 and 30 days, which end with the newest known day.

    p may be summed already, with a number `n` in each row. Where `first` (payer, first_day) is given, days before the
    windows are not read.
    """
    k = p.where("facilitator_known")
    # One row for each payer and day carries all that is needed, so the fact is read and shuffled once.
    amount = F.col("amount_usdc") * F.col("n") if "n" in p.columns else F.col("amount_usdc")
    if first is None:
        days = k.groupBy("payer", "day").agg(F.sum(amount).alias("volume"))
        days = days.withColumn("first_day", F.min("day").over(Window.partitionBy("payer")))
    else:
        end = k.agg(F.max("day")).first()[0]
        recent = k.where(F.col("day") > F.date_sub(F.lit(end), 30))
        days = recent.groupBy("payer", "day").agg(F.sum(amount).alias("volume")).join(first, "payer")
    x = in_windows(days, anchor(k), windows=(("7d", 7), ("30d", 30)))
    length = F.when(F.col("window_name") == "7d", 6).otherwise(29)
    x = x.where("day <= anchor").withColumn("is_new", F.col("first_day") >= F.date_sub(F.col("anchor"), length))
    payers = x.groupBy("window_name", "payer", "is_new").agg(F.sum("volume").alias("volume"))
    pick = lambda new, c: F.when(F.col("is_new") == new, c)
    money = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,6)")
    return payers.groupBy("window_name").agg(
        F.count(pick(True, F.lit(1))).alias("new_payers"), F.count(pick(False, F.lit(1))).alias("returning_payers"),
        money(pick(True, F.col("volume"))).alias("new_payer_volume_usdc"), money(pick(False, F.col("volume"))).alias("returning_payer_volume_usdc"),
    )


def status(p: DataFrame, clock: Column) -> DataFrame:
    """Payments in the day and week before a clock, and the number of facilitators."""
    since = lambda days: F.count_if(F.col("block_timestamp") > clock - F.expr(f"INTERVAL {days} DAYS"))
    return p.agg(F.count(F.lit(1)).alias("payments"), since(1).alias("last_day"), since(7).alias("last_week"), F.count_distinct("facilitator").alias("facilitators"), F.max("block_number").alias("max_block"))
