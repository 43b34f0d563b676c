"""How payments are carried: transaction types, fees, batches, blocks, selectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payx.functions.amounts import batch_bucket, share
from payx.operators.quantiles import quantiles
from payx.operators.windows import anchor, by_membership, in_windows
from payx.schema import BATCH_BUCKETS, SELECTOR_NAMES

_MEASURES = {"max_fee": "max_fee_per_gas", "priority_fee": "max_priority_fee_per_gas", "auth_width_s": "auth_width_s", "gas_ratio": "gas_ratio"}


def mechanics_windows(p: DataFrame) -> DataFrame:
    """(window, membership or all) -> payments by transaction type and percentiles of fees, authorization width and gas use."""
    width = (F.unix_micros("valid_before") - F.unix_micros("valid_after")) / 1e6
    x = p.withColumns({"auth_width_s": F.when(width >= 0, width), "gas_ratio": F.when(F.col("gas_limit") > 0, F.col("gas_used") / F.col("gas_limit"))})
    keys, newest = ["window_name", "membership"], anchor(p)
    types = x.groupBy("day", "facilitator_known", "tx_type").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("tx_value") > 0).alias("paid"))
    of = lambda i: F.coalesce(F.sum(F.when(F.col("tx_type") == i, F.col("n"))), F.lit(0)).alias(f"type{i}_count")
    out = by_membership(in_windows(types, newest), ["window_name"], F.sum("n").alias("settlement_count"), of(0), of(1), of(2), F.sum("paid").alias("nonzero_value_count"))
    # The four measures as rows, counted by day before days are dealt to windows.
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), F.col(c).cast("double").alias("value")) for n, c in _MEASURES.items()]))
    fine = x.select("day", "facilitator_known", rows.alias("m")).where("m.value is not null").groupBy("day", "facilitator_known", "m.measure", "m.value").agg(F.count(F.lit(1)).alias("n"))
    counts = by_membership(in_windows(fine, newest), ["window_name", "measure", "value"], F.sum("n").alias("n"))
    found = quantiles(counts, [*keys, "measure"], "value", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, continuous=True)
    # Interpolated fees in wei are rounded to hundredths: a double has no more digits at their size.
    wide = found.groupBy(keys).agg(*[F.round(F.max(F.when(F.col("measure") == n, F.col(f"p{q}"))), 2 if n.endswith("fee") else 6).alias(f"{n}_p{q}") for n in _MEASURES for q in (50, 90, 99)])
    return out.join(wide, keys, "left")


def other_types(windows: DataFrame) -> DataFrame:
    """Payments of no known transaction type."""
    return windows.select("window_name", "membership", (F.col("settlement_count") - F.col("type0_count") - F.col("type1_count") - F.col("type2_count")).alias("other_count"))


def hygiene(p: DataFrame) -> DataFrame:
    """Known payments that reuse a payer's nonce, and those that do so in one block. Null parts count as values."""
    k = p.where("facilitator_known")
    fine = k.groupBy("payer", "auth_nonce", "block_number").agg(F.count(F.lit(1)).alias("n"))
    coarse = fine.groupBy("payer", "auth_nonce").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("blocks"))
    return coarse.agg(F.sum(F.col("n") - 1).alias("nonce_reuse"), F.sum(F.col("n") - F.col("blocks")).alias("nonce_reuse_in_block"))


def with_hygiene(windows: DataFrame, p: DataFrame) -> DataFrame:
    """mechanics_windows with the reuse of nonces in its row of all time and known payments, null in the others."""
    one = (F.col("window_name") == "all") & (F.col("membership") == "known")
    x = windows.crossJoin(F.broadcast(hygiene(p)))
    return x.withColumns({c: F.when(one, F.col(c)) for c in ("nonce_reuse", "nonce_reuse_in_block")})


def batches(p: DataFrame) -> DataFrame:
    """(window, batch bucket) -> transactions and known payments, and the window's largest batch."""
    x = in_windows(p.where("facilitator_known").groupBy("day", "tx_hash").agg(F.count(F.lit(1)).alias("n")), anchor(p)).groupBy("window_name", "tx_hash").agg(F.sum("n").alias("n"))
    y = x.groupBy("window_name", batch_bucket(F.col("n")).alias("batch_bucket")).agg(F.count(F.lit(1)).alias("tx_count"), F.sum("n").alias("payment_count"), F.max("n").alias("m"))
    return y.withColumn("max_batch_size", F.max("m").over(Window.partitionBy("window_name"))).drop("m")


def batch_shares(b: DataFrame) -> DataFrame:
    """Buckets in order of magnitude, none left out, and the share of payments that come in batches."""
    every = b.select("window_name").distinct().withColumn("__b", F.explode(F.array(*[F.struct(F.lit(i).alias("bucket_order"), F.lit(x).alias("batch_bucket")) for i, x in enumerate(BATCH_BUCKETS)]))).select("window_name", "__b.*")
    x = every.join(b, ["window_name", "batch_bucket"], "left").fillna(0, ["tx_count", "payment_count"]).drop("max_batch_size")
    w = Window.partitionBy("window_name")
    return x.withColumn("pct_batched", share(F.sum(F.when(F.col("batch_bucket") != "1", F.col("payment_count")).otherwise(0)).over(w) * 100, F.sum("payment_count").over(w), 2))


def blocks(p: DataFrame) -> DataFrame:
    """Known payments in a block, for each window: most, 99th percentile, mean, and number of blocks."""
    x = in_windows(p.where("facilitator_known").groupBy("day", "block_number").agg(F.count(F.lit(1)).alias("n")), anchor(p)).groupBy("window_name", "block_number").agg(F.sum("n").alias("n"))
    return x.groupBy("window_name").agg(F.max("n").alias("max_per_block"), F.expr("percentile_disc(0.99) within group (order by n)").cast("long").alias("p99_per_block"), F.round(F.avg("n"), 6).alias("mean_per_block"), F.count(F.lit(1)).alias("distinct_blocks"))


def selectors(p: DataFrame, top: int = 15) -> DataFrame:
    """The `top` selectors with their kind in each window, for known, unknown and all payments."""
    daily = p.groupBy("day", "facilitator_known", F.col("method_selector").alias("selector_hex"), "settlement_kind").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_usdc").alias("v"))
    x = by_membership(in_windows(daily, anchor(p)), ["window_name", "selector_hex", "settlement_kind"], F.sum("n").alias("txn_count"), F.sum("v").cast("decimal(38,6)").alias("volume_usdc"))
    order = Window.partitionBy("window_name", "membership").orderBy(F.desc("txn_count"), "selector_hex", "settlement_kind")
    return x.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def named_selectors(s: DataFrame) -> DataFrame:
    """Selectors with a method name and kind; an unknown one is its own name and has no kind."""
    names = F.create_map(*[F.lit(x) for k, (name, _) in SELECTOR_NAMES.items() for x in (k, name)])
    kinds = F.create_map(*[F.lit(x) for k, (_, kind) in SELECTOR_NAMES.items() for x in (k, kind)])
    return s.withColumns({"method": F.coalesce(F.try_element_at(names, "selector_hex"), F.concat(F.lit("0x"), F.col("selector_hex"))), "method_kind": F.coalesce(F.try_element_at(kinds, "selector_hex"), F.lit(""))})
