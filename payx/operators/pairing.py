"""Payments from events: every authorization takes one transfer of its transaction.

Authorizations of a transaction are taken in order of their log index. Each looks at the first transfer after it that
no kept one has taken; it is kept if that transfer's sender is the authorizer, and only then takes it. So the transfers
taken after a place are always the first ones there, and the last one taken is all that has to be remembered.

Logs are read once and shuffled once, by transaction. A transaction's few logs, which its block bounds, become one row,
which meets its call; the authorizations are rows again when they have been paired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payx.functions.amounts import share, usdc
from payx.functions.hexes import data_word, topic_address, word_to_decimal
from payx.operators.classify import small
from payx.operators.decode import authorizations, is_token_event, nonce, present, topic, with_call, with_time
from payx.schema import ASSET, AUTHORIZATION_CANCELED, AUTHORIZATION_USED, DECIMALS, PROTOCOL, RECEIVE_SELECTORS, SOURCE, TOKEN, TRANSFER, TRANSFER_SELECTORS

#: The key of logs that name no transaction; no hash is like it.
UNNAMED = "\0"
_MOVE = "struct<log_index:int,sender:string,receiver:string,value_hex:string>"


def named(transaction_hash: str) -> Column:
    """A transaction's hash as a key that is never null."""
    return F.coalesce(transaction_hash, F.lit(UNNAMED))


def candidates(logs: DataFrame, transactions: DataFrame) -> DataFrame:
    """Authorizations with their transaction's call; outcome is set for those that fall out before pairing.

    dropped: no parent transaction. denied: calldata too short for a selector.
    """
    x = authorizations(logs, AUTHORIZATION_USED).join(with_call(transactions).withColumn("__tx", F.lit(True)), "transaction_hash", "left")
    return x.withColumn("outcome", F.when(F.col("__tx").isNull(), "dropped").when(F.col("method_selector").isNull(), "denied")).drop("__tx")


def by_transaction(logs: DataFrame) -> DataFrame:
    """(key, a, t): authorizations and transfers of each transaction that has authorizations, both in order.

    Logs without a transaction are each on their own.
    """
    used, word = is_token_event(AUTHORIZATION_USED), data_word(F.col("data"), 0)
    x = logs.where((F.size("topics") >= 3) & (used | (is_token_event(TRANSFER) & word.isNotNull())))
    auth = F.struct("log_index", topic_address(topic(1)).alias("authorizer"), "block_number", present(logs, "transaction_index", "int"), nonce())
    move = F.struct("log_index", topic_address(topic(1)).alias("sender"), topic_address(topic(2)).alias("receiver"), word.alias("value_hex"))
    alone = F.when(F.col("transaction_hash").isNull(), F.concat_ws(":", "block_number", "log_index"))
    x = x.select(named("transaction_hash").alias("key"), alone.alias("alone"), F.when(used, auth).alias("auth"), F.when(~used, move).alias("move")).repartition("key")
    listed = lambda c: F.sort_array(F.collect_list(c))
    return x.groupBy("key", "alone").agg(listed("auth").alias("a"), listed("move").alias("t")).where(F.size("a") > 0).drop("alone")


def _taken() -> Column:
    """For each of `a` the one of `t` that it takes, or null."""

    def step(state, auth):
        first = F.get(F.filter("t", lambda t: (t["log_index"] > auth["log_index"]) & (t["log_index"] > state["last"])), F.lit(0))
        fits = F.coalesce(first["sender"] == auth["authorizer"], F.lit(False))
        return F.struct(F.when(fits, first["log_index"]).otherwise(state["last"]).alias("last"), F.concat(state["done"], F.array(F.when(fits, first).cast(_MOVE))).alias("done"))

    start = F.struct(F.lit(-(1 << 31)).cast("int").alias("last"), F.array().cast(f"array<{_MOVE}>").alias("done"))
    return F.aggregate("a", start, step, lambda state: state["done"])


def paired(logs: DataFrame, transactions: DataFrame, quarantined: DataFrame | None = None) -> DataFrame:
    """Every authorization with its transaction's call, its outcome and, if kept, its transfer.

    quarantined: its transaction is among those of (transaction_hash, reason), which names why. dropped: no parent
    transaction, or no transfer. denied: calldata too short for a selector.
    """
    x = by_transaction(logs).join(with_call(transactions).withColumnRenamed("transaction_hash", "__tx"), F.col("key") == F.col("__tx"), "left")
    if quarantined is None:
        x = x.withColumn("reason", F.lit(None).cast("string"))
    else:
        bad = quarantined.select(named("transaction_hash").alias("__bad"), "reason")
        x = x.join(bad, F.col("key") == F.col("__bad"), "left").drop("__bad")
    before = F.when(F.col("reason").isNotNull(), "quarantined").when(F.col("__tx").isNull(), "dropped").when(F.col("method_selector").isNull(), "denied")
    x = x.withColumn("__before", before).withColumn("m", F.when(F.col("__before").isNull(), _taken()).otherwise(F.array().cast(f"array<{_MOVE}>")))
    x = x.withColumn("z", F.explode(F.arrays_zip("a", "m"))).drop("a", "t", "m", "__tx")
    x = x.select("*", "z.a.*", F.col("z.m.log_index").alias("transfer_index"), "z.m.receiver", "z.m.value_hex").drop("z")
    outcome = F.coalesce("__before", F.when(F.col("transfer_index").isNull(), "dropped").otherwise("kept"))
    return x.withColumns({"outcome": outcome, "transaction_hash": F.nullif("key", F.lit(UNNAMED)), "value": word_to_decimal(F.col("value_hex"))}).drop("key", "__before")


def assembled(logs: DataFrame, transactions: DataFrame, blocks: DataFrame, quarantined: DataFrame | None = None) -> DataFrame:
    """Every authorization with its outcome (kept, denied, dropped, quarantined for a reason) and, if kept, all columns
    of a payment.

    A kept pair whose block is missing is dropped. A value of over 38 digits is null; value_hex has it. `ordered` gives
    the rows in the order of their blocks.
    """
    x = paired(logs, transactions, quarantined).join(small(with_time(blocks)), "block_number", "left")
    outcome = F.when((F.col("outcome") == "kept") & F.col("block_timestamp").isNull(), "dropped").otherwise(F.col("outcome"))
    fixed = lambda value, name, kind="string": F.lit(value).cast(kind).alias(name)
    return x.select(
        outcome.alias("outcome"), "reason", fixed("base", "chain"), F.lower("transaction_hash").alias("tx_hash"), "log_index", "block_number", "block_timestamp", F.to_date("block_timestamp").alias("day"), fixed(SOURCE, "source"), fixed(PROTOCOL, "protocol"), "facilitator",
        F.col("authorizer").alias("payer"), F.col("receiver").alias("payee"), fixed(None, "payee_service_id", "long"), fixed(ASSET, "asset"), fixed(TOKEN, "token_address"), fixed(DECIMALS, "token_decimals", "int"), fixed(ASSET, "token_symbol"),
        F.col("value").alias("amount_raw"), usdc(F.col("value")).alias("amount_usdc"), "value_hex", fixed(1, "asset_usd_at_time", "decimal(20,8)"), F.col("nonce").alias("auth_nonce"), "method_selector", "settlement_kind", (F.col("facilitator") == F.col("receiver")).alias("self_settled"), "called_contract", "input_calldata", "valid_after", "valid_before",
        "block_hash", "transaction_index", "tx_type", "tx_nonce", "tx_value", "gas_used", "gas_limit", "effective_gas_price", "gas_cost_wei", "base_fee_per_gas", "max_fee_per_gas", "max_priority_fee_per_gas", "l1_fee", "l1_gas_used", "l1_gas_price",
    )


def ordered(payments_: DataFrame, *first: str) -> DataFrame:
    """Payments by block and log, over ranges: files written from them ascend, and so does each in itself.

    With the column by which they are to be written in folders first, that holds in each folder.
    """
    order = [*first, "block_number", "log_index", "tx_hash"]
    return payments_.repartitionByRange(*order).sortWithinPartitions(*order)


def oversized(assembled_: DataFrame) -> DataFrame:
    """Kept payments whose value has over 38 digits: they have no amount and are no payments until looked at."""
    return assembled_.where("outcome = 'kept' and amount_raw is null").drop("outcome", "reason")


def payments(assembled_: DataFrame) -> DataFrame:
    """The kept ones that have an amount, as PAYMENT."""
    return assembled_.where("outcome = 'kept' and amount_raw is not null").drop("outcome", "reason")


def assembly_stats(assembled_: DataFrame) -> DataFrame:
    n = lambda o: F.count_if(F.col("outcome") == o)
    return assembled_.agg(F.count(F.lit(1)).alias("auth_logs"), n("denied").alias("denied"), n("kept").alias("kept"), n("dropped").alias("dropped"))


def fates(assembled_: DataFrame) -> DataFrame:
    """assembly_stats with those quarantined: kept, denied, dropped and quarantined add up to all authorizations."""
    n = lambda o: F.count_if(F.col("outcome") == o)
    return assembled_.agg(F.count(F.lit(1)).alias("auth_logs"), *[n(o).alias(o) for o in ("denied", "kept", "dropped", "quarantined")])


def quarantine_reasons(assembled_: DataFrame) -> DataFrame:
    """Authorizations that are quarantined, by reason."""
    return assembled_.where("outcome = 'quarantined'").groupBy("reason").agg(F.count(F.lit(1)).alias("auth_logs"))


def all_lost(stats: DataFrame) -> DataFrame:
    """The row of stats if every candidate that was not denied is lost, dropped or quarantined; empty is as it must be."""
    return stats.where("auth_logs - denied > 0 and kept = 0")


def cancellations(logs: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Cancelled authorizations with who submitted them and when; those without transaction or block are left out."""
    x = authorizations(logs, AUTHORIZATION_CANCELED).join(transactions.select(F.col("hash").alias("transaction_hash"), F.lower("from").alias("transaction_from")), "transaction_hash").join(with_time(blocks), "block_number")
    return x.select(F.lit("base").alias("chain"), F.col("transaction_hash").alias("tx_hash"), "log_index", "authorizer", "transaction_from", "nonce", "block_number", F.col("block_timestamp").alias("block_time"))


def probe(assembled_: DataFrame) -> DataFrame:
    """Authorizations and kept payments by selector, the most frequent first."""
    return assembled_.groupBy("method_selector").agg(F.count(F.lit(1)).alias("auth_logs"), F.count_if(F.col("outcome") == "kept").alias("matched")).orderBy(F.desc("auth_logs"), "method_selector")


def probe_report(logs: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row on a range that is looked at before it is ingested: all logs, authorizations, those with their
    transaction, those with a selector (matched), selectors, the share of authorizations in the selectors of direct
    calls (coverage), and the newest block."""
    x = candidates(logs, transactions)
    direct = F.col("method_selector").isin(*TRANSFER_SELECTORS, *RECEIVE_SELECTORS)
    seen = x.agg(F.count(F.lit(1)).alias("auth_logs"), F.count_if(F.coalesce("outcome", F.lit("")) != "dropped").alias("with_transaction"), F.count("method_selector").alias("matched"), F.count_distinct("method_selector").alias("selectors"), share(F.count_if(direct), F.count(F.lit(1))).alias("coverage"))
    return logs.agg(F.count(F.lit(1)).alias("total_logs")).crossJoin(seen).crossJoin(blocks.agg(F.max("number").alias("last_block")))
