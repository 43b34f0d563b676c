"""Events and calls as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payx.functions.hexes import ADDRESS, DATA, HASH, LONG_QUANTITY, QUANTITY, big_quantity, data_word, quantity, selector, topic_address, word_to_decimal
from payx.operators.classify import small
from payx.schema import LAST_SECOND, RECEIVE_SELECTORS, TOKEN, TRANSFER, TRANSFER_SELECTORS


def topic(i: int) -> Column:
    return F.get("topics", F.lit(i))


def is_token_event(topic0: str) -> Column:
    return F.coalesce((F.lower("address") == TOKEN) & (topic(0) == topic0), F.lit(False))


def transfers(logs: DataFrame) -> DataFrame:
    """Transfers of the token: sender, receiver, value (null if it has over 38 digits; value_hex keeps it)."""
    word = data_word(F.col("data"), 0)
    x = logs.where(is_token_event(TRANSFER) & (F.size("topics") >= 3) & word.isNotNull())
    return x.select("transaction_hash", "log_index", topic_address(topic(1)).alias("sender"), topic_address(topic(2)).alias("receiver"), word_to_decimal(word).alias("value"), word.alias("value_hex"))


def nonce() -> Column:
    """An authorization's nonce in its topics."""
    return F.lower(F.substring(topic(2), 3, 64)).alias("nonce")


def authorizations(logs: DataFrame, event: str) -> DataFrame:
    """Events of one kind with authorizer and nonce in their topics."""
    x = logs.where(is_token_event(event) & (F.size("topics") >= 3))
    return x.select("transaction_hash", "block_number", "log_index", present(logs, "transaction_index", "int"), topic_address(topic(1)).alias("authorizer"), nonce())


def present(df: DataFrame, name: str, kind: str) -> Column:
    """A column that a batch may lack, else null."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)


def settlement_kind(sel: Column) -> Column:
    return F.when(sel.isin(*RECEIVE_SELECTORS), "receive").otherwise("transfer")


def bound(word: Column) -> Column:
    """A window bound as a time; null if absent, 0 or after LAST_SECOND."""
    seconds = word_to_decimal(word)
    return F.when((seconds > 0) & (seconds <= LAST_SECOND), F.timestamp_seconds(seconds.cast("long")))


def with_call(transactions: DataFrame) -> DataFrame:
    """transactions with selector, settlement kind, window, and cost fields as numbers.

    The window is read from direct calls that are long enough; required quantities that are missing are 0, nullable ones null.
    """
    sel = selector(F.col("input"))
    direct = sel.isin(*TRANSFER_SELECTORS, *RECEIVE_SELECTORS) & (F.length("input") >= 2 + 2 * 164)
    word = lambda i: F.when(direct, data_word(F.col("input"), i, 4))
    used, price = quantity(F.col("gas_used")), big_quantity(F.col("effective_gas_price"))
    return transactions.select(
        F.col("hash").alias("transaction_hash"), F.lower("from").alias("facilitator"), F.lower("to").alias("called_contract"), sel.alias("method_selector"), settlement_kind(sel).alias("settlement_kind"),
        bound(word(3)).alias("valid_after"), bound(word(4)).alias("valid_before"), F.col("type").alias("tx_type"), quantity(F.col("nonce")).alias("tx_nonce"), used.alias("gas_used"), quantity(F.col("gas"), None).alias("gas_limit"),
        F.coalesce(price, F.lit(0)).alias("effective_gas_price"), (used * F.coalesce(price, F.lit(0)).cast("decimal(18,0)")).cast("decimal(38,0)").alias("gas_cost_wei"), big_quantity(F.col("max_fee_per_gas")).alias("max_fee_per_gas"),
        big_quantity(F.col("max_priority_fee_per_gas")).alias("max_priority_fee_per_gas"), F.coalesce(big_quantity(F.col("value")), F.lit(0)).alias("tx_value"), big_quantity(F.col("l1_fee")).alias("l1_fee"),
        *[big_quantity(present(transactions, c, "string")).alias(c) for c in ("l1_gas_used", "l1_gas_price")], F.col("input").alias("input_calldata"),
    )


def with_time(blocks: DataFrame) -> DataFrame:
    return blocks.select(F.col("number").alias("block_number"), F.timestamp_seconds(quantity(F.col("timestamp"))).alias("block_timestamp"), F.lower("hash").alias("block_hash"), big_quantity(present(blocks, "base_fee_per_gas", "string")).alias("base_fee_per_gas"))


def _faults(df: DataFrame, required: str, tests: list[tuple[str, str]]) -> Column:
    """array of reasons for which a row can't be decoded; fields that a batch lacks or leaves empty are none."""
    bad = lambda c, pattern: F.col(c).isNotNull() & (F.col(c) != "") & ~F.col(c).rlike(pattern)
    none = F.when(F.coalesce(F.col(required).cast("string"), F.lit("")) == "", F.lit(f"no {required}"))
    return F.array_compact(F.array(none, *[F.when(bad(c, p), F.lit(f"bad {c}")) for c, p in tests if c in df.columns]))


def _fields(kind: str) -> tuple[str, list[tuple[str, str]]]:
    """(field that names a row, fields with their form) of logs, transactions and blocks."""
    return {
        "log": ("transaction_hash", [("address", ADDRESS), ("data", DATA), ("transaction_hash", HASH)]),
        "transaction": ("hash", [("from", ADDRESS), ("to", ADDRESS), ("hash", HASH), ("input", DATA), *[(c, LONG_QUANTITY) for c in ("nonce", "gas_used", "gas")], *[(c, QUANTITY) for c in ("effective_gas_price", "max_fee_per_gas", "max_priority_fee_per_gas", "value", "l1_fee", "l1_gas_used", "l1_gas_price")]]),
        "block": ("number", [("hash", HASH), ("timestamp", LONG_QUANTITY), ("base_fee_per_gas", QUANTITY)]),
    }[kind]


def rejects(logs: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """(kind, key, reason) of rows that can't be decoded: malformed hex, quantities too long, no name."""
    parts = []
    for kind, df in (("log", logs), ("transaction", transactions), ("block", blocks)):
        key, tests = _fields(kind)
        parts.append(df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.explode(_faults(df, key, tests)).alias("reason")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def quarantined(logs: DataFrame, transactions: DataFrame, blocks: DataFrame) -> DataFrame:
    """(transaction_hash, reason) of transactions that have a rejected log, are rejected, or lie in a rejected block.

    One row each, with the reason that comes first in its text; the name may be null. Logs and transactions are read
    once, and of them only what is quarantined is shuffled.
    """
    fault = lambda kind, df: F.concat(F.lit(f"{kind}: "), F.get(_faults(df, *_fields(kind)), F.lit(0))).alias("reason")
    x = logs.select("transaction_hash", "block_number", fault("log", logs)).unionByName(transactions.select(F.col("hash").alias("transaction_hash"), "block_number", fault("transaction", transactions)))
    bad = blocks.select(F.col("number").alias("block_number"), fault("block", blocks).alias("__block")).where("__block is not null").distinct()
    x = x.join(small(bad), "block_number", "left").select("transaction_hash", F.least("reason", "__block").alias("reason"))
    return x.where("reason is not null").groupBy("transaction_hash").agg(F.min("reason").alias("reason"))
