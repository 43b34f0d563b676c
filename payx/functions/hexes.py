"""Hex quantities and words as columns. 256-bit words go through four 64-bit limbs, never through floats."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

QUANTITY = "^0x[0-9a-fA-F]+$"
#: One of 64 bits at most; 0x alone is 0.
LONG_QUANTITY = "^0x0*[0-9a-fA-F]{0,16}$"
ADDRESS = "^0x[0-9a-fA-F]{40}$"
HASH = "^0x[0-9a-fA-F]{64}$"
DATA = "^0x([0-9a-fA-F]{2})*$"


def _limb(word: Column, i: int) -> Column:
    return F.conv(F.substring(word, 1 + 16 * i, 16), 16, 10).cast("decimal(20,0)")


def word_to_decimal(word: Column) -> Column:
    """64 hex digits as decimal(38,0); null where the value has more than 38 digits."""
    high = _limb(word, 0) + _limb(word, 1)
    top, low = _limb(word, 2), _limb(word, 3)
    short = F.substring(word, 1, 48) == "0" * 48  # as most are
    return F.when(short, low.cast("decimal(38,0)")).when(high == 0, F.try_add(_times_2_64(top), low.cast("decimal(38,0)")).try_cast("decimal(38,0)"))


def _times_2_64(limb: Column) -> Column:
    """limb * 2**64 as decimal(38,0), null beyond its range."""
    # 10**38 / 2**64, rounded down; beyond it a product has more than 38 digits.
    return F.when(limb <= F.lit(Decimal(10**38 >> 64)), (limb.cast("decimal(19,0)") * F.lit(Decimal(1 << 64)).cast("decimal(20,0)")).try_cast("decimal(38,0)"))


def quantity(hexed: Column, missing: int | None = 0) -> Column:
    """0x-quantity of at most 64 bits as long; null or empty is `missing`, anything else malformed or larger is null."""
    digits = F.regexp_replace(F.substring(hexed, 3, 64), "^0+(?=.)", "")
    value = F.when(hexed.rlike(QUANTITY) & (F.length(digits) <= 16), F.conv(digits, 16, 10).try_cast("long"))
    empty = hexed.isNull() | (hexed == "") | (hexed == "0x")
    return F.when(empty, F.lit(missing).cast("long")).otherwise(value)


def big_quantity(hexed: Column) -> Column:
    """0x-quantity of at most 256 bits as decimal(38,0); null where absent, malformed or too large."""
    return F.when(hexed.rlike(QUANTITY) & (F.length(hexed) <= 66), word_to_decimal(F.lpad(F.substring(hexed, 3, 64), 64, "0")))


def topic_address(topic: Column) -> Column:
    """Address in the last 20 bytes of a topic."""
    whole = topic.startswith("0x") & (F.length(topic) == 66) & F.unhex(F.substring(topic, 3, 64)).isNotNull()
    return F.when(whole, F.lower(F.concat(F.lit("0x"), F.substring(topic, 27, 40))))


def data_word(data: Column, i: int, skip: int = 0) -> Column:
    """The i-th 32-byte word after `skip` bytes as 64 hex digits; null where data is shorter."""
    start = 3 + 2 * skip + 64 * i
    return F.when(F.length(data) >= start + 63, F.substring(data, start, 64))


def selector(data: Column) -> Column:
    """First four bytes of calldata as eight hex digits; null where it is shorter."""
    return F.when(F.length(data) >= 10, F.lower(F.substring(data, 3, 8)))
