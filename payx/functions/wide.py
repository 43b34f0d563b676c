"""Exact whole numbers of up to 256 bits and their sums, in built-in functions.

A wide number is an array of whole numbers below 10**9, the least first: one such limb times 2**32, and a carry, fits
a long. Sums add limb by limb, with partial sums before the shuffle as any sum, and carry once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMBS, BASE = 9, "1000000000L"
#: Limbs of a sum: two more than a number's, for 10**18 numbers.
SUM_LIMBS = LIMBS + 2
WORD = "^[0-9a-fA-F]{64}$"


def from_word(word: str) -> Column:
    """The number of a column of 64 hex digits; null for null and for anything else.

    Digits are taken 32 bits at a time, the highest first: what there is times 2**32, and the next.
    """
    digits = f"transform(sequence(0, 7), i -> cast(conv(substring({word}, 1 + 8 * i, 8), 16, 10) as bigint))"
    return F.when(F.col(word).rlike(WORD), F.expr(_limbs(digits, LIMBS)))


def _limbs(digits: str, limbs: int) -> str:
    """Limbs of a number from its digits of 32 bits, the highest first."""
    step = f"named_struct('c', (x * 4294967296L + s.c) div {BASE}, 'o', concat(s.o, array((x * 4294967296L + s.c) % {BASE})))"
    return f"aggregate({digits}, array_repeat(0L, {limbs}), (a, d) -> aggregate(a, named_struct('c', d, 'o', cast(array() as array<bigint>)), (s, x) -> {step}, s -> s.o))"


def word_sums(word: str) -> list[Column]:
    """Aggregates that `word_total` puts together: the sum of each 32 bits of a column of 64 hex digits or null, by name.

    Rows need no limbs: numbers become decimal after they are summed.
    """
    return [F.sum(F.conv(F.substring(word, 1 + 8 * i, 8), 16, 10).cast("decimal(18,0)")).alias(f"{word}_{i}") for i in range(8)]


def word_total(word: str) -> Column:
    """The wide sum of word_sums(word), with SUM_LIMBS limbs; 0 where there was nothing to add."""
    parts = ", ".join(f"coalesce({word}_{i}, 0)" for i in range(7, -1, -1)) + ", 0, 0"
    step = "named_struct('c', cast((x + s.c) div 4294967296 as decimal(30,0)), 'o', concat(s.o, array(cast((x + s.c) % 4294967296 as bigint))))"
    digits = f"aggregate(transform(array({parts}), x -> cast(x as decimal(30,0))), named_struct('c', cast(0 as decimal(30,0)), 'o', cast(array() as array<bigint>)), (s, x) -> {step}, s -> s.o)"
    return F.expr(_limbs(f"reverse({digits})", SUM_LIMBS))


def from_long(number: Column) -> Column:
    """The same of whole numbers from 0 up to 18 digits."""
    n = number.cast("decimal(18,0)")
    low = (n % 1_000_000_000).cast("long")
    high = F.floor(n / 1_000_000_000).cast("long")  # decimals divide exactly enough: 18 digits by 10
    return F.when(n.isNotNull(), F.concat(F.array(low, high), F.array_repeat(F.lit(0).cast("long"), LIMBS - 2)))


def limb_sums(wide: str) -> list[Column]:
    """Aggregates that `total` puts together: the sum of each limb of a column of wide numbers, by name."""
    return [F.sum(F.col(wide)[i].cast("decimal(38,0)")).alias(f"{wide}_{i}") for i in range(LIMBS)]


def total(wide: str) -> Column:
    """The wide sum of limb_sums(wide), with SUM_LIMBS limbs; 0 where there was nothing to add."""
    limbs = ", ".join(f"coalesce({wide}_{i}, 0)" for i in range(LIMBS)) + ", 0" * (SUM_LIMBS - LIMBS)
    step = f"named_struct('c', cast((cast(x as decimal(37,0)) + s.c) div {BASE} as decimal(37,0)), 'o', concat(s.o, array(cast((cast(x as decimal(37,0)) + s.c) % {BASE} as bigint))))"
    return F.expr(f"aggregate(transform(array({limbs}), x -> cast(x as decimal(37,0))), named_struct('c', cast(0 as decimal(37,0)), 'o', cast(array() as array<bigint>)), (s, x) -> {step}, s -> s.o)")


def digits(wide: Column) -> Column:
    """All decimal digits of a wide number with zeros before it, so that texts of numbers with as many limbs sort as they do."""
    return F.array_join(F.reverse(F.transform(wide, lambda x: F.lpad(x.cast("string"), 9, "0"))), "")


def text(digits_: Column, scale: int = 0) -> Column:
    """A decimal number, without zeros before it, from digits the last `scale` of which are behind the point."""
    plain = F.regexp_replace(digits_, f"^0+(?=[0-9]{{{scale + 1}}})", "")
    if not scale:
        return plain
    return F.concat(F.left(plain, F.length(plain) - scale), F.lit("."), F.right(plain, F.lit(scale)))
