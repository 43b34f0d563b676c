"""Scalar functions of amounts, times and labels."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from payx.schema import CONTRACT_LABELS


# Upper bounds of the steps of an amount (not included), and of numbers of payments (included).
BANDS_BELOW = (("0.01", "dust"), ("1", "micro"), ("100", "small"), ("1000", "mid"))
ENTITIES_TO = ((1, "1"), (10, "2-10"), (100, "11-100"), (1000, "101-1000"), (100000, "1001-100000"))
BATCHES_TO = ((1, "1"), (10, "2-10"), (100, "11-100"))


def usdc(raw: Column) -> Column:
    """Exact amount with six decimals from whole base units."""
    return (raw.cast("decimal(32,0)") * F.lit(Decimal("0.000001"))).cast("decimal(38,6)")


def _steps(x: Column, steps, last: str) -> Column:
    out = F.when(steps[0][0](x), steps[0][1])
    for test, label in steps[1:]:
        out = out.when(test(x), label)
    return out.otherwise(last)


def amount_band(amount: Column) -> Column:
    """dust < 0.01 <= micro < 1 <= small < 100 <= mid < 1000 <= whale."""
    return _steps(amount, [(lambda a, b=b: a < F.lit(Decimal(b)), name) for b, name in BANDS_BELOW], "whale")


def entity_bucket(n: Column) -> Column:
    """Magnitude of an entity's number of payments, upper bounds included."""
    return _steps(n, [(lambda a, b=b: a <= b, name) for b, name in ENTITIES_TO], "100000+")


def batch_bucket(n: Column) -> Column:
    return _steps(n, [(lambda a, b=b: a <= b, name) for b, name in BATCHES_TO], "100+")


def membership(known: Column) -> Column:
    return F.when(known, "known").otherwise("unknown")


def rounded(x: Column, digits: int) -> Column:
    """A double rounded as SQL engines do it, by its scaled value: Spark's round goes by the decimal text, and parts at ties."""
    return F.round(x * F.lit(10.0**digits)) / F.lit(10.0**digits)


def share(part: Column, whole: Column, digits: int = 6, empty: float | None = 0.0) -> Column:
    """part / whole as a rounded double; `empty` where whole is 0 or null."""
    value = F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)
    return value if empty is None else F.coalesce(value, F.lit(empty))


def behavior_class(txns: Column, counterparties: Column, amounts: Column, volume: Column) -> Column:
    """otc, sink, fleet, service or tail; the first rule that holds."""
    mean = F.coalesce(F.try_divide(volume.cast("double"), txns.cast("double")), F.lit(0.0))
    return (
        F.when((txns <= 20) & (mean >= 10000), "otc")
        .when((mean <= 0.01) & (txns >= 1000), "sink")
        .when((amounts <= 2) & (txns >= 1000), "fleet")
        .when((counterparties >= 50) & (amounts >= 10), "service")
        .otherwise("tail")
    )


def market_class(payees: Column) -> Column:
    """menu below 1000 payees, market from 5000 on, mixed between."""
    return F.when(payees < 1000, "menu").when(payees >= 5000, "market").otherwise("mixed")


def claim_verdict(ratio: Column) -> Column:
    return F.when(ratio.isNull(), "unmeasured").when(ratio >= 1.5, "overstated").when(ratio < 0.9, "understated").otherwise("consistent")


def query_kind(key: Column) -> Column:
    """address, tx or null."""
    return F.when(key.rlike("^0x[0-9a-fA-F]{40}$"), "address").when(key.rlike("^0x[0-9a-fA-F]{64}$"), "tx")


def explorer_url(chain: Column, kind: str, key: Column) -> Column:
    return F.when(chain == "base", F.concat(F.lit(f"https://basescan.org/{kind}/"), key))


def contract_label(chain: Column, address: Column) -> Column:
    """Label of a known contract by chain and address, in any case; null if unknown."""
    labels = F.create_map(*[F.lit(x) for (c, a), label in CONTRACT_LABELS.items() for x in (f"{c}|{a}", label)])
    return F.try_element_at(labels, F.concat_ws("|", F.lower(chain), F.lower(address)))


def scaled(value: Column, digits: int) -> Column:
    """A whole number of wei in a unit of 10**digits wei."""
    return F.round(value.cast("double") / (10.0**digits), 6)
