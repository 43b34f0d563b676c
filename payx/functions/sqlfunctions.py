"""The steps of amounts and numbers as SQL functions of a session, written from the same bounds as the column functions.

They are SQL expressions, so a query that calls them has them in its own plan, as if they were written out there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from payx.functions.amounts import BANDS_BELOW, BATCHES_TO, ENTITIES_TO


def _steps(test: str, bounds, last: str) -> str:
    return "CASE " + " ".join(f"WHEN {test.format(bound)} THEN '{name}'" for bound, name in bounds) + f" ELSE '{last}' END"


FUNCTIONS = {
    "amount_band(amount DECIMAL(38,6))": ("STRING", _steps("amount < {}", BANDS_BELOW, "whale")),
    "entity_bucket(payments BIGINT)": ("STRING", _steps("payments <= {}", ENTITIES_TO, "100000+")),
    "batch_bucket(payments BIGINT)": ("STRING", _steps("payments <= {}", BATCHES_TO, "100+")),
    "payment_membership(known BOOLEAN)": ("STRING", "CASE WHEN known THEN 'known' ELSE 'unknown' END"),
    "usdc(raw DECIMAL(38,0))": ("DECIMAL(38,6)", "CAST(CAST(raw AS DECIMAL(32,0)) * 0.000001 AS DECIMAL(38,6))"),
}


def register(spark: SparkSession) -> None:
    """Define all functions for the session; those that are there already are replaced."""
    for head, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
