"""Key checks for lookup tables: a left join against a lookup with a repeated
key multiplies rows silently, so the batch run can check the lookups first.
Each check is one distributed aggregate; only a handful of offending keys
ever reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.plans.inputs import Inputs

# Lookup inputs and the keys the models join them on.
LOOKUP_KEYS = {
    "manual_monthly": ["month", "publication"],
    "consent_rate": ["month", "publication"],
    "rpm": ["month", "publication", "consent_status"],
    "impressions_per_view": ["month", "publication", "login_state"],
    "subscription_lifetime": ["month", "publication", "login_state", "loyalty_segment"],
    "subscription_lifetime_device": ["month", "publication", "login_state", "loyalty_segment", "device"],
}

#: The same for the ready-made tables of the earlier models, where given.
_CELL = ["month", "publication", "login_state", "loyalty_segment"]
GIVEN_KEYS = {
    "loyalty_ratio_legacy": ["month", "publication", "login_state_raw", "loyalty_segment"],
    "loyalty_ratio_legacy_device": ["month", "publication", "device", "login_state_raw", "loyalty_segment"],
    # customers are summed by cell before they are joined, so a cell may repeat
    "customer_weight_login_state": _CELL,
    "customer_weight_loyalty": _CELL,
}


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def assert_unique(df: DataFrame, keys: list[str], name: str, examples: int = 5) -> None:
    found = duplicate_keys(df, keys).take(examples)
    if found:
        raise ValueError(f"{name}: join keys {keys} repeat, e.g. {[tuple(r) for r in found]}")


def check_lookups(inp: Inputs) -> None:
    for name, keys in LOOKUP_KEYS.items():
        assert_unique(getattr(inp, name), keys, name)
    for name, keys in GIVEN_KEYS.items():
        if getattr(inp, name) is not None:
            assert_unique(getattr(inp, name), keys, name)
