"""Customer weights, weighted roll-ups and total customer lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.operators.shares import share_of_total


def _keys(by_device: bool, *rest: str) -> list[str]:
    return ["month", "publication"] + (["device"] if by_device else []) + list(rest)


def customer_weight(customers: DataFrame, within: str, by_device: bool = False) -> DataFrame:
    """A cell's share of customers within its login state
    (``within='login_state'``) or its loyalty segment."""
    cell = _keys(by_device, "login_state", "loyalty_segment")
    cells = customers.groupBy(*cell).agg(F.sum("customers").alias("customers"))
    return (share_of_total(cells, {"weight": "customers"}, _keys(by_device, within))
            .select(*cell, "weight"))


def weighted_rollup(values: DataFrame, weight: DataFrame, keep: str, by_device: bool = False,
                    value_col: str = "weighted_value") -> DataFrame:
    """Sum of value x weight per month, publication, (device),
    ``keep`` and type. Unweighted rows add NULL, which the sum skips."""
    cell = _keys(by_device, "login_state", "loyalty_segment")
    rows = values.join(weight.select(*cell, "weight"), cell, "left")
    keys = _keys(by_device, keep, "type")
    return rows.groupBy(*keys).agg(F.sum(F.col(value_col) * F.col("weight")).alias("weighted_value"))


def total_tclv(weighted: DataFrame, customers: DataFrame, keys: list[str],
               calendar: bool = False) -> DataFrame:
    """(sum of weighted value over types) x (sum of customers) per
    month, publication and ``keys``; optionally with year and ``YYYY-Qn``."""
    cell = ["month", "publication"] + keys
    value = weighted.groupBy(*cell).agg(F.sum("weighted_value").alias("weighted_value"))
    count = customers.groupBy(*cell).agg(F.sum("customers").alias("customers"))
    rows = value.join(count, cell, "left")
    tclv = (F.col("weighted_value") * F.col("customers")).alias("tclv_value")
    if not calendar:
        return rows.select(*cell, tclv)
    year = F.year("month")
    quarter = F.concat(year.cast("string"), F.lit("-Q"), F.quarter("month").cast("string"))
    return rows.select(quarter.alias("quarter"), year.alias("year"), *cell, tclv)
