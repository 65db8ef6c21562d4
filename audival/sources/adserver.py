"""Landed ad-server report rows: one row per event, every value as typed
text (``int_value: 20240101``, ``string_value: "x"``, ``double_value: 1.5``),
as a report export delivers them. Derived from ``events``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _string(c) -> F.Column:
    return F.concat(F.lit('string_value: "'), c, F.lit('"'))


def _int(c) -> F.Column:
    return F.concat(F.lit("int_value: "), c.cast("string"))


def _double(c) -> F.Column:
    return F.concat(F.lit("double_value: "), c.cast("string"))


def landed_rows(events: DataFrame) -> DataFrame:
    """Dimensions: date, ppid_status (user id present or not),
    serving_restriction (error events are restricted), ad_unit_name_level_1
    (event type), device_category (bucket of the ``k`` property).
    Metrics: impressions (view or click), revenue_without_cpd (purchase value)."""
    k = F.get_json_object("props", "$.k").cast("int")
    device = F.when(k < 33, "DESKTOP").when(k < 66, "SMARTPHONE").otherwise("TABLET")
    impression = F.when(F.col("event_type").isin("view", "click"), 1).otherwise(0)
    revenue = F.when(F.col("event_type") == "purchase", F.col("value")).otherwise(F.lit(0.0))
    return events.select(
        "event_id",
        _int(F.replace(F.to_date("ts").cast("string"), F.lit("-"))).alias("date"),
        _string(F.when(F.col("user_id").isNotNull(), "PPID_PRESENT").otherwise("PPID_ABSENT")).alias("ppid_status"),
        _string(F.when(F.col("event_type") == "error", "RESTRICTED").otherwise("UNRESTRICTED"))
        .alias("serving_restriction"),
        _string(F.col("event_type")).alias("ad_unit_name_level_1"),
        _string(device).alias("device_category"),
        _int(impression).alias("impressions"),
        _double(revenue).alias("revenue_without_cpd"),
    )


def with_faults(landed: DataFrame) -> DataFrame:
    """The rows as a bad export delivers them: by event_id, some have a value
    without a kind, a day that is none, or a number that is none."""
    def broken(column: str, every: int, text: str) -> Column:
        return F.when(F.col("event_id") % every == 0, F.lit(text)).otherwise(F.col(column)).alias(column)
    faults = {"impressions": (89, "int_value 1"), "date": (97, "int_value: 20249901"),
              "revenue_without_cpd": (101, "double_value: n/a")}
    return landed.select(*[broken(c, *faults[c]) if c in faults else F.col(c) for c in landed.columns])


#: Days that the second of two deliveries corrects.
CORRECTED = ("2024-01-10", "2024-01-16")


def corrected(landed: DataFrame) -> DataFrame:
    """The second delivery: the corrected days, their impressions doubled."""
    day = F.to_date(F.substring_index("date", " ", -1), "yyyyMMdd")
    twice = F.concat(F.lit("int_value: "), (F.substring_index("impressions", " ", -1).cast("int") * 2).cast("string"))
    return landed.filter(day.between(*(F.lit(d).cast("date") for d in CORRECTED))).withColumn("impressions", twice)
