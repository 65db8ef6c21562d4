"""Readers that bring the two GA4-style inputs to one column layout:
month (DATE), status, product, request_source, users, new_users, pageviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.functions.columns import month_from_dash, month_from_yearmonth


def ga4_export_rows(df: DataFrame) -> DataFrame:
    """Monthly export with ``yearMonth`` text and custom user/event fields."""
    return df.select(
        month_from_yearmonth("yearMonth").alias("month"),
        F.col("customUseruser_status").alias("status"),
        F.col("customUserproduct_name").alias("product"),
        F.col("customEventrequestSource").alias("request_source"),
        F.col("totalUsers").alias("users"),
        F.col("newUsers").alias("new_users"),
        F.col("screenPageViews").alias("pageviews"),
    )


def ga4_device_rows(df: DataFrame) -> DataFrame:
    """Device aggregate with ``YYYY-MM`` month text; it has no page views."""
    return df.select(
        month_from_dash("month").alias("month"),
        F.col("user_status").alias("status"),
        F.col("product_name").alias("product"),
        F.col("request_source"),
        F.col("total_users").alias("users"),
        F.col("new_users"),
        F.lit(None).cast("bigint").alias("pageviews"),
    )
