"""A key holding a third of all rows: first aggregates combine map-side
before the shuffle, and results stay exact."""

import datetime as dt
from pyspark.sql import functions as F

from audival.operators import customers as C
from audival.operators import report as RP


def skewed_metrics(spark, n=30000):
    # a third of the rows share one key; the rest spread over 500 keys
    return spark.range(n).select(
        F.lit(dt.date(2025, 8, 1)).alias("month"),
        F.when(F.col("id") % 3 == 0, F.lit("app_hot")).otherwise(F.concat(F.lit("app_"), (F.col("id") % 500).cast("string")))
        .alias("requestSource"),
        F.lit("subscribed").alias("user_status"), F.lit("Brand Lover").alias("loyalty_segment_1m"),
        F.lit(1).cast("bigint").alias("device_count"), (F.col("id") % 7).alias("pageview_count"),
    ).repartition(8)


def test_first_aggregate_is_partial_before_shuffle(spark):
    base = C.user_metrics_base(skewed_metrics(spark), "p", by_device=True, device_prefix="app_")
    text = base._jdf.queryExecution().executedPlan().toString()
    # top-down plan text: final sum, then the hash shuffle, then the partial sum below it
    shuffle = text.index("Exchange hashpartitioning")
    assert "partial_sum" in text[shuffle:] and "partial_sum" not in text[:shuffle]


def test_hot_key_results_are_exact(spark):
    df = skewed_metrics(spark)
    base = C.user_metrics_base(df, "p", by_device=True, device_prefix="app_")
    hot = base.filter(F.col("device") == "hot").first()
    assert hot["users"] == 10000
    assert hot["pageviews"] == sum(i % 7 for i in range(0, 30000, 3))
    assert base.agg(F.sum("users")).first()[0] == 30000


def test_report_hot_user(spark):
    n = 9000
    ev = spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_interval(mins=F.col("id").cast("int")))
        .alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).cast("bigint").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit(None).cast("string").alias("props"))
    out = RP.run_report(ev, [], ["totalUsers", "eventCount", "screenPageViews"], "2024-01-01", "2024-01-31").first()
    assert out["eventCount"] == n and out["screenPageViews"] == n
    assert out["totalUsers"] == len({1 if i % 3 == 0 else i for i in range(n)})
