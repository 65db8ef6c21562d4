"""Adapter from the driver's TPC-H-style tables to the model inputs.

Every input of the models is derived by plain projections and aggregates of
``orders`` x ``customer`` x per-order ``lineitem`` quantity. The same rules
are written as DuckDB SQL in ``oracle/``; the two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.functions import vocab as V
from audival.functions.columns import classify_login_state, normalise_device
from audival.sources.tables import Tables

# Fixed values of the adapter (our own choice, mirrored by the oracle).
PUBLICATION = "site_a"
OTHER_PUBLICATION = "site_b"
DEVICE_PREFIX = "app_"
WINDOW = ("1996-01-01", "1996-08-01")
IMPRESSIONS_PER_STATE = {
    V.CONSENT_ONLY: 2.0, V.NO_CONSENT: 2.25, V.LOGGED_IN: 2.5, V.MONTHLY: 2.75, V.YEARLY: 3.0,
}
PRODUCT_BY_PRIORITY = {"1": "Monatsabo", "2": "Print Combo", "3": "Jahresabo", "4": "Gift",
                       "5": "Yearly Pass"}
SEGMENT_BY_PRIORITY = {"1": V.BRAND_LOVER, "2": V.LOYAL_READER, "3": V.RETURNING_READER}


def order_facts(t: Tables) -> DataFrame:
    """One row per order: month, status, price, priority digit, request
    source and whole-number quantity (0 for an order without lines)."""
    lines = t.lineitem.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("_qty"))
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                             "o_orderdate", "o_orderpriority")
    cust = t.customer.select("c_custkey", "c_mktsegment")
    joined = (orders.join(cust, orders.o_custkey == cust.c_custkey)
              .join(lines, orders.o_orderkey == lines.l_orderkey, "left"))
    return joined.select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        F.substring("o_orderpriority", 1, 1).alias("prio"),
        F.concat(F.lit(DEVICE_PREFIX), F.lower("c_mktsegment")).alias("request_source"),
        F.coalesce(F.col("_qty").cast("bigint"), F.lit(0).cast("bigint")).alias("qty"),
    )


def order_cube(f: DataFrame) -> DataFrame:
    """Orders counted per month, request source, status, priority and new
    flag, with their quantity and price in cents: every input except the
    per-order subscription values is an aggregate of this small table."""
    return f.groupBy("month", "request_source", "o_orderstatus", "prio",
                     (F.col("o_orderkey") % 3 == 0).alias("is_new")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("qty").alias("qty"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


def _mapped(c: str, mapping: dict[str, str], default: str | None = None):
    expr = None
    for key, value in mapping.items():
        expr = (F.when(F.col(c) == key, value) if expr is None
                else expr.when(F.col(c) == key, value))
    return expr.otherwise(default) if default is not None else expr


def _date_text(c: str) -> F.Column:
    """``yyyy-MM-dd`` of a DATE, independent of the session time zone."""
    return F.col(c).cast("string")


def _segment():
    return _mapped("prio", SEGMENT_BY_PRIORITY, V.CASUAL_READER)


def _ga4_status():
    return _mapped("o_orderstatus", {"F": "Subscribed", "O": "notSubscribed", "P": "(not set)"})


def _ga4_product():
    return _mapped("prio", PRODUCT_BY_PRIORITY)


def _new_orders():
    return F.when(F.col("is_new"), F.col("n")).otherwise(F.lit(0).cast("bigint"))


def _both_publications(df: DataFrame) -> DataFrame:
    return df.withColumn("publication", F.explode(F.array(F.lit(PUBLICATION), F.lit(OTHER_PUBLICATION))))


def user_metrics_monthly(cube: DataFrame) -> DataFrame:
    status = (F.when(F.col("prio") == "4", V.NOT_SPECIFIED)
              .when(F.col("o_orderstatus") == "F", V.SUBSCRIBED)
              .when(F.col("o_orderstatus") == "O", V.NOT_SUBSCRIBED)
              .when(F.col("o_orderstatus") == "P", V.NOT_LOGGED_IN))
    return (cube.groupBy("month", F.col("request_source").alias("requestSource"),
                         status.alias("user_status"), _segment().alias("loyalty_segment_1m"))
            .agg(F.sum("n").alias("device_count"), F.sum("qty").alias("pageview_count")))


def ga4_export(cube: DataFrame) -> DataFrame:
    return (cube.groupBy(F.concat(F.substring(_date_text("month"), 1, 4), F.substring(_date_text("month"), 6, 2))
                      .alias("yearMonth"),
                      _ga4_status().alias("customUseruser_status"),
                      _ga4_product().alias("customUserproduct_name"),
                      F.col("request_source").alias("customEventrequestSource"))
            .agg(F.sum("n").alias("totalUsers"), F.sum(_new_orders()).alias("newUsers"),
                 F.sum("qty").alias("screenPageViews")))


def ga4_device_aggregate(cube: DataFrame) -> DataFrame:
    return (cube.groupBy(F.substring(_date_text("month"), 1, 7).alias("month"), "request_source",
                      _ga4_status().alias("user_status"), _ga4_product().alias("product_name"))
            .agg(F.sum("n").alias("total_users"), F.sum(_new_orders()).alias("new_users")))


def manual_monthly(cube: DataFrame) -> DataFrame:
    """Monthly figures for both publications; site_b gets other factors so a
    join that forgets the publication key shows up."""
    zero = F.lit(0).cast("bigint")
    m = cube.groupBy("month").agg(
        F.sum("n").alias("_n"),
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("n")).otherwise(zero)).alias("_nf"),
        F.sum(F.when(F.col("o_orderstatus") == "O", F.col("n")).otherwise(zero)).alias("_no"))
    m = _both_publications(m)
    site_a = F.col("publication") == PUBLICATION
    consent = (F.lit(10) + F.month("month") % 8).cast("double") / F.lit(20.0)
    return m.select(
        "month", "publication",
        (F.col("_n") * F.when(site_a, 2).otherwise(3)).cast("double").alias("rus_WEMF_and_foreign_traffic"),
        F.col("_nf").alias("monthly_subscribers"),
        F.col("_no").alias("yearly_subscribers"),
        consent.alias("consent_rate"),
        (F.lit(1.0) - consent).alias("no_consent_rate"),
        (F.col("_no") * F.when(site_a, 5).otherwise(7)).alias("one_log_not_subscribed"),
    )


def consent_rate(manual: DataFrame) -> DataFrame:
    return manual.select("month", "publication", "consent_rate")


def rpm(cube: DataFrame) -> DataFrame:
    """Revenue per mille per month: mean order price / 10,000 (summed in
    cents so the figure is exact), x0.6 without consent; site_b x2."""
    m = cube.groupBy("month").agg(F.sum("cents").alias("_cents"), F.sum("n").alias("_n"))
    base = F.col("_cents").cast("double") / F.col("_n") / F.lit(1000000.0)
    m = _both_publications(m).withColumn(
        "consent_status", F.explode(F.array(F.lit(V.CONSENT), F.lit(V.NO_CONSENT))))
    factor = (F.when(F.col("consent_status") == V.NO_CONSENT, 0.6).otherwise(1.0)
              * F.when(F.col("publication") == PUBLICATION, 1.0).otherwise(2.0))
    return m.select("month", "publication", "consent_status", (base * factor).alias("rpm"))


def impressions_per_view(cube: DataFrame) -> DataFrame:
    months = _both_publications(cube.select("month").distinct())
    states = F.array(*[F.struct(F.lit(k).alias("login_state"), F.lit(v).alias("ipp"))
                       for k, v in IMPRESSIONS_PER_STATE.items()])
    return (months.select("month", "publication", F.inline(states))
            .select("month", "publication", "login_state",
                    (F.col("ipp") * F.when(F.col("publication") == PUBLICATION, 1.0).otherwise(1.5))
                    .alias("impressions_per_pageviews")))


def _subscriber_cells(df: DataFrame, *extra: str) -> DataFrame:
    """Subscriber (status F) rows with their state, segment and device."""
    return df.filter(F.col("o_orderstatus") == "F").select(
        "month", F.lit(PUBLICATION).alias("publication"),
        classify_login_state(F.lit(V.SUBSCRIBED), _ga4_product()).alias("login_state"),
        _segment().alias("loyalty_segment"),
        normalise_device("request_source", DEVICE_PREFIX).alias("device"), *extra)


def subscription_arpu(f: DataFrame) -> DataFrame:
    """One row per subscriber order: its price / 1000 as subscription value."""
    return _subscriber_cells(f, "o_totalprice").select(
        "month", "publication", "login_state", "loyalty_segment", "device",
        (F.col("o_totalprice") / F.lit(1000.0)).alias("subscription_value"))


def subscription_lifetime(cube: DataFrame, by_device: bool = False) -> DataFrame:
    """6 + (orders in the cell mod 7) months; site_b one month longer."""
    keys = ["month", "login_state", "loyalty_segment"] + (["device"] if by_device else [])
    cells = _subscriber_cells(cube, "n").groupBy(*keys).agg(F.sum("n").alias("_n"))
    cells = _both_publications(cells)
    extra = F.when(F.col("publication") == PUBLICATION, 0).otherwise(1)
    cols = ["month", "publication", "login_state", "loyalty_segment"] + (["device"] if by_device else [])
    return cells.select(*cols, (F.lit(6) + F.col("_n") % 7 + extra).cast("double").alias("average_lifetime"))


def manual_pageviews(cube: DataFrame) -> DataFrame:
    return (cube.groupBy("month", classify_login_state(_ga4_status(), _ga4_product()).alias("login_state"),
                      _segment().alias("loyalty_segment"))
            .agg(F.sum("qty").alias("page_views"))
            .select("month", F.lit(PUBLICATION).alias("publication"), "login_state",
                    "loyalty_segment", "page_views"))


def events_window() -> tuple[str, str]:
    """Date range of the two report fixtures."""
    return ("2024-01-01", "2024-01-31")


def given_tables(ratio: DataFrame, ratio_device: DataFrame, customers: DataFrame, weight_login_state: DataFrame,
                 weight_loyalty: DataFrame) -> dict[str, DataFrame]:
    """Ready-made tables for the earlier models that differ from the chain's
    own: each is one of these with its figure scaled, by powers of two."""
    def scaled(df: DataFrame, column: str, at: str, value: str, there: float, elsewhere: float) -> DataFrame:
        return df.withColumn(column, F.col(column) * F.when(F.col(at) == value, there).otherwise(elsewhere))
    return {
        "loyalty_ratio_legacy": scaled(ratio, "loyalty_ratio", "loyalty_segment", "Brand Lover", 2.0, 0.5),
        "loyalty_ratio_legacy_device": scaled(ratio_device, "loyalty_ratio", "loyalty_segment", "Loyal Reader", 4.0, 0.25),
        "true_customer": scaled(customers, "customers", "login_state", "No Consent", 2.0, 4.0),
        "customer_weight_login_state": scaled(weight_login_state, "weight", "loyalty_segment", "Casual Reader", 2.0, 0.5),
        "customer_weight_loyalty": scaled(weight_loyalty, "weight", "login_state", "Consent Only", 0.25, 2.0),
    }
