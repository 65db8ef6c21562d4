"""Value per cell: advertising (views x impressions x rpm x lifetime) and
subscription (arpu x lifetime), side by side with a ``type`` column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.functions import vocab as V
from audival.functions.columns import safe_div


def _keys(by_device: bool, *rest: str) -> list[str]:
    return ["month", "publication"] + (["device"] if by_device else []) + list(rest)


def views_per_user(rule: str) -> Column:
    """Page views per user.

    ``users``: page views / users; ``customers``: page views / customers;
    ``guard``: 0 where customers = 0, else page views / customers;
    ``override``: the ordered per-segment rule of the current model.
    """
    pv, users, cust = F.col("pageviews"), F.col("users"), F.col("customers")
    ls, seg = F.col("login_state"), F.col("loyalty_segment")
    if rule == "users":
        return safe_div(pv, users)
    if rule == "customers":
        return safe_div(pv, cust)
    if rule == "guard":
        return F.when(cust == 0, F.lit(0.0)).otherwise(safe_div(pv, cust))
    if rule == "override":
        return (F.when((ls == V.NO_CONSENT) & seg.isin(V.BRAND_LOVER, V.LOYAL_READER, V.RETURNING_READER),
                       safe_div(pv, users))
                .when((ls == V.NO_CONSENT) & (seg == V.CASUAL_READER), safe_div(pv, users) * 6)
                .when((ls == V.CONSENT_ONLY) & (seg == V.RETURNING_READER), safe_div(safe_div(pv, cust), F.lit(2)))
                .when((ls == V.CONSENT_ONLY) & seg.isin(V.BRAND_LOVER, V.LOYAL_READER), safe_div(pv, users))
                .when((ls == V.LOGGED_IN) & (seg == V.BRAND_LOVER), safe_div(pv, users))
                .otherwise(safe_div(pv, cust)))
    raise ValueError(f"unknown rule {rule}")


def advertising_value(cells: DataFrame, impressions: DataFrame, rpm: DataFrame,
                      customers: DataFrame | None = None, pageviews: DataFrame | None = None,
                      rule: str = "override", by_device: bool = False, scale: float | None = None,
                      per_segment: bool = True) -> DataFrame:
    """Attach impressions per page view (by login state), rpm (by
    consent status), optional customers and manual page views, then
    arpu = vpu x ipp x rpm / 1000 and value = arpu x lifetime (x ``scale``)."""
    cell = _keys(by_device, "login_state", *(["loyalty_segment"] if per_segment else []))
    rows = cells
    if pageviews is not None:
        pv_keys = ["month", "publication", "login_state"] + (["loyalty_segment"] if per_segment else [])
        rows = rows.drop("pageviews").join(
            pageviews.select(*pv_keys, F.col("page_views").alias("pageviews")), pv_keys, "left")
    rows = (rows.join(impressions.select("month", "publication", "login_state", "impressions_per_pageviews"),
                      ["month", "publication", "login_state"], "left")
            .join(rpm.select("month", "publication", "consent_status", "rpm"),
                  ["month", "publication", "consent_status"], "left"))
    if customers is not None:
        rows = rows.join(customers.select(*cell, "customers"), cell, "left")
    vpu = views_per_user(rule)
    rows = rows.withColumn("views_per_user", vpu)
    per_view = F.col("views_per_user") * F.col("impressions_per_pageviews")
    arpu = per_view * F.col("rpm") / F.lit(1000)
    value = arpu * F.col("lifetime")
    if scale is not None:
        value = value * F.lit(scale)
    extra = [c for c in ("pageviews", "customers", "users") if c in rows.columns]
    return rows.select(*cell, *extra, "views_per_user", "impressions_per_pageviews",
                       per_view.alias("impressions_per_user"), value.alias("advertising_value"),
                       arpu.alias("arpu"), "rpm", "lifetime")


def subscription_arpu(df: DataFrame, by_device: bool = False) -> DataFrame:
    """Mean subscription value per month, publication, state, segment
    (, device)."""
    keys = ["month", "publication", "login_state", "loyalty_segment"] + (["device"] if by_device else [])
    return df.groupBy(*keys).agg(F.avg("subscription_value").alias("arpu"))


def subscription_sums(df: DataFrame) -> DataFrame:
    """Sum and count of subscription values by cell and device: what every
    form of O32 is computed from."""
    keys = ["month", "publication", "login_state", "loyalty_segment", "device"]
    return df.groupBy(*keys).agg(F.sum("subscription_value").alias("total"), F.count("subscription_value").alias("n"))


def arpu_of_sums(sums: DataFrame, by_device: bool = False) -> DataFrame:
    """O32 from ``subscription_sums``."""
    keys = ["month", "publication", "login_state", "loyalty_segment"] + (["device"] if by_device else [])
    return sums.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n")).select(
        *keys, F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("arpu"))


def subscription_value(lifetime: DataFrame, arpu: DataFrame, by_device: bool = False) -> DataFrame:
    """Lifetime cells with their arpu; value = arpu x lifetime, /12 for
    yearly subscriptions. Cells without arpu keep a NULL value."""
    keys = _keys(by_device, "login_state", "loyalty_segment")
    rows = lifetime.select(*keys, F.col("average_lifetime").alias("lifetime")).join(
        arpu.select(*keys, "arpu"), keys, "left")
    value = F.when(F.col("login_state") == V.YEARLY, F.col("arpu") * F.col("lifetime") / F.lit(12)) \
        .otherwise(F.col("arpu") * F.col("lifetime"))
    return rows.select(*keys, F.lit(V.SUBSCRIPTION).alias("type"), "arpu", "lifetime",
                       value.alias("weighted_value"))


def value_by_cell(advertising: DataFrame, subscription: DataFrame, by_device: bool = False) -> DataFrame:
    """Advertising and subscription value per cell, one row per type."""
    keys = _keys(by_device, "login_state", "loyalty_segment")
    adv = advertising.select(*keys, F.lit(V.ADVERTISING).alias("type"), "arpu", "lifetime",
                             F.col("advertising_value").alias("weighted_value"))
    return adv.unionByName(subscription.select(*keys, "type", "arpu", "lifetime", "weighted_value"))
