"""Schemas of the stored inputs (S1-S13) and the reader that enforces them.

Months arrive as DATE, as ``yyyy-MM-dd``, ``yyyy-MM`` or ``yyyyMM`` text; the
reader makes them the first day of the month as DATE, so that every join and
filter on a month is on one type. GA4 rows keep their month text, which the GA4
readers parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONTH = "month"
_CELL = {"month": MONTH, "publication": "string", "login_state": "string", "loyalty_segment": "string"}
SCHEMAS: dict[str, dict[str, str]] = {
    "user_metrics_monthly": {"month": MONTH, "requestSource": "string", "user_status": "string",
                             "loyalty_segment_1m": "string", "device_count": "bigint", "pageview_count": "bigint"},
    "ga4_export": {"yearMonth": "string", "customUseruser_status": "string", "customUserproduct_name": "string",
                   "customEventrequestSource": "string", "totalUsers": "bigint", "newUsers": "bigint",
                   "screenPageViews": "bigint"},
    "ga4_device_aggregate": {"month": "string", "request_source": "string", "user_status": "string",
                             "product_name": "string", "total_users": "bigint", "new_users": "bigint"},
    "manual_monthly": {"month": MONTH, "publication": "string", "rus_WEMF_and_foreign_traffic": "double",
                       "monthly_subscribers": "bigint", "yearly_subscribers": "bigint", "consent_rate": "double",
                       "no_consent_rate": "double", "one_log_not_subscribed": "bigint"},
    "consent_rate": {"month": MONTH, "publication": "string", "consent_rate": "double"},
    "rpm": {"month": MONTH, "publication": "string", "consent_status": "string", "rpm": "double"},
    "impressions_per_view": {"month": MONTH, "publication": "string", "login_state": "string",
                             "impressions_per_pageviews": "double"},
    "subscription_arpu": _CELL | {"device": "string", "subscription_value": "double"},
    "subscription_lifetime": _CELL | {"average_lifetime": "double"},
    "subscription_lifetime_device": _CELL | {"device": "string", "average_lifetime": "double"},
    "manual_pageviews": _CELL | {"page_views": "bigint"},
    # tables that the earlier models read ready-made
    "loyalty_ratio_legacy": {"month": MONTH, "publication": "string", "login_state_raw": "string",
                             "loyalty_segment": "string", "loyalty_ratio": "double"},
    "loyalty_ratio_legacy_device": {"month": MONTH, "publication": "string", "device": "string",
                                    "login_state_raw": "string", "loyalty_segment": "string",
                                    "loyalty_ratio": "double"},
    "true_customer": _CELL | {"customers": "double"},
    "customer_weight_login_state": _CELL | {"weight": "double"},
    "customer_weight_loyalty": _CELL | {"weight": "double"},
}
#: Types that a column may be stored as besides its own: widened, never parsed.
_WIDENS = {"bigint": ("int", "smallint", "tinyint"), "double": ("float", "int", "bigint")}


def month(c: Column, stored: str) -> Column:
    """The first day of a stored month."""
    if stored == "date":
        return F.trunc(c, "month")
    digits = F.replace(c, F.lit("-"))
    known = c.rlike(r"^[0-9]{4}(-?(0[1-9]|1[0-2]))(-[0-9]{2})?$")
    return F.when(c.isNull(), F.lit(None).cast("date")).when(known, F.to_date(F.substring(digits, 1, 6), "yyyyMM")).otherwise(
        F.raise_error(F.concat(F.lit("not a month: "), c)).cast("date"))


def conform(df: DataFrame, name: str) -> DataFrame:
    """The input's columns in its schema's types; a missing column or a type
    that is not a narrower form of the wanted one is an error. A DATE month
    that is stored as one stays a plain column, so filters reach the scan."""
    have, out = dict(df.dtypes), []
    for column, kind in SCHEMAS[name].items():
        if column not in have:
            raise TypeError(f"{name}: column {column} is missing")
        stored, c = have[column], F.col(column)
        if kind == MONTH:
            if stored not in ("date", "string"):
                raise TypeError(f"{name}.{column}: a month is DATE or text, not {stored}")
            out.append(c if stored == "date" else month(c, stored).alias(column))
        elif stored == kind:
            out.append(c)
        elif stored in _WIDENS.get(kind, ()):
            out.append(c.cast(kind).alias(column))
        else:
            raise TypeError(f"{name}.{column}: expected {kind}, found {stored}")
    return df.select(*out)
