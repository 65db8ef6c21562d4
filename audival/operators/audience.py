"""Audience per month x (device) x login state, split by loyalty segment.

GA4-style rows are classified into login states and summed; a No Consent
row is added from the consent rate; then each state is split over loyalty
segments with the loyalty ratios, and re-aggregated per cell with its
lifetime (users / new users).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.functions import vocab as V
from audival.functions.columns import (
    classify_login_state, consent_status, normalise_device, safe_div, user_status_of,
)


def _keys(by_device: bool, *rest: str) -> list[str]:
    return ["month", "publication"] + (["device"] if by_device else []) + list(rest)


def clean_ga4(rows: DataFrame, publication: str, by_device: bool = False,
              with_pageviews: bool = True, device_prefix: str = "") -> DataFrame:
    """Classify (O4), strip the device prefix (O3), drop ``Other`` before
    grouping, and sum users, new users (and page views) per month,
    (device) and login state. ``rows`` comes from ``sources.ga4``."""
    state = classify_login_state("status", "product")
    device = [normalise_device("request_source", device_prefix).alias("device")] if by_device else []
    kept = rows.select("month", *device, state.alias("login_state"), "users", "new_users",
                       "pageviews").filter(F.col("login_state") != V.OTHER)
    sums = [F.sum("users").alias("users"), F.sum("new_users").alias("new_users")]
    if with_pageviews:
        sums.append(F.sum("pageviews").alias("pageviews"))
    out = kept.groupBy("month", *(["device"] if by_device else []), "login_state").agg(*sums)
    return out.select("month", F.lit(publication).alias("publication"),
                      *(["device"] if by_device else []), "login_state", "users", "new_users",
                      *(["pageviews"] if with_pageviews else []))


def without_device(clean: DataFrame) -> DataFrame:
    """O5 without devices from O5 by device."""
    return clean.groupBy("month", "publication", "login_state").agg(
        *[F.sum(c).alias(c) for c in ("users", "new_users", "pageviews")])


def enrich_pageviews(device_agg: DataFrame, export_by_device: DataFrame) -> DataFrame:
    """Device aggregate (users, new users) + page views of the export,
    matched on month, publication, login state and device."""
    pv = export_by_device.select("month", "publication", "login_state", "device", "pageviews")
    return (device_agg.select("month", "publication", "device", "login_state", "users", "new_users")
            .join(pv, ["month", "publication", "login_state", "device"], "left")
            .select("month", "publication", "device", "login_state", "users", "new_users", "pageviews"))


def add_no_consent(df: DataFrame, consent: DataFrame, mode: str = "extrapolate",
                   by_device: bool = False) -> DataFrame:
    """Add a ``No Consent`` row per month (and device) from the total
    over login states, scaled by ``1 - consent_rate`` (``share``) or by
    ``1/consent_rate - 1`` (``extrapolate``), next to the original rows."""
    measures = [c for c in ("users", "new_users", "pageviews") if c in df.columns]
    keys = _keys(by_device)
    totals = df.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    rate = F.col("consent_rate")
    if mode == "share":
        factor = F.lit(1) - rate
    elif mode == "extrapolate":
        factor = safe_div(F.lit(1), rate) - F.lit(1)
    else:
        raise ValueError(f"unknown mode {mode}")
    added = (totals.join(consent.select("month", "publication", "consent_rate"), ["month", "publication"], "left")
             .select(*keys, F.lit(V.NO_CONSENT).alias("login_state"),
                     *[(F.col(m) * factor).alias(m) for m in measures]))
    original = df.select(*keys, "login_state", *[F.col(m).cast("double").alias(m) for m in measures])
    return added.unionByName(original)


def loyalty_split(df: DataFrame, ratios: DataFrame, by_device: bool = False,
                  legacy: bool = False) -> DataFrame:
    """Split each state's measures over loyalty segments by the
    ratio of its user status (O9). ``advertising_lifetime`` is users / new
    users before the split. ``legacy`` ratio tables key the status as
    ``login_state_raw`` and have no page-view ratio."""
    main = df.withColumn("user_status", user_status_of("login_state"))
    if legacy:
        ratios = ratios.withColumnRenamed("login_state_raw", "user_status")
    keys = _keys(by_device, "user_status")
    ratio_cols = ["loyalty_ratio"] + ([] if legacy else ["loyalty_pageviews_ratio"])
    joined = main.join(ratios.select(*keys, "loyalty_segment", *ratio_cols), keys, "left")
    out = [F.col("users") * F.col("loyalty_ratio"), F.col("new_users") * F.col("loyalty_ratio")]
    names = ["users", "new_users"]
    if "pageviews" in df.columns and not legacy:
        out.append(F.col("pageviews") * F.col("loyalty_pageviews_ratio"))
        names.append("pageviews")
    return joined.select(*_keys(by_device), "login_state", "loyalty_segment",
                         *[c.alias(n) for c, n in zip(out, names)],
                         safe_div("users", "new_users").alias("advertising_lifetime"))


def audience_lifetime(split: DataFrame, by_device: bool = False,
                      per_segment: bool = True) -> DataFrame:
    """Re-aggregate per cell; lifetime = sum(users) / sum(new users);
    consent status (O10) follows from the login state."""
    keys = _keys(by_device, "login_state", *(["loyalty_segment"] if per_segment else []))
    measures = [c for c in ("users", "new_users", "pageviews") if c in split.columns]
    agg = split.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    return agg.select(*keys, consent_status("login_state").alias("consent_status"), *measures,
                      safe_div("users", "new_users").alias("lifetime"))


def pageviews_by_cell(df: DataFrame, per_segment: bool = True) -> DataFrame:
    """Manual page views per month, publication, state (, segment)."""
    keys = ["month", "publication", "login_state"] + (["loyalty_segment"] if per_segment else [])
    return df.groupBy(*keys).agg(F.sum("page_views").alias("page_views"))
