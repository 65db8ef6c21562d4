"""Customers per month x (device) x loyalty segment x login state.

Measured users are scaled to the official reach, then split into No Consent,
Logged-In, Monthly and Yearly subscribers from the monthly manual figures and
the loyalty ratios; Consent Only is what remains of the ground truth.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audival.functions import vocab as V
from audival.functions.columns import all_not_null, normalise_device, safe_div
from audival.operators.shares import share_of_total


def _keys(by_device: bool, *rest: str) -> list[str]:
    return ["month", "publication"] + (["device"] if by_device else []) + list(rest)


def _date(value) -> F.Column:
    if isinstance(value, (dt.date, dt.datetime)):
        return F.lit(value)
    return F.lit(value).cast("date")


def user_metrics_base(df: DataFrame, publication: str, start=None, end=None,
                      by_device: bool = False, device_prefix: str = "") -> DataFrame:
    """Drop notSpecified (and NULL) statuses and months outside the
    inclusive window, then sum devices -> users and page views per month,
    (device), status and loyalty segment. Both filters reach the scan."""
    rows = df.filter(F.col("user_status") != V.NOT_SPECIFIED)
    if start is not None:
        rows = rows.filter(F.col("month") >= _date(start))
    if end is not None:
        rows = rows.filter(F.col("month") <= _date(end))
    device = [normalise_device("requestSource", device_prefix).alias("device")] if by_device else []
    grouped = rows.groupBy("month", *device, "user_status",
                           F.col("loyalty_segment_1m").alias("loyalty_segment"))
    out = grouped.agg(F.sum("device_count").alias("users"), F.sum("pageview_count").alias("pageviews"))
    return out.select("month", F.lit(publication).alias("publication"),
                      *(["device"] if by_device else []),
                      "user_status", "loyalty_segment", "users", "pageviews")


def without_device(base: DataFrame) -> DataFrame:
    """O11 without devices from O11 by device."""
    keys = ["month", "publication", "user_status", "loyalty_segment"]
    return base.groupBy(*keys).agg(F.sum("users").alias("users"), F.sum("pageviews").alias("pageviews"))


def total_users(base: DataFrame, by_device: bool = False) -> DataFrame:
    """Users and page views per month, status, publication (, device)."""
    keys = ["month", "user_status", "publication"] + (["device"] if by_device else [])
    return base.groupBy(*keys).agg(F.sum("users").alias("total_users"),
                                   F.sum("pageviews").alias("total_pageviews"))


def loyalty_ratio(base: DataFrame, by_device: bool = False, method: str = "window",
                  denominator_by_device: bool = False) -> DataFrame:
    """Each segment's share of users and page views within its
    month, publication and status. With devices the numerator is per device
    but, as in the models, the denominator is not, so shares sum to 1 over
    devices x segments; ``denominator_by_device`` makes them sum to 1 within
    each device instead. ``base`` is O11's output, unique per key."""
    cells = base.withColumnRenamed("users", "total_users").withColumnRenamed("pageviews", "total_pageviews")
    within = ["month", "publication", "user_status"] + (["device"] if by_device and denominator_by_device else [])
    shared = share_of_total(cells, {"loyalty_ratio": "total_users",
                                    "loyalty_pageviews_ratio": "total_pageviews"}, within, method)
    return (shared.filter(F.col("total_users").isNotNull())
            .select("month", "user_status", *(["device"] if by_device else []),
                    "loyalty_segment", "publication", "loyalty_ratio", "loyalty_pageviews_ratio"))


def reach_ratio(manual: DataFrame, base: DataFrame) -> DataFrame:
    """Official reach / measured users per month and publication; months
    without measured users drop out. Never per device."""
    totals = base.groupBy("month", "publication").agg(F.sum("users").alias("total_users"))
    joined = manual.join(totals, ["month", "publication"], "inner").filter(F.col("total_users").isNotNull())
    return joined.select("month", "publication",
                         safe_div("rus_WEMF_and_foreign_traffic", "total_users").alias("rus_ratio"))


def ground_truth(base: DataFrame, reach: DataFrame, by_device: bool = False) -> DataFrame:
    """Users x reach ratio per base row; rows without a ratio drop out."""
    joined = base.join(reach, ["month", "publication"], "inner").filter(F.col("rus_ratio").isNotNull())
    return joined.select(*_keys(by_device), "user_status", "loyalty_segment",
                         (F.col("users") * F.col("rus_ratio")).alias("customers"))


def subscriber_mix(manual: DataFrame) -> DataFrame:
    """Monthly and yearly shares of all subscribers per month."""
    total = F.col("monthly_subscribers") + F.col("yearly_subscribers")
    return manual.select("month", "publication", "monthly_subscribers", "yearly_subscribers",
                         safe_div(F.col("monthly_subscribers"), total).alias("monthly_subscribers_ratio"),
                         safe_div(F.col("yearly_subscribers"), total).alias("yearly_subscribers_ratio"))


def status_sums(base: DataFrame, by_device: bool = False) -> DataFrame:
    """Per segment (and device): rows and users of notSubscribed and of
    subscribed, and users of both together, in one conditional aggregation
    shared by both status shares."""
    keys = _keys(by_device, "loyalty_segment")
    pool = base.filter(F.col("user_status").isin(V.SUBSCRIBED, V.NOT_SUBSCRIBED))
    parts = []
    for status in (V.NOT_SUBSCRIBED, V.SUBSCRIBED):
        is_status = F.col("user_status") == status
        parts += [F.count(F.when(is_status, 1)).alias(f"_rows_{status}"),
                  F.sum(F.when(is_status, F.col("users"))).alias(f"_num_{status}")]
    return pool.groupBy(*keys).agg(*parts, F.sum("users").alias("_den"))


def status_share(base: DataFrame, status: str, out: str, by_device: bool = False) -> DataFrame:
    """Users of ``status`` / users of subscribed + notSubscribed per
    segment (and device). A row exists only where ``status`` has rows; NULL
    keys give a NULL share (as a join would)."""
    keys = _keys(by_device, "loyalty_segment")
    sums = status_sums(base, by_device)
    return (sums.filter(F.col(f"_rows_{status}") > 0)
            .select(*keys, F.when(all_not_null(keys), safe_div(f"_num_{status}", "_den")).alias(out)))


def logged_in_ratio(base: DataFrame, by_device: bool = False) -> DataFrame:
    return status_share(base, V.NOT_SUBSCRIBED, "logged_in_ratio", by_device)


def subscribed_ratio(base: DataFrame, by_device: bool = False) -> DataFrame:
    return status_share(base, V.SUBSCRIBED, "subscribed_ratio", by_device)


def _consent(manual: DataFrame) -> DataFrame:
    return manual.select("month", "publication", "consent_rate", "no_consent_rate")


def ratios_by_status(ratios: DataFrame, by_device: bool = False) -> DataFrame:
    """The loyalty ratio table with one column per status, so every branch
    joins the same small table. The ratio table is unique per key and status
    (O12/O13), so each cell holds at most one value."""
    keys = _keys(by_device, "loyalty_segment")
    return ratios.groupBy(*keys).agg(*[
        F.max(F.when(F.col("user_status") == s, F.col("loyalty_ratio"))).alias(f"_ratio_{s}")
        for s in (V.NOT_LOGGED_IN, V.NOT_SUBSCRIBED, V.SUBSCRIBED)])


def _ratio_of(ratios: DataFrame, status: str, by_device: bool) -> DataFrame:
    keys = _keys(by_device, "loyalty_segment")
    return ratios_by_status(ratios, by_device).select(*keys, F.col(f"_ratio_{status}").alias("loyalty_ratio"))


def no_consent_customers(gt: DataFrame, manual: DataFrame, mode: str,
                         ratios: DataFrame | None = None, by_device: bool = False) -> DataFrame:
    """Customers without consent per segment (and device).

    ``all``: every status x no-consent rate (earliest model);
    ``ratio``: notLoggedIn x no-consent rate x its loyalty ratio;
    ``plain``: notLoggedIn x no-consent rate (device model; the loyalty table
    it joins is unique per key and contributes no factor, so it is not joined).
    """
    rows = gt if mode == "all" else gt.filter(F.col("user_status") == V.NOT_LOGGED_IN)
    rows = rows.join(_consent(manual), ["month", "publication"], "left")
    value = F.col("customers") * F.col("no_consent_rate")
    if mode == "ratio":
        rows = rows.join(_ratio_of(ratios, V.NOT_LOGGED_IN, by_device),
                         _keys(by_device, "loyalty_segment"), "left")
        value = value * F.col("loyalty_ratio")
    elif mode not in ("all", "plain"):
        raise ValueError(f"unknown mode {mode}")
    out = rows.groupBy(*_keys(by_device, "loyalty_segment")).agg(F.sum(value).alias("customers"))
    return out.select(*_keys(by_device, "loyalty_segment"),
                      F.lit(V.NO_CONSENT).alias("login_state"), "customers")


def logged_in_customers(li_ratio: DataFrame, ratios: DataFrame, manual: DataFrame,
                        by_device: bool = False) -> DataFrame:
    """One-login customers x loyalty ratio(notSubscribed) x logged-in ratio."""
    keys = _keys(by_device, "loyalty_segment")
    rows = (li_ratio.join(_ratio_of(ratios, V.NOT_SUBSCRIBED, by_device), keys, "left")
            .join(manual.select("month", "publication", "one_log_not_subscribed"),
                  ["month", "publication"], "left"))
    value = F.col("one_log_not_subscribed") * F.col("loyalty_ratio") * F.col("logged_in_ratio")
    return rows.select(*keys, F.lit(V.LOGGED_IN).alias("login_state"), value.alias("customers"))


def subscription_customers(sub_ratio: DataFrame, ratios: DataFrame, manual: DataFrame,
                           by_device: bool = False) -> DataFrame:
    """One-login customers x loyalty ratio(subscribed) x subscribed
    ratio x monthly (yearly) share: one join pass emitting both states."""
    keys = _keys(by_device, "loyalty_segment")
    total = F.col("monthly_subscribers") + F.col("yearly_subscribers")
    mix = manual.select("month", "publication", "one_log_not_subscribed",
                        safe_div(F.col("monthly_subscribers"), total).alias("monthly_subscribers_ratio"),
                        safe_div(F.col("yearly_subscribers"), total).alias("yearly_subscribers_ratio"))
    rows = (sub_ratio.join(_ratio_of(ratios, V.SUBSCRIBED, by_device), keys, "left")
            .join(mix, ["month", "publication"], "left"))
    common = F.col("one_log_not_subscribed") * F.col("loyalty_ratio") * F.col("subscribed_ratio")
    both = F.array(
        F.struct(F.lit(V.MONTHLY).alias("login_state"),
                 (common * F.col("monthly_subscribers_ratio")).alias("customers")),
        F.struct(F.lit(V.YEARLY).alias("login_state"),
                 (common * F.col("yearly_subscribers_ratio")).alias("customers")))
    return rows.select(*keys, F.inline(both))


def assemble_customers(known: list[DataFrame], gt: DataFrame, by_device: bool = False,
                       clamp: bool = False) -> DataFrame:
    """The known states plus Consent Only = ground truth - known,
    per segment (and device). NULL where no known state exists (or a key is
    NULL, which a join never matches); with ``clamp`` anything not above 0
    (NULL included) becomes 0.

    The ground-truth totals are stacked under the known rows and the known
    sum is a window over each cell, so the known branches run once instead
    of once for the rows and once more for their totals."""
    cell = _keys(by_device, "loyalty_segment")
    stacked = known[0]
    for part in known[1:]:
        stacked = stacked.unionByName(part)
    truth = gt.groupBy(*cell).agg(F.sum("customers").alias("customers"))
    stacked = stacked.withColumn("_truth", F.lit(False)).unionByName(
        truth.select(*cell, F.lit(V.CONSENT_ONLY).alias("login_state"), "customers",
                     F.lit(True).alias("_truth")))
    known_sum = F.sum(F.when(~F.col("_truth"), F.col("customers"))).over(Window.partitionBy(*cell))
    rest = F.when(all_not_null(cell), F.col("customers") - known_sum)
    if clamp:
        rest = F.when(rest > 0, rest).otherwise(F.lit(0.0))
    return stacked.select(*cell, "login_state",
                          F.when(F.col("_truth"), rest).otherwise(F.col("customers")).alias("customers"))


def customers_wide(base: DataFrame, manual: DataFrame, by_device: bool = False) -> DataFrame:
    """K3/K4 from one aggregate of the base pivoted by status, and month totals
    (one window; joined partial sums by device).

    Every part of the customer model is a per-cell (month, publication,
    (device), segment) quantity: the loyalty ratio of each status (its users
    over all users of that status in the month, across devices), the
    logged-in and subscribed shares, the no-consent, logged-in and
    subscriber customers and the ground-truth total. So one pass over the
    base gives every state of a cell in one row, and the Consent Only
    residual is taken in the same row; no self-join, union or second
    aggregate. Rows exist exactly where the models' joins produce them, and
    a NULL key matches nothing, as in a join. ``base`` is O11's output,
    unique per key; the ratio table is the one O12/O13 would give.
    """
    cell = _keys(by_device, "loyalty_segment")
    consent = manual.select("month", "publication", "rus_WEMF_and_foreign_traffic", "no_consent_rate",
                            "one_log_not_subscribed", "monthly_subscribers", "yearly_subscribers")
    reach = reach_ratio(manual, base)
    rows = base.join(reach, ["month", "publication"], "left").withColumn(
        "customers", F.col("users") * F.col("rus_ratio"))
    status = F.col("user_status")
    has_reach = F.col("rus_ratio").isNotNull()
    parts = [F.count(F.when(has_reach, 1)).alias("_gt_rows"),
             F.sum(F.when(has_reach, F.col("customers"))).alias("_truth"),
             F.sum(F.when(status.isin(V.SUBSCRIBED, V.NOT_SUBSCRIBED), F.col("users"))).alias("_pool")]
    for s_ in (V.NOT_LOGGED_IN, V.NOT_SUBSCRIBED, V.SUBSCRIBED):
        parts += [F.count(F.when(status == s_, 1)).alias(f"_n_{s_}"),
                  F.sum(F.when(status == s_, F.col("users"))).alias(f"_u_{s_}")]
    parts += [F.count(F.when((status == V.NOT_LOGGED_IN) & has_reach, 1)).alias("_gt_nli_rows"),
              F.sum(F.when((status == V.NOT_LOGGED_IN) & has_reach, F.col("customers"))).alias("_c_nli")]
    wide = rows.groupBy(*cell).agg(*parts)
    keyed = all_not_null(cell)
    statuses = (V.NOT_LOGGED_IN, V.NOT_SUBSCRIBED, V.SUBSCRIBED)
    if by_device:  # a month may have any number of devices: partial sums, joined back
        totals = base.groupBy("month", "publication").agg(*[
            F.sum(F.when(status == s_, F.col("users"))).alias(f"_m_{s_}") for s_ in statuses])
        wide = wide.join(totals, ["month", "publication"], "left")
        month_total = {s_: F.col(f"_m_{s_}") for s_ in statuses}
    else:
        month = Window.partitionBy("month", "publication")
        month_total = {s_: F.sum(f"_u_{s_}").over(month) for s_ in statuses}
    ratio = {s_: F.when(keyed, safe_div(F.col(f"_u_{s_}"), month_total[s_])) for s_ in statuses}
    wide = wide.select("*", *[r.alias(f"_lr_{s_}") for s_, r in ratio.items()]).join(
        consent, ["month", "publication"], "left")
    total = F.col("monthly_subscribers") + F.col("yearly_subscribers")
    onelog = F.col("one_log_not_subscribed")
    li_share = F.when(keyed, safe_div(f"_u_{V.NOT_SUBSCRIBED}", "_pool"))
    sub_share = F.when(keyed, safe_div(f"_u_{V.SUBSCRIBED}", "_pool"))
    nc = F.col("_c_nli") * F.col("no_consent_rate")
    if not by_device:
        nc = nc * F.col(f"_lr_{V.NOT_LOGGED_IN}")
    common = onelog * F.col(f"_lr_{V.SUBSCRIBED}") * sub_share
    known = [  # (state, exists, value)
        (V.NO_CONSENT, F.col("_gt_nli_rows") > 0, nc),
        (V.LOGGED_IN, F.col(f"_n_{V.NOT_SUBSCRIBED}") > 0, onelog * F.col(f"_lr_{V.NOT_SUBSCRIBED}") * li_share),
        (V.MONTHLY, F.col(f"_n_{V.SUBSCRIBED}") > 0, common * safe_div(F.col("monthly_subscribers"), total)),
        (V.YEARLY, F.col(f"_n_{V.SUBSCRIBED}") > 0, common * safe_div(F.col("yearly_subscribers"), total)),
    ]
    wide = wide.select(*cell, "_gt_rows", "_truth",
                       *[e.alias(f"_e{i}") for i, (_, e, _) in enumerate(known)],
                       *[v.alias(f"_v{i}") for i, (_, _, v) in enumerate(known)])
    present = [F.col(f"_e{i}") & F.col(f"_v{i}").isNotNull() for i in range(len(known))]
    any_known = present[0]
    for p_ in present[1:]:
        any_known = any_known | p_
    known_sum = None
    for i, p_ in enumerate(present):
        term = F.when(p_, F.col(f"_v{i}")).otherwise(F.lit(0.0))
        known_sum = term if known_sum is None else known_sum + term
    rest = F.when(keyed & any_known, F.col("_truth") - known_sum)
    if by_device:
        rest = F.when(rest > 0, rest).otherwise(F.lit(0.0))
    states = [F.struct(F.lit(name).alias("login_state"), F.col(f"_e{i}").alias("_keep"),
                       F.col(f"_v{i}").alias("customers")) for i, (name, _, _) in enumerate(known)]
    states.append(F.struct(F.lit(V.CONSENT_ONLY).alias("login_state"), (F.col("_gt_rows") > 0).alias("_keep"),
                           rest.alias("customers")))
    return (wide.select(*cell, F.inline(F.array(*states)))
            .filter(F.col("_keep")).select(*cell, "login_state", "customers"))


def customers(base: DataFrame, manual: DataFrame, ratios: DataFrame,
              by_device: bool = False) -> DataFrame:
    """K3 (``by_device=False``) or K4 (``by_device=True``, clamped residual)
    from O11's output ``base`` and the matching loyalty ratios, branch by
    branch as the models write it (O19-O22). ``customers_wide`` gives the same
    rows in one aggregate and is what the chain uses."""
    reach = reach_ratio(manual, base)
    gt = ground_truth(base, reach, by_device)
    nc = no_consent_customers(gt, manual, "plain" if by_device else "ratio", ratios, by_device)
    li = logged_in_customers(logged_in_ratio(base, by_device), ratios, manual, by_device)
    subs = subscription_customers(subscribed_ratio(base, by_device), ratios, manual, by_device)
    return assemble_customers([nc, li, subs], gt, by_device, clamp=by_device)


def customers_by_cell(df: DataFrame, by_device: bool = False) -> DataFrame:
    """Customers summed per month, publication, (device), state, segment."""
    keys = _keys(by_device, "login_state", "loyalty_segment")
    return df.groupBy(*keys).agg(F.sum("customers").alias("customers"))
