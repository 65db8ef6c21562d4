import datetime as dt

from pyspark.sql import functions as F

from audival.operators import customers as C
from audival.operators import rollup as R
from audival.operators.shares import share_of_total

M1 = dt.date(2025, 8, 1)


def base_rows(spark, rows, device=False):
    cols = "month date, publication string, " + ("device string, " if device else "") + \
        "user_status string, loyalty_segment string, users long, pageviews long"
    return spark.createDataFrame(rows, cols)


def test_user_metrics_base_filters(spark):
    df = spark.createDataFrame([
        (M1, "app_web", "subscribed", "Brand Lover", 2, 10),
        (M1, "app_web", "subscribed", "Brand Lover", 3, 5),
        (M1, "app_web", "notSpecified", "Brand Lover", 7, 7),
        (M1, "app_web", None, "Brand Lover", 7, 7),
        (dt.date(2025, 7, 1), "app_web", "subscribed", "Brand Lover", 9, 9),
    ], "month date, requestSource string, user_status string, loyalty_segment_1m string, "
       "device_count long, pageview_count long")
    out = C.user_metrics_base(df, "p", "2025-08-01", "2026-03-01", by_device=True, device_prefix="app_")
    assert [tuple(r) for r in out.collect()] == [(M1, "p", "web", "subscribed", "Brand Lover", 5, 15)]


def test_loyalty_ratio_sums_to_one_and_null_keys(spark):
    b = base_rows(spark, [
        (M1, "p", "subscribed", "Brand Lover", 1, 2), (M1, "p", "subscribed", "Casual Reader", 3, 2),
        (M1, "p", "notSubscribed", "Brand Lover", 0, 0), (None, "p", "subscribed", "Brand Lover", 5, 5),
    ])
    out = C.loyalty_ratio(b)
    sums = {r["user_status"]: r["s"] for r in
            out.filter(F.col("month").isNotNull()).groupBy("user_status").agg(F.sum("loyalty_ratio").alias("s")).collect()}
    assert sums["subscribed"] == 1.0
    assert sums["notSubscribed"] is None  # 0 / 0
    assert out.filter(F.col("month").isNull()).first()["loyalty_ratio"] is None  # a join never matches NULL


def test_device_ratio_denominator_has_no_device(spark):
    b = base_rows(spark, [(M1, "p", "web", "subscribed", "Brand Lover", 1, 1),
                          (M1, "p", "app", "subscribed", "Brand Lover", 3, 1)], device=True)
    out = {r["device"]: r["loyalty_ratio"] for r in C.loyalty_ratio(b, True).collect()}
    assert out == {"web": 0.25, "app": 0.75}


def test_status_share_rows_and_null_segment(spark):
    b = base_rows(spark, [
        (M1, "p", "subscribed", "Brand Lover", 1, 0), (M1, "p", "notSubscribed", "Brand Lover", 3, 0),
        (M1, "p", "subscribed", "Loyal Reader", 2, 0),
        (M1, "p", "notSubscribed", None, 2, 0),
    ])
    li = {r["loyalty_segment"]: r["logged_in_ratio"] for r in C.logged_in_ratio(b).collect()}
    assert li == {"Brand Lover": 0.75, None: None}  # no notSubscribed row for Loyal Reader
    sr = {r["loyalty_segment"]: r["subscribed_ratio"] for r in C.subscribed_ratio(b).collect()}
    assert sr == {"Brand Lover": 0.25, "Loyal Reader": 1.0}


def _known(spark, rows, device=False):
    cols = "month date, publication string, " + ("device string, " if device else "") + \
        "loyalty_segment string, login_state string, customers double"
    return spark.createDataFrame(rows, cols)


def test_residual_null_negative_and_clamp(spark):
    gt = spark.createDataFrame([
        (M1, "p", "notLoggedIn", "Brand Lover", 10.0), (M1, "p", "notLoggedIn", "Casual Reader", 4.0),
        (M1, "p", "notLoggedIn", "Loyal Reader", 1.0),
    ], "month date, publication string, user_status string, loyalty_segment string, customers double")
    known = _known(spark, [(M1, "p", "Brand Lover", "Logged-In", 3.0), (M1, "p", "Loyal Reader", "Logged-In", 5.0)])
    out = {r["loyalty_segment"]: r["customers"] for r in
           C.assemble_customers([known], gt).filter(F.col("login_state") == "Consent Only").collect()}
    assert out == {"Brand Lover": 7.0, "Casual Reader": None, "Loyal Reader": -4.0}
    gtd = gt.withColumn("device", F.lit("web"))
    knownd = known.withColumn("device", F.lit("web"))
    out = {r["loyalty_segment"]: r["customers"] for r in
           C.assemble_customers([knownd], gtd, by_device=True, clamp=True)
           .filter(F.col("login_state") == "Consent Only").collect()}
    assert out == {"Brand Lover": 7.0, "Casual Reader": 0.0, "Loyal Reader": 0.0}


def test_residual_balances_ground_truth(spark):
    gt = spark.createDataFrame([(M1, "p", "notLoggedIn", "Brand Lover", 10.0),
                                (M1, "p", "subscribed", "Brand Lover", 5.0)],
                               "month date, publication string, user_status string, loyalty_segment string, customers double")
    known = _known(spark, [(M1, "p", "Brand Lover", "Logged-In", 3.0), (M1, "p", "Brand Lover", "No Consent", 2.0)])
    total = C.assemble_customers([known], gt).agg(F.sum("customers")).first()[0]
    assert total == 15.0


def test_weights_sum_to_one_and_constant_value(spark):
    cust = _known(spark, [(M1, "p", "Brand Lover", "Logged-In", 3.0), (M1, "p", "Casual Reader", "Logged-In", 1.0),
                          (M1, "p", "Brand Lover", "No Consent", 2.0)])
    w = R.customer_weight(cust, "login_state")
    sums = {r["login_state"]: r["s"] for r in w.groupBy("login_state").agg(F.sum("weight").alias("s")).collect()}
    assert sums == {"Logged-In": 1.0, "No Consent": 1.0}
    values = cust.select("month", "publication", "login_state", "loyalty_segment",
                         F.lit("Advertising").alias("type"), F.lit(7.0).alias("weighted_value"))
    rolled = {r["login_state"]: r["weighted_value"] for r in R.weighted_rollup(values, w, "login_state").collect()}
    assert rolled == {"Logged-In": 7.0, "No Consent": 7.0}


def test_share_of_total_null_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 2.0)], "k string, v double")
    out = sorted((r["k"] or "", r["s"]) for r in share_of_total(df, {"s": "v"}, ["k"]).collect())
    assert out == [("", None), ("a", 0.25), ("a", 0.75)]


def test_share_methods_agree(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 3.0), (None, "x", 2.0), ("b", "x", 0.0)],
                               "k string, s string, v double")
    w = sorted(tuple(r) for r in share_of_total(df, {"r": "v"}, ["k"]).fillna("").collect())
    j = sorted(tuple(r) for r in share_of_total(df, {"r": "v"}, ["k"], "join").fillna("").collect())
    assert w == j


def test_device_ratio_denominator_option(spark):
    b = base_rows(spark, [(M1, "p", "web", "subscribed", "Brand Lover", 1, 1),
                          (M1, "p", "web", "subscribed", "Casual Reader", 1, 1),
                          (M1, "p", "app", "subscribed", "Brand Lover", 2, 1)], device=True)
    out = {(r["device"], r["loyalty_segment"]): r["loyalty_ratio"]
           for r in C.loyalty_ratio(b, True, denominator_by_device=True).collect()}
    assert out == {("web", "Brand Lover"): 0.5, ("web", "Casual Reader"): 0.5, ("app", "Brand Lover"): 1.0}


def test_lookup_key_check(spark):
    import pytest

    from audival.plans.checks import assert_unique, duplicate_keys
    df = spark.createDataFrame([(M1, "p", 0.5), (M1, "p", 0.6), (M1, "q", 0.7)],
                               "month date, publication string, consent_rate double")
    assert [tuple(r) for r in duplicate_keys(df, ["month", "publication"]).collect()] == [(M1, "p", 2)]
    with pytest.raises(ValueError):
        assert_unique(df, ["month", "publication"], "consent_rate")
    assert_unique(df, ["month", "publication", "consent_rate"], "consent_rate")


def test_wide_customers_equal_branch_form(spark):
    from collections import Counter
    M2, M3 = dt.date(2025, 9, 1), dt.date(2025, 10, 1)
    rows = [
        (M1, "p", "web", "notLoggedIn", "Brand Lover", 10, 1), (M1, "p", "web", "notSubscribed", "Brand Lover", 4, 1),
        (M1, "p", "web", "subscribed", "Brand Lover", 2, 1), (M1, "p", "app", "subscribed", "Casual Reader", 3, 1),
        (M1, "p", "app", "notLoggedIn", None, 5, 1), (M1, "p", "app", "notSubscribed", None, None, 1),
        (M1, "p", "web", "notSubscribed", "Loyal Reader", 0, 0), (M1, "p", "web", "subscribed", "Loyal Reader", 0, 0),
        (M2, "p", "web", "notLoggedIn", "Brand Lover", 7, 1), (M2, "p", "web", "subscribed", "Brand Lover", 1, 1),
        (M3, "p", "web", "notSubscribed", "Brand Lover", 6, 1),  # no manual figures for this month
    ]
    manual = spark.createDataFrame([
        (M1, "p", 40.0, 3, 1, 0.7, 0.3, 11), (M2, "p", 20.0, 0, 0, 0.6, 0.4, 5), (M1, "q", 99.0, 1, 1, 0.5, 0.5, 1),
    ], "month date, publication string, rus_WEMF_and_foreign_traffic double, monthly_subscribers long, "
       "yearly_subscribers long, consent_rate double, no_consent_rate double, one_log_not_subscribed long")
    for device in (False, True):
        b = base_rows(spark, rows, device=True)
        if not device:
            b = b.groupBy("month", "publication", "user_status", "loyalty_segment").agg(
                F.sum("users").alias("users"), F.sum("pageviews").alias("pageviews"))
        branch = C.customers(b, manual, C.loyalty_ratio(b, device), device)
        wide = C.customers_wide(b, manual, device)
        cols = sorted(branch.columns)

        def bag(df):
            return Counter(tuple(None if v is None else (round(v, 9) if isinstance(v, float) else v) for v in r)
                           for r in df.select(*cols).collect())
        assert bag(branch) == bag(wide), device
