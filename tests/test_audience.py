import datetime as dt

from pyspark.sql import functions as F

from audival.operators import audience as A
from audival.operators import value as VL

M1 = dt.date(2025, 8, 1)


def states(spark):
    return spark.createDataFrame([
        (M1, "p", "Consent Only", 30, 10, 300), (M1, "p", "Logged-In", 10, 5, 100),
    ], "month date, publication string, login_state string, users long, new_users long, pageviews long")


def test_no_consent_modes_and_zero_rate(spark):
    consent = spark.createDataFrame([(M1, "p", 0.8)], "month date, publication string, consent_rate double")
    share = {r["login_state"]: r["users"] for r in A.add_no_consent(states(spark), consent, "share").collect()}
    assert share["No Consent"] == 40 * (1 - 0.8) and share["Consent Only"] == 30.0
    extra = {r["login_state"]: r["users"] for r in A.add_no_consent(states(spark), consent, "extrapolate").collect()}
    assert extra["No Consent"] == 40 * (1 / 0.8 - 1)
    zero = spark.createDataFrame([(M1, "p", 0.0)], "month date, publication string, consent_rate double")
    out = {r["login_state"]: r["users"] for r in A.add_no_consent(states(spark), zero, "extrapolate").collect()}
    assert out["No Consent"] is None


def test_split_lifetime_identity_and_unmatched(spark):
    ratios = spark.createDataFrame([
        (M1, "notLoggedIn", "Brand Lover", "p", 0.25, 0.5), (M1, "notLoggedIn", "Casual Reader", "p", 0.75, 0.5),
    ], "month date, user_status string, loyalty_segment string, publication string, loyalty_ratio double, "
       "loyalty_pageviews_ratio double")
    split = A.loyalty_split(states(spark), ratios)
    cells = A.audience_lifetime(split)
    co = cells.filter(F.col("login_state") == "Consent Only").collect()
    assert {r["lifetime"] for r in co} == {3.0}  # = 30 / 10 before the split
    li = cells.filter(F.col("login_state") == "Logged-In").collect()
    assert len(li) == 1 and li[0]["loyalty_segment"] is None and li[0]["users"] is None


def test_views_per_user_rules(spark):
    df = spark.createDataFrame([
        ("No Consent", "Casual Reader", 60.0, 10.0, 5.0), ("Consent Only", "Returning Reader", 60.0, 10.0, 5.0),
        ("Logged-In", "Loyal Reader", 60.0, 10.0, 0.0), ("Logged-In", "Loyal Reader", 60.0, 10.0, None),
    ], "login_state string, loyalty_segment string, pageviews double, users double, customers double")
    got = [tuple(r) for r in df.select(VL.views_per_user("override"), VL.views_per_user("guard")).collect()]
    assert got == [(36.0, 12.0), (6.0, 12.0), (None, 0.0), (None, None)]


def test_subscription_value_yearly_and_missing_arpu(spark):
    life = spark.createDataFrame([(M1, "p", "Yearly Subscription", "Brand Lover", 12.0),
                                  (M1, "p", "Monthly Subscription", "Brand Lover", 6.0)],
                                 "month date, publication string, login_state string, loyalty_segment string, "
                                 "average_lifetime double")
    arpu = spark.createDataFrame([(M1, "p", "Yearly Subscription", "Brand Lover", 24.0)],
                                 "month date, publication string, login_state string, loyalty_segment string, arpu double")
    out = {r["login_state"]: r["weighted_value"] for r in VL.subscription_value(life, arpu).collect()}
    assert out == {"Yearly Subscription": 24.0, "Monthly Subscription": None}
