import datetime as dt

import pytest
from pyspark.sql import functions as F

from audival.functions.columns import (
    classify_login_state, consent_status, month_from_dash, month_from_yearmonth, normalise_device,
    safe_div, user_status_of,
)


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("status,product,expected", [
    ("(not set)", None, "Consent Only"),
    ("notLoggedIn", "x", "Consent Only"),
    ("NotSpecified", None, "Consent Only"),
    ("notSubscribed", None, "Logged-In"),
    ("Subscribed", "Monatsabo", "Monthly Subscription"),
    ("subscribed", "PRINT + digital", "Monthly Subscription"),
    ("subscribed", "Jahresabo", "Yearly Subscription"),
    ("subscribed", "yearly month bundle", "Monthly Subscription"),  # monthly wins over yearly
    ("subscribed", "Gift", "Other"),
    ("subscribed", None, "Other"),
    (None, "Monatsabo", "Other"),
    ("unknown", "Monatsabo", "Other"),
])
def test_classify_login_state(spark, status, product, expected):
    df = spark.createDataFrame([(status, product)], "s string, p string")
    assert rows(df.select(classify_login_state("s", "p"))) == [(expected,)]


def test_user_status_and_consent(spark):
    states = ["Consent Only", "No Consent", "Logged-In", "Monthly Subscription", "Yearly Subscription",
              "Other", None]
    df = spark.createDataFrame([(s,) for s in states], "ls string")
    got = rows(df.select(user_status_of("ls"), consent_status("ls")))
    assert got == [("notLoggedIn", "Consent"), ("notLoggedIn", "No Consent"), ("notSubscribed", "Consent"),
                   ("subscribed", "Consent"), ("subscribed", "Consent"), (None, "Consent"), (None, "Consent")]


def test_months_and_device(spark):
    df = spark.createDataFrame([("202508", "2025-08", "app_desktop_app_x"), ("202603", "2026-03", None)],
                               "ym string, d string, src string")
    got = rows(df.select(month_from_yearmonth("ym"), month_from_dash("d"), normalise_device("src", "app_")))
    assert got == [(dt.date(2025, 8, 1), dt.date(2025, 8, 1), "desktop_x"),
                   (dt.date(2026, 3, 1), dt.date(2026, 3, 1), None)]


def test_safe_div(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (3, 2)], "a long, b long")
    assert rows(df.select(safe_div("a", "b"))) == [(None,), (None,), (1.5,)]
    assert rows(df.select(safe_div(F.col("a") * 1.0, F.lit(0.0)))) == [(None,)] * 3
