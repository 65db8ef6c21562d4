"""Column rules against tables written by hand, and properties over generated
inputs (one DataFrame per batch)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from audival.functions.columns import classify_login_state
from audival.functions.typed import parse_typed_value

STATUSES = ["(not set)", "notLoggedIn", "NOTLOGGEDIN", "notSpecified", "notSubscribed", "Subscribed",
            "subscribed", "other", "", None]
WORDS = ["Monat", "month", "PRINT", "Jahr", "yearly", "gift", "abo", " ", "", None]


#: Login state by status and product, written out by hand.
EXPECTED = [
    ("(not set)", None, "Consent Only"), ("notLoggedIn", "Monat", "Consent Only"), ("NOTLOGGEDIN", "", "Consent Only"),
    ("notSpecified", "yearly", "Consent Only"), ("notSubscribed", "Jahr", "Logged-In"), ("NotSubscribed", None, "Logged-In"),
    ("subscribed", "Monatsabo", "Monthly Subscription"), ("Subscribed", "1 MONTH", "Monthly Subscription"),
    ("subscribed", "Print + Jahr", "Monthly Subscription"), ("subscribed", "Jahresabo", "Yearly Subscription"),
    ("SUBSCRIBED", "Yearly pass", "Yearly Subscription"), ("subscribed", "Gift", "Other"), ("subscribed", None, "Other"),
    ("", "month", "Other"), ("other", "yearly", "Other"), (None, "month", "Other"), (None, None, "Other")]


def test_classify_table(spark):
    df = spark.createDataFrame([c[:2] for c in EXPECTED], "s string, p string")
    assert [r[0] for r in df.select(classify_login_state("s", "p")).collect()] == [c[2] for c in EXPECTED]


products = st.one_of(st.none(), st.lists(st.sampled_from([w for w in WORDS if w is not None]),
                                         max_size=3).map("".join))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(STATUSES), products), min_size=1, max_size=60))
def test_classify_ignores_case_and_non_subscribers_products(spark, cases):
    def states(rows):
        return [r[0] for r in spark.createDataFrame(rows, "s string, p string").select(
            classify_login_state("s", "p")).collect()]
    got = states(cases)
    assert got == states([(s and s.upper(), p and p.upper()) for s, p in cases])
    without = states([(s, None) for s, _ in cases])
    assert all(a == b for (s, _), a, b in zip(cases, got, without) if (s or "").lower() != "subscribed")


#: Typed texts and what they hold, written out by hand.
TYPED = [("int_value: 5", "5"), ("  int_value:5 ", "5"), ("double_value: 1.5: more", "1.5"), ("other: a b ", "a b"),
         ("string_value: x", "x"), ('string_value: "x"', "x"), ('STRING_VALUE:\t"a:b"', "a:b"), ('string_value: ""', ""),
         ("string_value: a:b", "a:b"), ('string_value: "a', '"a'), ('string_value: a"', 'a"'), ("string_value:", ""),
         ("int_value:", ""), (":", ""), (None, None)]


def test_typed_table(spark):
    df = spark.createDataFrame([(t,) for t, _ in TYPED], "v string")
    assert [r[0] for r in df.select(parse_typed_value("v")).collect()] == [v for _, v in TYPED]


values = st.text(alphabet=st.sampled_from(list('ab:" \t5x')), max_size=8)
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(values, min_size=1, max_size=60))
def test_quoted_text_round_trip(spark, texts):
    """What is put in quotes comes back as it was, white space around it or not."""
    df = spark.createDataFrame([(f' string_value: "{t}"\t',) for t in texts], "v string")
    assert [r[0] for r in df.select(parse_typed_value("v")).collect()] == texts


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2090, 12, 31)), min_size=1, max_size=30))
def test_typed_date_round_trip(spark, days):
    df = spark.createDataFrame([(f" int_value: {d:%Y%m%d} ",) for d in days], "v string")
    assert [r[0] for r in df.select(parse_typed_value("v", is_date=True)).collect()] == days
