import datetime as dt

import pytest
from pyspark.sql import functions as F

from audival.operators import report as RP
from audival.plans.daily import DailyRollup
from audival.plans.queries import USER_DIMENSIONS, WEB_METRICS

JANUARY = ("2024-01-01", "2024-01-31")
SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
KINDS = ["signup", "view", "purchase", None]


def events(spark, shift=0):
    """Users that come back, events without a user, kinds that are null."""
    rows = [(i, dt.datetime(2024, 1, 1 + (i + shift) % 20, i % 24), i % 7 if i % 3 else None, KINDS[i % 4], float(i % 90),
             None if i % 11 == 0 else f'{{"k": {i % 100}}}') for i in range(400)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def rollup(spark, path, **more):
    return DailyRollup(spark, path, ["eventName", *USER_DIMENSIONS, "pagePath"], 4, **more)


@pytest.mark.parametrize("dims", [[], ["date"], ["eventName"], ["pagePath", "date"], USER_DIMENSIONS])
def test_reports_equal_those_over_the_events(spark, scratch, dims):
    rows, daily = events(spark), rollup(spark, scratch)
    daily.refresh(rows, *JANUARY)
    for days in (JANUARY, ("2024-01-03", "2024-01-09"), ("2024-01-25", "2024-01-30")):
        assert rows_of(daily.report(dims, WEB_METRICS, *days)) == rows_of(RP.run_report(rows, dims, WEB_METRICS, *days))


@pytest.mark.parametrize("text", ['eventName contains "IG"', "customUser:user_status exact notloggedin",
                                  'pagePath begins_with "/fr"', 'eventName ends_with "nothing"', "date contains 2024-01-0"])
@pytest.mark.parametrize("most", [0, 1000])
def test_filters_equal_those_over_the_events(spark, scratch, text, most):
    rows, daily = events(spark), rollup(spark, scratch, most_values=most)
    daily.refresh(rows, *JANUARY)
    for exact_case in (False, True):
        got = daily.report(["eventName", "date"], WEB_METRICS, *JANUARY, text, exact_case)
        assert rows_of(got) == rows_of(RP.run_report(rows, ["eventName", "date"], WEB_METRICS, *JANUARY, text, exact_case))


def test_a_refresh_replaces_its_days_and_no_others(spark, scratch):
    old, new, daily = events(spark), events(spark, shift=3), rollup(spark, scratch)
    daily.refresh(old, *JANUARY)
    gone = F.to_date("ts") != F.lit("2024-01-06").cast("date")
    daily.refresh(new.filter(gone), "2024-01-05", "2024-01-07")  # a day has lost all its rows
    inside = F.to_date("ts").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-07").cast("date"))
    both = old.filter(~inside).unionByName(new.filter(inside & gone))
    assert rows_of(daily.report(["date"], WEB_METRICS, *JANUARY)) == rows_of(
        RP.run_report(both, ["date"], WEB_METRICS, *JANUARY))


def test_a_failed_run_is_not_read_and_is_expired(spark, scratch):
    rows, daily = events(spark), rollup(spark, scratch)
    daily.refresh(rows, *JANUARY)
    before = rows_of(daily.report(["date"], WEB_METRICS, *JANUARY))
    broken = rows.withColumn("user_id", F.when(F.col("event_id") == 399, F.raise_error(F.lit("bad"))).otherwise(F.col("user_id")))
    with pytest.raises(Exception, match="bad"):
        daily.refresh(broken, *JANUARY)
    assert rows_of(daily.report(["date"], WEB_METRICS, *JANUARY)) == before
    daily.refresh(rows, *JANUARY)
    assert daily.expire() >= 1  # the first run; the failed one if it left a folder
    assert rows_of(daily.report(["date"], WEB_METRICS, *JANUARY)) == before


def test_another_session_object_reads_what_was_written(spark, scratch):
    rows, writer = events(spark), rollup(spark, scratch)
    writer.refresh(rows, *JANUARY)
    reader = rollup(spark, scratch)
    assert rows_of(reader.report([], WEB_METRICS, *JANUARY)) == rows_of(RP.run_report(rows, [], WEB_METRICS, *JANUARY))
    writer.refresh(events(spark, 1), "2024-01-02", "2024-01-02")
    assert rows_of(reader.report(["date"], WEB_METRICS, *JANUARY)) == rows_of(writer.report(["date"], WEB_METRICS, *JANUARY))


def test_days_without_a_run_and_unknown_fields_are_errors(spark, scratch):
    daily = rollup(spark, scratch)
    daily.refresh(events(spark), "2024-01-01", "2024-01-10")
    with pytest.raises(ValueError, match="not all days"):
        daily.report([], WEB_METRICS, "2024-01-05", "2024-01-11")
    with pytest.raises(KeyError):
        daily.report(["city"], WEB_METRICS, "2024-01-05", "2024-01-10")


def test_an_empty_table_gives_an_empty_report(spark, scratch):
    daily = rollup(spark, scratch)
    daily.refresh(events(spark).limit(0), *JANUARY)
    assert daily.report(["date"], WEB_METRICS, *JANUARY).count() == 0
    assert tuple(daily.report([], WEB_METRICS, *JANUARY).first()) == (0, 0, 0, 0, 0)


def test_one_exchange_and_none_on_users(spark, scratch):
    daily = rollup(spark, scratch)
    daily.refresh(events(spark), *JANUARY)
    plan = daily.report(["eventName"], WEB_METRICS, *JANUARY, 'eventName contains "VI"')._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan =="):]
    assert physical.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(_user" not in physical
    assert "Bucketed: true" in physical and "SelectedBucketsCount" in physical
    assert "(eventName,view)" in physical.replace(" ", "") or "In(eventName" in physical  # at the scan


def test_a_listed_filter_reaches_the_scan(spark, scratch):
    events(spark).write.parquet(f"{scratch}/events")
    rows = spark.read.parquet(f"{scratch}/events")
    args = (["date", "eventName"], WEB_METRICS, *JANUARY, 'eventName contains "I"')
    listed = RP.run_report(rows, *args, sources=RP.EVENT_SOURCES)
    plan = listed._jdf.queryExecution().toString()
    pushed = [ln for ln in plan.splitlines() if "PushedFilters" in ln]
    assert any("In(event_" in ln for ln in pushed), pushed  # the plan text is cut there
    assert rows_of(listed) == rows_of(RP.run_report(rows, *args))
