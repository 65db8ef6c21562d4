import datetime as dt
import glob
import gzip
import os

import pytest
from pyspark.sql import functions as F

from audival.functions.filters import parse_filter
from audival.functions.typed import parse_typed_value
from audival.operators import report as RP
from audival.plans.queries import AD_DEFINITION, AD_KINDS
from audival.plans.sinks import write_report_csv
from audival.sources.adserver import landed_rows

from paths import SMALL


def events(spark):
    return spark.createDataFrame([
        (1, dt.datetime(2024, 1, 1, 10), 7, "signup", 0.0, '{"k": 1}'),
        (2, dt.datetime(2024, 1, 1, 11), 7, "view", 0.0, '{"k": 50}'),
        (3, dt.datetime(2024, 1, 2, 11), 7, "view", 0.0, '{"k": 50}'),
        (4, dt.datetime(2024, 1, 2, 12), 8, "purchase", 9.5, '{"k": 90}'),
        (5, dt.datetime(2024, 2, 1, 12), 8, "view", 1.0, None),
    ], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")


def test_parse_filter():
    assert parse_filter('pagePath contains "/fr/"') == ("pagePath", "contains", "/fr/")
    assert parse_filter("eventName EXACT view") == ("eventName", "exact", "view")
    assert parse_filter('a begins_with "x y"') == ("a", "begins_with", "x y")
    with pytest.raises(ValueError):
        parse_filter("eventName contains")
    with pytest.raises(ValueError):
        parse_filter("eventName like view")


def test_report_metrics_and_range(spark):
    out = RP.run_report(events(spark), [], RP.EVENT_METRICS.keys(), "2024-01-01", "2024-01-31")
    r = out.first()
    assert (r["totalUsers"], r["newUsers"], r["sessions"], r["screenPageViews"], r["eventCount"]) == (2, 1, 3, 2, 4)
    assert out.columns == list(RP.EVENT_METRICS)


def test_report_filter_case_insensitive(spark):
    out = RP.run_report(events(spark), ["eventName"], ["eventCount"], "2024-01-01", "2024-01-31",
                        'eventName begins_with "VI"')
    assert [tuple(r) for r in out.collect()] == [("view", 2)]
    none = RP.run_report(events(spark), ["eventName"], ["eventCount"], "2024-01-01", "2024-01-31",
                         'eventName begins_with "VI"', case_sensitive=True)
    assert none.count() == 0
    with pytest.raises(KeyError):
        RP.run_report(events(spark), ["nope"], ["eventCount"], "2024-01-01", "2024-01-31")


def test_typed_values(spark):
    df = spark.createDataFrame([('  string_value: "a:b"  ',), ("int_value: 5",), ("double_value: 1.5: extra",),
                                ("string_value: x",), ('string_value: ""',)], "v string")
    got = [r[0] for r in df.select(parse_typed_value("v")).collect()]
    assert got == ["a:b", "5", "1.5", "x", ""]
    d = spark.createDataFrame([("int_value: 20240131",)], "v string")
    assert d.select(parse_typed_value("v", is_date=True)).first()[0] == dt.date(2024, 1, 31)


def test_report_from_definition(spark):
    out = RP.report_from_definition(landed_rows(events(spark)), AD_DEFINITION, "2024-01-01", "2024-01-31")
    assert out.columns == AD_DEFINITION["dimensions"] + AD_DEFINITION["metrics"]
    totals = out.agg(F.sum("impressions"), F.sum("revenue_without_cpd")).first()
    assert tuple(totals) == (2, 9.5) and dict(out.dtypes)["impressions"] == "bigint"
    with pytest.raises(KeyError):
        RP.parse_landed(landed_rows(events(spark)), {"dimensions": ["missing"], "metrics": []})


def test_definition_names_case_insensitive(spark):
    spec = {"dimensions": ["DATE", "Device_Category"], "metrics": ["IMPRESSIONS"]}
    out = RP.report_from_definition(landed_rows(events(spark)), spec, "2024-01-01", "2024-01-31")
    assert out.columns == ["DATE", "Device_Category", "IMPRESSIONS"]
    assert out.agg(F.sum("IMPRESSIONS")).first()[0] == 2


def landed(spark, days, values, kind="int_value"):
    return spark.createDataFrame([(f"int_value: {d}", "string_value: x", f"{kind}: {v}") for d, v in zip(days, values)],
                                 "date string, unit string, impressions string")


SPEC = {"dimensions": ["unit"], "metrics": ["impressions"]}


def test_range_holds_without_a_date_dimension(spark):
    rows = landed(spark, ["20240101", "20240105", "20240201"], [1, 2, 4])
    assert RP.report_from_definition(rows, SPEC, "2024-01-01", "2024-01-31").first()["impressions"] == 3
    assert RP.report_from_definition(rows, SPEC, "2030-01-01", "2030-01-31").count() == 0
    with pytest.raises(KeyError):
        RP.report_from_definition(rows.drop("date"), SPEC, "2024-01-01", "2024-01-31")


def test_whole_numbers_stay_exact_in_the_csv(spark, scratch):
    rows = landed(spark, ["20240101", "20240102"], [12345678, 9007199254740993]).withColumn(
        "unit", F.concat(F.lit("string_value: "), "date"))
    path = os.path.join(scratch, "whole")
    write_report_csv(RP.report_from_definition(rows, SPEC, "2024-01-01", "2024-01-31"), path, gzip=True)
    numbers = {ln.split(",")[1] for ln in _csv_lines(path, gzip.open)} - {"impressions"}
    assert numbers == {"12345678", "9007199254740993"}
    mixed = landed(spark, ["20240101"], ["1.5"], "double_value").unionByName(landed(spark, ["20240101"], [2]))
    assert RP.report_from_definition(mixed, SPEC, "2024-01-01", "2024-01-31").first()["impressions"] == 3.5


@pytest.mark.parametrize("column", ["date", "unit", "impressions"])
def test_value_without_a_colon_is_an_error(spark, column):
    rows = landed(spark, ["20240101"], [1]).withColumn(column, F.lit("20240101"))
    with pytest.raises(Exception, match="no ':'"):
        RP.report_from_definition(rows, SPEC | {"dimensions": ["date", "unit"]}, "2024-01-01", "2024-01-31",
                                  {"impressions": "int_value"}).collect()


def test_day_filter_reaches_a_partitioned_table(spark, scratch):
    path = os.path.join(scratch, "typed")
    RP.parse_landed(landed_rows(spark.read.parquet(f"{SMALL}/events.parquet")), AD_DEFINITION, AD_KINDS).write.partitionBy(
        "date").parquet(path)
    out = RP.report_from_table(spark.read.parquet(path), AD_DEFINITION, "2024-01-05", "2024-01-06")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2024-01-05" in plan
    assert {r["date"] for r in out.collect()} == {dt.date(2024, 1, 5), dt.date(2024, 1, 6)}


@pytest.mark.parametrize("text,kept", [('eventName contains "IE"', {2, 3}), ("eventName exact VIEW", {2, 3}),
                                       ("eventName begins_with sign", {1}), ("eventName ends_with up", {1}),
                                       ('pagePath contains "/it/"', {2, 3, 4})])
def test_every_filter_operator_on_rows(spark, text, kept):
    out = RP.run_report(events(spark), ["eventName"], ["eventCount"], "2024-01-01", "2024-01-31", text)
    names = {1: "signup", 2: "view", 3: "view", 4: "purchase"}
    want = {}
    for k in kept:
        want[names[k]] = want.get(names[k], 0) + 1
    assert {r[0]: r[1] for r in out.collect()} == want


def test_user_dimensions_and_no_expand(spark):
    dims = ["deviceCategory", "customUser:user_status", "customUser:product_name"]
    out = RP.run_report(events(spark), dims, list(RP.EVENT_METRICS), "2024-01-01", "2024-01-31")
    assert out.columns == dims + list(RP.EVENT_METRICS)
    assert {tuple(r) for r in out.collect()} == {
        ("desktop", "notSubscribed", "(not set)", 1, 1, 1, 0, 1), ("mobile", "notSubscribed", "(not set)", 1, 0, 2, 2, 2),
        ("tablet", "subscribed", "Monatsabo", 1, 0, 1, 0, 1)}
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()


def _csv_lines(path, opener=open):
    lines = []
    for f in sorted(glob.glob(os.path.join(path, "part-*"))):
        with opener(f, "rt") as fh:
            lines += fh.read().splitlines()
    return lines


def test_empty_report_keeps_header(spark, scratch):
    out = RP.run_report(events(spark), ["date", "eventName"], ["eventCount"], "2030-01-01", "2030-01-31")
    path = os.path.join(scratch, "empty")
    write_report_csv(out, path)
    assert _csv_lines(path) == ["date,eventName,eventCount"]


def test_gzip_report(spark, scratch):
    out = RP.report_from_definition(landed_rows(events(spark)), AD_DEFINITION, "2024-01-01", "2024-01-31")
    path = os.path.join(scratch, "gz")
    write_report_csv(out.coalesce(1), path, gzip=True)
    lines = _csv_lines(path, gzip.open)
    assert lines[0] == ",".join(AD_DEFINITION["dimensions"] + AD_DEFINITION["metrics"])
    assert len(lines) == 1 + out.count()


def test_events_report_whole_table(spark):
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    out = RP.run_report(ev, [], ["eventCount"], "2024-01-01", "2024-01-31")
    assert out.first()[0] == ev.count()


def test_report_jobs(spark, scratch):
    import json

    from audival.plans.report_jobs import adserver_report, web_report
    ev_path = f"{SMALL}/events.parquet"
    web = web_report(spark, ev_path, ["date", "eventName"], ["eventCount"], "2024-01-01", "2024-01-31",
                     os.path.join(scratch, "web"))
    assert web.columns == ["date", "eventName", "eventCount"]
    assert sum(int(r["eventCount"]) for r in web.collect()) == spark.read.parquet(ev_path).count()
    landed = os.path.join(scratch, "landed")
    landed_rows(spark.read.parquet(ev_path)).write.parquet(landed)
    out = adserver_report(spark, landed, json.dumps(AD_DEFINITION), "2024-01-01", "2024-01-31",
                          os.path.join(scratch, "ad"))
    assert out.columns == AD_DEFINITION["dimensions"] + AD_DEFINITION["metrics"]
    assert glob.glob(os.path.join(scratch, "ad", "*.csv.gz"))


def test_report_range_reaches_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    out = RP.run_report(ev, ["eventName"], ["eventCount"], "2024-01-05", "2024-01-09")
    text = out._jdf.queryExecution().executedPlan().toString()
    scan = [ln for ln in text.splitlines() if "FileScan parquet" in ln][0]
    pushed = scan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in pushed and "LessThan(ts,2024-01-10T00:00)" in pushed, pushed
    days = ev.filter(F.to_date("ts").between("2024-01-05", "2024-01-09")).count()
    assert out.agg(F.sum("eventCount")).first()[0] == days


def test_a_filter_on_the_reason_does_not_parse_again(spark):
    landed = spark.createDataFrame([("int_value: 20240101", "double_value: x"), ("int_value: 20240102", "double_value: 1")],
                                   "date string, paid string")
    good = RP.split_landed(landed, {"dimensions": ["date"], "metrics": ["paid"]}).filter("reason is null")
    assert str(good._jdf.queryExecution().optimizedPlan()).count("gettimestamp") == 1
    assert [tuple(r)[1:] for r in good.collect()] == [(1.0, None)]
