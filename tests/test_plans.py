"""Plan checks: pushdown into the scans, no Python evaluation, no window over
a month's devices, no sort kept under a union."""

import re

from audival.plans import queries as Q
from audival.plans.inputs import Inputs
from audival.plans.models import Chain
from audival.plans.stage import Stager

from paths import SMALL


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_base_pushes_filters_and_prunes(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    inp = Inputs.from_testdata(spark, SMALL)
    stored = Stager(spark).write(inp.user_metrics_monthly, "user_metrics_monthly")  # as a real input table
    df = Chain(inp.with_tables(user_metrics_monthly=stored)).base()
    text = plan_text(df)
    scan = [line for line in text.splitlines() if "FileScan parquet" in line][0]
    pushed = scan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    for f in ("IsNotNull(user_status)", "Not(EqualTo(user_status,notSpecified))",
              "GreaterThanOrEqual(month,1996-01-01)", "LessThanOrEqual(month,1996-08-01)"):
        assert f in pushed, (f, pushed)
    assert "ReadSchema: struct<month:date,requestSource:string,user_status:string,loyalty_segment_1m:string," \
           "device_count:bigint,pageview_count:bigint>" in scan


def test_no_python_udfs_in_any_query(spark):
    for name, q in Q.registry().items():
        text = plan_text(q(spark, SMALL))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas", text), name


def test_device_scope_has_no_month_wide_window(spark):
    """Totals over a month's devices are joined partial sums (test_run.py
    counts the scans of a whole run)."""
    for key in ("loyalty_ratio_device_scope", "customers_device_scope"):
        assert "Window" not in plan_text(Q.registry()[key](spark, SMALL)), key


def test_no_sort_under_union(spark):
    for name in ("customers", "value_by_cell", "no_consent_uplift"):
        text = plan_text(Q.registry()[name](spark, SMALL))
        assert not re.search(r"Sort \[[^\]]*\], true", text), name  # only window-local sorts


def test_customer_model_plan_stays_small(spark):
    for key in ("customers", "customers_device_scope"):
        df = Q.registry()[key](spark, SMALL)
        df.collect()
        text = plan_text(df).split("== Initial Plan ==")[0]
        shuffles = len(re.findall(r"(?<!ReusedExchange )(?<!\], )Exchange hashpartitioning", text))
        assert shuffles <= 7, (key, shuffles)
        assert "SortMergeJoin" not in text, key
