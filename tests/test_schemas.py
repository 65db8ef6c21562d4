"""Typed readers, and the earlier models over given tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from audival.operators import rollup as R
from audival.plans.inputs import INPUT_NAMES, Inputs
from audival.plans.models import Chain, legacy_ratios
from audival.plans.queries import present
from audival.sources.schemas import MONTH, SCHEMAS, conform

from paths import SMALL


@pytest.mark.parametrize("name", sorted(n for n, s in SCHEMAS.items() if MONTH in s.values()))
def test_text_months_become_dates(spark, name):
    schema = SCHEMAS[name]
    kinds = ", ".join(f"`{c}` {'string' if k == MONTH else k}" for c, k in schema.items())
    blank = [None] * (len(schema) - 1)
    texts = ["1996-03-01", "1996-03", "199603", "1996-03-17", None]
    got = conform(spark.createDataFrame([(t, *blank) for t in texts], kinds), name)
    assert dict(got.dtypes)["month"] == "date" and got.columns == list(schema)
    assert [r["month"] for r in got.collect()] == [dt.date(1996, 3, 1)] * 4 + [None]
    for wrong in ("1996-13", "March", "96-03"):
        with pytest.raises(Exception, match="not a month"):
            conform(spark.createDataFrame([(wrong, *blank)], kinds), name).collect()


def test_wrong_types_are_errors(spark):
    good = spark.createDataFrame([(dt.date(1996, 1, 1), "p", 1)], "month date, publication string, consent_rate int")
    assert dict(conform(good, "consent_rate").dtypes)["consent_rate"] == "double"
    with pytest.raises(TypeError, match="consent_rate.consent_rate: expected double, found string"):
        conform(good.withColumn("consent_rate", F.lit("1")), "consent_rate")
    with pytest.raises(TypeError, match="publication is missing"):
        conform(good.drop("publication"), "consent_rate")
    with pytest.raises(TypeError, match="month is DATE or text"):
        conform(good.withColumn("month", F.lit(1)), "consent_rate")


def test_inputs_of_text_months_give_the_same_base(spark, scratch):
    landed = Inputs.from_testdata(spark, SMALL)
    paths = {n: os.path.join(scratch, n) for n in INPUT_NAMES}
    for n in INPUT_NAMES:
        df = getattr(landed, n)
        if SCHEMAS[n].get("month") == MONTH:
            df = df.withColumn("month", F.date_format("month", "yyyy-MM"))
        df.write.parquet(paths[n])
    got = Chain(Inputs.from_paths(spark, paths)).base()
    want = Chain(landed).base()
    assert got.dtypes == want.dtypes and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_earlier_models_run_on_given_tables(spark):
    landed = Inputs.from_testdata(spark, SMALL)
    own = Chain(landed)
    tables = {"loyalty_ratio_legacy": legacy_ratios(own.loyalty_ratio()), "true_customer": own.customers()}
    given = Chain(landed.with_tables(**tables))
    weights = R.customer_weight(own.customers(), "login_state")
    weighted = Chain(landed.with_tables(**tables, customer_weight_login_state=weights))
    want = present(own.weighted_legacy("login_state"))
    for chain in (given, weighted):
        got = present(chain.weighted_legacy("login_state"))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    double = landed.with_tables(**tables, customer_weight_login_state=weights.withColumn("weight", F.col("weight") * 2))
    more = Chain(double).weighted_legacy("login_state").agg(F.sum("weighted_value")).first()[0]
    assert abs(more / own.weighted_legacy("login_state").agg(F.sum("weighted_value")).first()[0] - 2) < 1e-9


def test_given_tables_are_checked_and_each_serves_its_own_model(spark):
    import pytest

    from audival.plans.checks import check_lookups
    landed = Inputs.from_testdata(spark, SMALL)
    own = Chain(landed)
    weights = {k: R.customer_weight(own.customers(), k) for k in ("login_state", "loyalty_segment")}
    none = weights["login_state"].withColumn("weight", F.lit(0.0))
    chain = Chain(landed.with_tables(customer_weight_login_state=none))
    assert chain.weighted_legacy("login_state").agg(F.max(F.abs("weighted_value"))).first()[0] == 0
    want = own.weighted_legacy("loyalty_segment").agg(F.sum("weighted_value")).first()[0]
    assert abs(chain.weighted_legacy("loyalty_segment").agg(F.sum("weighted_value")).first()[0] / want - 1) < 1e-9
    ratios = legacy_ratios(own.loyalty_ratio(True))
    by_device = Chain(landed.with_tables(loyalty_ratio_legacy_device=ratios.withColumn("loyalty_ratio", F.lit(0.0))))
    assert by_device.loyalty_split_report().agg(F.max("users")).first()[0] == 0
    assert own.loyalty_split_report().agg(F.max("users")).first()[0] > 0
    for name, df in (("customer_weight_loyalty", weights["loyalty_segment"]), ("loyalty_ratio_legacy_device", ratios)):
        check_lookups(landed.with_tables(**{name: df}))
        with pytest.raises(ValueError, match=f"{name}: join keys .* repeat"):
            check_lookups(landed.with_tables(**{name: df.union(df)}))
