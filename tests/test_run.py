"""The batch run (every table written, later tables reading the stored ones)
gives the same tables as the registered queries."""

from collections import Counter

from audival.plans.inputs import Inputs
from audival.plans.queries import present, registry
from audival.plans.run import TABLES, open_tables, run_models
from audival.plans.stage import Stager

from paths import SMALL

KEYS = {
    "loyalty_ratio": "loyalty_ratio", "customers": "customers",
    "customers_device_scope": "customers_device_scope",
    "weighted_login_state_loyalty": "value_by_cell",
    "weighted_device_loyalty_login_state": "value_by_cell_device",
    "weighted_loyalty": "weighted_loyalty", "weighted_device_login_state": "weighted_device_login_state",
    "total_tclv_login_state": "total_tclv_login_state",
    "total_tclv_login_state_loyalty": "total_tclv_login_state_loyalty",
}


def bag(df):
    cols = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_batch_run_matches_queries(spark, scratch):
    out = run_models(Inputs.from_testdata(spark, SMALL), Stager(spark, scratch))
    assert set(out) == set(TABLES)
    for table, key in KEYS.items():
        stored = present(open_tables(spark, scratch)[table])
        assert bag(stored) == bag(registry()[key](spark, SMALL)), table


class RecordingStager(Stager):
    """Keeps the plan of everything written, under any stager's name."""
    plans: list[str] = []

    def write(self, df, name):
        RecordingStager.plans.append(df._jdf.queryExecution().optimizedPlan().toString() + "\n" +
                                     df._jdf.queryExecution().executedPlan().toString())
        return super().write(df, name)


def test_a_run_scans_each_large_input_once(spark, scratch, monkeypatch):
    import audival.plans.run as run_module
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    inp = Inputs.from_testdata(spark, SMALL)
    RecordingStager.plans = []
    monkeypatch.setattr(run_module, "Stager", RecordingStager)
    run_models(inp, RecordingStager(spark, scratch))
    paths = {n: getattr(inp, n).inputFiles()[0].rsplit("/", 1)[0].split(":", 1)[1].lstrip("/")
             for n in ("user_metrics_monthly", "ga4_export", "ga4_device_aggregate", "subscription_arpu")}
    for name, path in paths.items():
        scans = sum(line.count("FileScan parquet") for plan in RecordingStager.plans for line in plan.splitlines()
                    if f"/{path.rsplit('/', 1)[0].rsplit('/', 1)[1]}/{name}]" in line)
        assert scans == 1, (name, scans)


def test_failed_run_leaves_the_published_tables(spark, scratch, monkeypatch):
    import pytest

    import audival.plans.run as run_module
    inp = Inputs.from_testdata(spark, SMALL)
    run_models(inp, Stager(spark, scratch))
    before = {t: bag(df) for t, df in open_tables(spark, scratch).items()}

    def broken(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(run_module, "total_tclv", broken)
        with pytest.raises(RuntimeError, match="lost"):
            run_models(inp.with_tables(rpm=inp.rpm.withColumn("rpm", inp.rpm["rpm"] * 2)), Stager(spark, scratch))
    assert {t: bag(df) for t, df in open_tables(spark, scratch).items()} == before
    with pytest.raises(ValueError, match="no user metrics"):
        inp.window = ("2025-01-01", "2025-02-01")
        try:
            run_models(inp, Stager(spark, scratch))
        finally:
            inp.window = ("1996-01-01", "1996-08-01")


def test_only_the_tables_are_left(spark, scratch):
    import os
    run_models(Inputs.from_testdata(spark, SMALL), Stager(spark, scratch))
    assert sorted(os.listdir(os.path.join(scratch, "tables"))) == sorted(TABLES)
    assert {len(os.listdir(os.path.join(scratch, "tables", t))) for t in TABLES} == {1}
