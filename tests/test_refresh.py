"""Monthly refresh, order of the stored tables, leases and expiry."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from audival.plans.files import Files
from audival.plans.inputs import INPUT_NAMES, Inputs
from audival.plans.refresh import fingerprints, months_only
from audival.plans.run import TABLES, open_tables, refresh_models, run_models
from audival.plans.stage import Stager
from audival.plans.store import MONTH, MonthTables, Published, key_columns

from paths import SMALL

CHANGED = "1996-03-01"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The inputs as files, the monthly user metrics in a folder per month."""
    root, inp, paths = str(tmp_path_factory.mktemp("inputs")), Inputs.from_testdata(spark, SMALL), {}
    for name in INPUT_NAMES:
        paths[name] = os.path.join(root, name)
        df, writer = getattr(inp, name), None
        writer = df.write
        if name == "user_metrics_monthly":
            writer = df.repartition("month").write.partitionBy("month")
        writer.parquet(paths[name])
    return paths


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def runs_by_month(store, table="customers"):
    return store.manifest()["tables"][table]["months"]


@pytest.fixture(scope="module")
def root(spark, stored, tmp_path_factory):
    """The first publication of these inputs; tests that publish go on from it."""
    target = str(tmp_path_factory.mktemp("published"))
    assert CHANGED in refresh_models(Inputs.from_paths(spark, stored), Stager(spark, target))
    return target


def test_stored_tables_are_sorted_and_pruned(spark, root):
    assert Published(spark, root).numbers() == [1]
    for name, df in open_tables(spark, root).items():
        rows = df.select(*key_columns(df)).coalesce(1).collect()
        months = [r[MONTH] for r in rows]
        by_month = {m: [tuple("" if v is None else str(v) for v in r[1:]) for r in rows if r[MONTH] == m] for m in months}
        assert all(part == sorted(part) for part in by_month.values()), name
        files = sorted(f.split("month=")[1] for f in df.inputFiles())
        assert len(files) == len(set(f.split("/")[0] for f in files)) == len(by_month)  # a file per month, names in order
        one = df.filter(F.col(MONTH) == dt.date(1996, 3, 1))
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "1996-03-01" in plan.split("PartitionFilters")[1].split("]")[0]


def test_one_changed_month_rewrites_that_month(spark, root, stored, tmp_path):
    store = Published(spark, root)
    # nothing has changed: nothing is written, nothing published
    assert refresh_models(Inputs.from_paths(spark, stored), Stager(spark, root)) == []
    assert store.numbers() == [1]
    # one month of one input is delivered anew
    month = f"{stored['user_metrics_monthly']}/month={CHANGED}"
    spark.read.parquet(month).withColumn("device_count", F.col("device_count") * 5).write.parquet(str(tmp_path / "new"))
    spark.read.parquet(str(tmp_path / "new")).write.mode("overwrite").parquet(month)
    before = runs_by_month(store)
    now = Inputs.from_paths(spark, stored)
    assert refresh_models(now, Stager(spark, root)) == [CHANGED]
    after = runs_by_month(store)
    assert {m for m in after if after[m] != before[m]} == {CHANGED}
    for table in TABLES:
        written = os.listdir(os.path.join(root, "tables", table, f"run={after[CHANGED]}"))
        assert [n for n in written if "SUCCESS" not in n] == [f"month={CHANGED}"], table
    # the same as computing everything
    full = run_models(now, Stager(spark, str(tmp_path / "full")))
    got = open_tables(spark, root)
    for table in TABLES:
        assert bag(got[table]) == bag(full[table]), table
        assert got[table].columns == full[table].columns


def test_a_month_that_is_gone(spark, root, stored):
    inp = Inputs.from_paths(spark, stored)
    names = Published(spark, root).numbers()
    last = months_only(inp, [m for m in fingerprints(inp) if m >= "1996-07-01"])
    refresh_models(inp.with_tables(**{n: last.source(n) for n in INPUT_NAMES}), Stager(spark, root))
    store = Published(spark, root)
    assert len(store.numbers()) == len(names) + 1 and min(store.manifest()["months"]) == "1996-07-01"
    assert open_tables(spark, root)["customers"].filter(F.col("month") < "1996-07-01").isEmpty()


def test_inputs_of_a_month_are_scanned_for_it_alone(spark, stored):
    part = months_only(Inputs.from_paths(spark, stored), [CHANGED])
    plan = part.user_metrics_monthly._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan.replace("PartitionFilters: [(isnotnull", "PartitionFilters: [isnotnull")
    assert all(CHANGED in f for f in part.user_metrics_monthly.inputFiles()) or "1996-03-01" in plan
    plan = part.ga4_export._jdf.queryExecution().executedPlan().toString()
    assert "199603" in plan.split("PushedFilters")[1].split("]")[0]
    assert {r[0] for r in part.rpm.select("month").distinct().collect()} == {dt.date(1996, 3, 1)}


def test_fingerprints_see_rows_parameters_and_files(spark, stored):
    inp = Inputs.from_paths(spark, stored)
    base = fingerprints(inp)
    assert base == fingerprints(Inputs.from_paths(spark, stored))
    other = fingerprints(Inputs.from_paths(spark, stored, publication="another"))
    assert set(other) == set(base) and all(other[m] != base[m] for m in base)
    moved = fingerprints(Inputs.from_paths(spark, stored, window=("1996-02-01", "1996-08-01")))
    assert {m for m in base if moved[m] != base[m]} == {"1996-01-01"}
    # an input that is no scan of files: its rows
    changed = inp.rpm.withColumn("rpm", F.when(F.col("month") == CHANGED, F.col("rpm") + 1).otherwise(F.col("rpm")))
    one, two = (fingerprints(inp.with_tables(rpm=df.union(df.limit(0)).groupBy(*df.columns).count().drop("count")))
                for df in (inp.rpm, changed))
    assert {m for m in one if one[m] != two[m]} == {CHANGED}


def written(spark, store, run, times=1):
    """A run of one small table, not published."""
    tables = MonthTables(spark, store.root, run)
    df = spark.sql(f"SELECT DATE'1996-01-01' + INTERVAL 1 MONTH * (id % 3) AS m, id * {times} AS n FROM range(9)")
    tables.write(df.select(F.col("m").cast("date").alias("month"), F.col("n").cast("double").alias("n")), "customers")
    return {"months": {}, "tables": {"customers": {"schema": tables.schemas["customers"].jsonValue(), "months": {
        f"1996-0{m}-01": run for m in (1, 2, 3)}}}}


def test_expiry_leaves_what_a_reader_holds(spark, scratch):
    """A reader open across two runs, a failed run and an expiry."""
    store, files = Published(spark, scratch), Files(spark)
    store.publish(written(spark, store, "r1"), None)
    reading = store.open()
    before = bag(reading.tables["customers"])
    for n in (2, 3):
        store.publish(written(spark, store, f"r{n}", n), n - 1)
    failed = store.hold({"run": "r4"}, -1)  # its lease is over when it dies
    written(spark, store, "r4")
    folders = lambda: files.names(f"{scratch}/tables/customers")
    assert store.numbers() == [1, 2, 3] and len(folders()) == 4
    assert store.expire(keep=1)
    assert store.numbers() == [1, 3] and folders() == ["run=r1", "run=r3"]  # held, and the latest
    assert not files.exists(failed)
    assert bag(reading.tables["customers"]) == before
    at_work = store.hold({"run": "r5"}, 60)
    written(spark, store, "r5")
    reading.release()
    store.expire(keep=1)
    assert store.numbers() == [3] and folders() == ["run=r3", "run=r5"]  # the latest, and what is being written
    # a refresh of one month: the others' folders of the run before stay
    part = written(spark, store, "r5")
    part["tables"]["customers"]["months"] |= {"1996-01-01": "r3", "1996-02-01": "r3"}
    store.publish(part, 3)
    files.delete(at_work)
    store.expire(keep=1)
    assert store.numbers() == [4] and folders() == ["run=r3", "run=r5"]
    assert [n for n in files.names(f"{scratch}/tables/customers/run=r5") if n.startswith("month")] == ["month=1996-03-01"]
    assert open_tables(spark, scratch)["customers"].count() == 9 and store.expire(keep=1) == []


def test_of_two_publications_at_once_one_fails(spark, scratch):
    store = Published(spark, scratch)
    manifest = {"months": {}, "tables": {}}
    assert store.publish(manifest, None) == 1
    with pytest.raises(RuntimeError, match="run again"):
        store.publish(manifest, None)
    assert store.publish(manifest, 1) == 2 and store.numbers() == [1, 2]
    assert store.open().number == 2
