import os

from audival.__main__ import main
from audival.plans.inputs import INPUT_NAMES, Inputs
from audival.plans.run import open_tables
from audival.plans.stage import Stager

from paths import SMALL


def test_web_report_command(spark, scratch):
    out = os.path.join(scratch, "web")
    main(["web-report", "--events", f"{SMALL}/events.parquet", "--dims", "date,eventName",
          "--metrics", "totalUsers,eventCount", "--start", "2024-01-01", "--end", "2024-01-31",
          "--out", out, "--filter", 'eventName exact "view"'])
    rows = spark.read.option("header", True).csv(out).collect()
    assert rows and {r["eventName"] for r in rows} == {"view"}


def test_models_command(spark, scratch):
    inputs = os.path.join(scratch, "inputs")
    landed = Inputs.from_testdata(spark, SMALL)
    stager = Stager(spark, inputs)
    for name in INPUT_NAMES:
        stager.write(getattr(landed, name), name)
    out = os.path.join(scratch, "tables")
    main(["models", "--inputs", inputs, "--out", out, "--publication", "site_a", "--device-prefix", "app_",
          "--start", "1996-01-01", "--end", "1996-08-01"])
    assert open_tables(spark, out)["total_tclv_login_state"].count() > 0
