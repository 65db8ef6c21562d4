"""Benchmark: land the inputs, run every model stage as one chain, then time
each registered query. Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3: the median of this many runs after one warm-up).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from audival.operators.customers import loyalty_ratio  # noqa: E402
from audival.plans.inputs import Inputs  # noqa: E402
from audival.plans.models import Chain  # noqa: E402
from audival.plans.queries import registry  # noqa: E402
from audival.plans.run import run_models  # noqa: E402
from audival.plans.stage import Stager  # noqa: E402
from audival.session import build_session  # noqa: E402

# Headline queries: the model's stored tables end to end, plus the reports.
HEADLINE = ["loyalty_ratio", "customers", "customers_device_scope", "value_by_cell",
            "value_by_cell_device", "weighted_login_state", "weighted_device_loyalty",
            "total_tclv_login_state", "total_tclv_login_state_loyalty", "report",
            "report_from_definition"]


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = build_session(f"local[{cpus}]", app="audival-bench", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    sf = re.search(r"sf([0-9.]+)", data_dir)

    land = timed(lambda: Inputs.from_testdata(spark, data_dir))
    inp = Inputs.from_testdata(spark, data_dir)
    chain_runs = [timed(lambda: run_models(inp, Stager(spark))) for _ in range(repeat + 1)][1:]

    base = Chain(inp, Stager(spark)).base(True)
    share_forms = {}
    for method in ("window", "join"):
        runs = [timed(lambda: loyalty_ratio(base, True, method).collect()) for _ in range(repeat + 1)][1:]
        share_forms[method] = round(statistics.median(runs), 3)

    qs = registry()
    names = HEADLINE if os.environ.get("BENCH_ALL") != "1" else sorted(qs)
    times, failed = {}, {}
    for name in names:
        try:
            runs = [timed(lambda: qs[name](spark, data_dir).collect()) for _ in range(repeat + 1)][1:]
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # noqa: BLE001 - record it, keep timing the rest
            failed[name] = str(e).splitlines()[0][:200]
    out = {
        "metric": "median seconds per headline query (landed inputs, staged chain)",
        "value": round(statistics.mean(times.values()), 3) if times else None,
        "unit": "sec",
        "queries": times,
        "land_inputs_sec": round(land, 3),
        "full_chain_sec": round(statistics.median(chain_runs), 3),
        "share_of_total_sec": share_forms,
        "sf": float(sf.group(1)) if sf else None,
        "cpus": int(cpus),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
