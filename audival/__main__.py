"""Command line: run the models or a report.

    python -m audival models --inputs DIR --out DIR --publication P \
        --device-prefix app_ --start 2025-01-01 --end 2026-01-01    # inputs stored as DIR/<name>
        [--changed]                                        # only months whose inputs have changed
    python -m audival expire --out DIR [--keep N]          # old publications that nobody holds
    python -m audival testdata --data DIR --out DIR        # inputs derived from TPC-H-style tables
    python -m audival web-report --events PATH --dims date,eventName \
        --metrics totalUsers,eventCount --start 2024-01-01 --end 2024-01-31 --out FILE.csv|DIR [--filter TEXT]
    python -m audival ad-report --landed PATH --definition FILE --start ... --end ... --out FILE.csv.gz|DIR \
        [--format parquet|csv|typed]
"""

from __future__ import annotations

import argparse

from audival.plans.inputs import INPUT_NAMES, Inputs
from audival.plans.report_jobs import adserver_report, web_report
from audival.plans.run import refresh_models, run_models
from audival.plans.stage import Stager
from audival.plans.store import Published
from audival.session import build_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="audival")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("models")
    m.add_argument("--inputs", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--publication", required=True)
    m.add_argument("--device-prefix", required=True)
    m.add_argument("--start", required=True)
    m.add_argument("--end", required=True)
    m.add_argument("--changed", action="store_true")
    x = sub.add_parser("expire")
    x.add_argument("--out", required=True)
    x.add_argument("--keep", type=int, default=2)
    t = sub.add_parser("testdata")
    t.add_argument("--data", required=True)
    t.add_argument("--out", required=True)
    w = sub.add_parser("web-report")
    for a in ("--events", "--dims", "--metrics", "--start", "--end", "--out"):
        w.add_argument(a, required=True)
    w.add_argument("--filter", default=None)
    a = sub.add_parser("ad-report")
    for arg in ("--landed", "--definition", "--start", "--end", "--out"):
        a.add_argument(arg, required=True)
    a.add_argument("--format", default="parquet", choices=["parquet", "csv", "typed"])
    p.add_argument("--master", default=None)
    args = p.parse_args(argv)

    spark = build_session(args.master)
    if args.cmd == "models":
        inp = Inputs.from_paths(spark, {n: f"{args.inputs.rstrip('/')}/{n}" for n in INPUT_NAMES},
                                publication=args.publication, device_prefix=args.device_prefix,
                                window=(args.start, args.end))
        (refresh_models if args.changed else run_models)(inp, Stager(spark, args.out))
    elif args.cmd == "expire":
        Published(spark, args.out).expire(args.keep)
    elif args.cmd == "testdata":
        run_models(Inputs.land(spark, args.data, Stager(spark, f"{args.out.rstrip('/')}/inputs")),
                   Stager(spark, args.out))
    elif args.cmd == "web-report":
        web_report(spark, args.events, args.dims.split(","), args.metrics.split(","), args.start, args.end,
                   args.out, args.filter)
    else:
        adserver_report(spark, args.landed, args.definition, args.start, args.end, args.out, args.format)


if __name__ == "__main__":
    main()
