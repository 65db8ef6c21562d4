"""Run all stored tables of the models in dependency order, each written
once as parquet by month: the batch job the model files describe. Tables of one
level do not depend on each other and are written concurrently. ``run_models``
computes every month; ``refresh_models`` only those whose inputs have changed."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from audival.operators.rollup import total_tclv
from audival.plans.checks import check_lookups
from audival.plans.inputs import Inputs
from audival.plans.models import Chain
from audival.plans.refresh import fingerprints, months_only
from audival.plans.stage import Stager, run_concurrently
from audival.plans.store import MONTH, MonthTables, Published

# Stored table names (sanitised: no spaces or '+').
TABLES = [
    "loyalty_ratio", "loyalty_ratio_device_scope", "customers", "customers_device_scope",
    "weighted_login_state_loyalty", "weighted_device_loyalty_login_state",
    "weighted_login_state", "weighted_loyalty", "weighted_device_login_state",
    "weighted_device_loyalty", "total_tclv_login_state", "total_tclv_login_state_loyalty",
]


#: How long a run that died is taken for one at work.
WRITING = 24 * 3600.0


def run_models(inp: Inputs, target: Stager, check_keys: bool = True, workers: int = 4) -> dict[str, DataFrame]:
    """Write all months of K1..K12 under ``target.root`` and publish them;
    returns a scan of each table. Readers (``open_tables``) see the publication
    before until all twelve tables exist, so a run that fails changes nothing
    for them. Stages between go to the checkpoint folder and are removed.
    ``check_keys`` first verifies that every lookup is unique on its join keys
    (one small aggregate each). A window without data is an error."""
    _refresh(inp, target, check_keys, workers, every=True)
    store = Published(target.spark, target.root)
    return store.read(store.manifest())


def refresh_models(inp: Inputs, target: Stager, check_keys: bool = True, workers: int = 4) -> list[str]:
    """Compute the months whose inputs have changed since the last publication
    from the inputs' rows of these months, publish them beside the others, and
    return them. Months that no input has any more are left out of the new
    publication. Nothing is written if nothing has changed."""
    return _refresh(inp, target, check_keys, workers, every=False)


def _refresh(inp: Inputs, target: Stager, check_keys: bool, workers: int, every: bool) -> list[str]:
    spark, store = target.spark, Published(target.spark, target.root)
    now, last = fingerprints(inp), store.manifest()
    before = last["months"] if last else {}
    changed = sorted(m for m in now if every or before.get(m, {}).get("fingerprint") != now[m])
    if not changed and set(before) <= set(now) and last:
        return []
    if not any(str(inp.window[0]) <= m <= str(inp.window[1]) for m in now):
        raise ValueError(f"no user metrics of {inp.publication!r} in {inp.window[0]} .. {inp.window[1]}")
    part = inp if set(changed) == set(now) else months_only(inp, changed)
    if check_keys:
        check_lookups(part)
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    lease = store.hold({"run": run}, WRITING)
    tables = MonthTables(spark, target.root, run)
    if changed:
        _write(part, tables, workers, must_have_data=set(changed) == set(now))
    manifest = {"months": {m: {"fingerprint": now[m], "run": run if m in changed else before[m]["run"]} for m in now},
                "tables": {}}
    for table in TABLES:
        stays = {m: r for m, r in (last["tables"][table]["months"] if last else {}).items()
                 if m in now and m not in changed}
        new = [n.split("=", 1)[1] for n in store.files.names(tables.path(table)) if n.startswith(f"{MONTH}=")]
        schema = tables.schemas[table].jsonValue() if changed else last["tables"][table]["schema"]
        manifest["tables"][table] = {"schema": schema, "months": stays | dict.fromkeys(new, run)}
    store.publish(manifest, last["number"] if last else None)
    store.files.delete(lease)
    return changed


def _write(inp: Inputs, stager: MonthTables, workers: int, must_have_data: bool) -> None:
    """K1..K12 of the inputs' months, as the tables of one run."""
    spark = stager.spark
    stages = Stager(spark)
    ch = Chain(inp, stages, store_tables=True, tables=stager)
    out: dict[str, DataFrame] = {}
    # each large input is aggregated once; then one level of tables at a time
    run_concurrently({"base_device": lambda: ch.base(True), "clean_device": lambda: ch.clean_export(True),
                      "device_aggregate": ch.clean_device_aggregate, "subscription": ch.subscription_sums}, workers)
    if must_have_data and ch.base(True).isEmpty():
        raise ValueError(f"no user metrics of {inp.publication!r} in {inp.window[0]} .. {inp.window[1]}")
    run_concurrently({"base": ch.base, "clean": ch.clean_export, "arpu": ch.arpu, "arpu_device": lambda: ch.arpu(True)},
                     workers)
    out.update(run_concurrently({"loyalty_ratio": ch.loyalty_ratio,
                                 "loyalty_ratio_device_scope": lambda: ch.loyalty_ratio(True)}, workers))
    out.update(run_concurrently({"customers": ch.customers,
                                 "customers_device_scope": lambda: ch.customers(True)}, workers))
    out.update(run_concurrently({"weighted_login_state_loyalty": ch.value_by_cell,
                                 "weighted_device_loyalty_login_state": lambda: ch.value_by_cell(True)}, workers))
    rollups = {
        "weighted_login_state": lambda: stager.write(ch.weighted("login_state"), "weighted_login_state"),
        "weighted_loyalty": lambda: stager.write(ch.weighted("loyalty_segment"), "weighted_loyalty"),
        "weighted_device_login_state": lambda: stager.write(ch.weighted("login_state", True),
                                                            "weighted_device_login_state"),
        "weighted_device_loyalty": lambda: stager.write(ch.weighted("loyalty_segment", True),
                                                        "weighted_device_loyalty"),
        "total_tclv_login_state_loyalty": lambda: stager.write(ch.total_tclv_login_state_loyalty(),
                                                               "total_tclv_login_state_loyalty"),
    }
    out.update(run_concurrently(rollups, workers))
    out["total_tclv_login_state"] = stager.write(
        total_tclv(out["weighted_login_state"], out["customers"], ["login_state"], calendar=True),
        "total_tclv_login_state")
    stages.discard()


def open_tables(spark: SparkSession, root: str, hold: float = 24 * 3600.0) -> dict[str, DataFrame]:
    """The tables of the latest publication under ``root``, which stays for
    ``hold`` seconds whatever is published or expired meanwhile;
    ``Published.open`` gives a lease that can be released."""
    return Published(spark, root).open(hold).tables
