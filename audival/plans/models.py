"""The models as compositions of operators over one set of inputs.

``Chain`` builds each table of the models once per chain. With a ``Stager``
the first aggregate over each large input (the user-metrics base, the GA4
cleans, the subscription arpu) is written to shared storage and read back:
every later stage reads those small stored tables, so each large input is
scanned once however often the models use it, and Spark plans the joins
above them from real file sizes. Everything after the first aggregate is
months x devices x states x segments and is cheaper to recompute than to
store, except the customer and value tables, which later stages read two or
three times each: those are stored when a later stage asks for them
(``shared=True``), or always with ``store_tables`` (the batch run, whose
outputs they are). Independent stored stages are written as concurrent
jobs (``prefetch``); a per-stage lock keeps each stage built once. Without a
stager everything stays one lazy plan.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.operators import audience as A
from audival.operators import customers as C
from audival.operators import rollup as R
from audival.operators import value as VL
from audival.plans.inputs import Inputs
from audival.plans.stage import Stager, run_concurrently
from audival.sources.ga4 import ga4_device_rows, ga4_export_rows


def legacy_ratios(ratios: DataFrame) -> DataFrame:
    """The earlier models' ratio table: status column named login_state_raw."""
    return ratios.withColumnRenamed("user_status", "login_state_raw").drop("loyalty_pageviews_ratio")


class Chain:
    def __init__(self, inp: Inputs, stager: Stager | None = None, store_tables: bool = False,
                 tables: Stager | None = None):
        self.inp = inp
        self.stager = stager
        self.tables = tables or stager  # where the models' own tables go
        self.store_tables = store_tables
        self._stages: dict[tuple[str, bool], DataFrame] = {}
        self._locks: dict[tuple[str, bool], threading.Lock] = {}
        self._guard = threading.Lock()

    def _stage(self, name: str, build: Callable[[], DataFrame], store: bool = False,
               into: Stager | None = None) -> DataFrame:
        """Build (and store) a stage once; a per-stage lock lets concurrent
        jobs ask for the same stage, the later one waiting for the first."""
        key = (name, store and self.stager is not None)
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self._stages:
                df = build()
                self._stages[key] = (into or self.stager).write(df, name) if key[1] else df
        return self._stages[key]

    # --- customers side ------------------------------------------------------

    def base(self, by_device: bool = False, windowed: bool = True) -> DataFrame:
        """O11 over the model window (or unbounded for the earliest model). The
        input is aggregated once, by device; the table without devices is the
        sum of that one."""
        inp = self.inp
        start, end = inp.window if windowed else (None, None)
        name = "base" + ("_device" if by_device else "") + ("" if windowed else "_all")
        if windowed and not by_device:
            return self._stage(name, lambda: C.without_device(self.base(True)), store=True)
        return self._stage(name, lambda: C.user_metrics_base(
            inp.user_metrics_monthly, inp.publication, start, end, by_device, inp.device_prefix), store=True)

    def _table(self, name: str, build: Callable[[], DataFrame], shared: bool) -> DataFrame:
        lazy = self._stage(name, build)
        return self._stage(name, lambda: lazy, store=True, into=self.tables) if (shared or self.store_tables) else lazy

    def loyalty_ratio(self, by_device: bool = False) -> DataFrame:
        """K1 / K2."""
        name = "loyalty_ratio_device_scope" if by_device else "loyalty_ratio"
        # cells by device have no bound of their own per month: totals by join
        method = "join" if by_device else "window"
        return self._table(name, lambda: C.loyalty_ratio(self.base(by_device), by_device, method), False)

    def customers(self, by_device: bool = False, shared: bool = False) -> DataFrame:
        """K3 / K4."""
        name = "customers_device_scope" if by_device else "customers"
        return self._table(name, lambda: C.customers_wide(self.base(by_device), self.inp.manual_monthly,
                                                          by_device), shared)

    def ground_truth(self, by_device: bool = False) -> DataFrame:
        b = self.base(by_device)
        return C.ground_truth(b, C.reach_ratio(self.inp.manual_monthly, b), by_device)

    def customers_legacy(self) -> DataFrame:
        """Earliest customer model (O19a): no month bound, every status."""
        b = self.base(windowed=False)
        gt = C.ground_truth(b, C.reach_ratio(self.inp.manual_monthly, b))
        return C.no_consent_customers(gt, self.inp.manual_monthly, "all")

    # --- audience side --------------------------------------------------------

    def clean_export(self, by_device: bool = False, with_pageviews: bool = True) -> DataFrame:
        """The export is aggregated once, by device; the other forms are
        sums and columns of that table."""
        inp = self.inp
        if not with_pageviews:
            return self.clean_export(by_device).drop("pageviews")
        if not by_device:
            return self._stage("clean_ga4", lambda: A.without_device(self.clean_export(True)), store=True)
        return self._stage("clean_ga4_device", lambda: A.clean_ga4(
            ga4_export_rows(inp.ga4_export), inp.publication, True, True, inp.device_prefix), store=True)

    def clean_device_aggregate(self) -> DataFrame:
        inp = self.inp
        return self._stage("clean_ga4_device_aggregate", lambda: A.clean_ga4(
            ga4_device_rows(inp.ga4_device_aggregate), inp.publication, True, False, inp.device_prefix),
            store=True)

    def arpu(self, by_device: bool = False) -> DataFrame:
        """O32 from the sums and counts of the per-order subscription values,
        which are taken once, by device."""
        sums = self.subscription_sums()
        return self._stage("subscription_arpu" + ("_device" if by_device else ""),
                           lambda: VL.arpu_of_sums(sums, by_device), store=True)

    def subscription_sums(self) -> DataFrame:
        return self._stage("subscription_sums", lambda: VL.subscription_sums(self.inp.subscription_arpu), store=True)

    def enriched(self) -> DataFrame:
        return A.enrich_pageviews(self.clean_device_aggregate(), self.clean_export(True, True))

    def audience_states(self, by_device: bool = False) -> DataFrame:
        """Login states plus the extrapolated No Consent row (current models)."""
        clean = self.enriched() if by_device else self.clean_export()
        return A.add_no_consent(clean, self.inp.consent_rate, "extrapolate", by_device)

    def audience_cells(self, by_device: bool = False) -> DataFrame:
        split = A.loyalty_split(self.audience_states(by_device), self.loyalty_ratio(by_device), by_device)
        return A.audience_lifetime(split, by_device)

    def prefetch(self, by_device: bool = False) -> None:
        """Store what the value chain reads first as concurrent jobs: the GA4
        cleans and arpu, and the customer table (which waits only for the
        user-metrics base)."""
        if self.stager is None:
            return
        jobs = {"customers": lambda: self.customers(by_device, True), "arpu": lambda: self.arpu(by_device)}
        if by_device:
            jobs["device_aggregate"] = self.clean_device_aggregate
            jobs["clean"] = lambda: self.clean_export(True, True)
        else:
            jobs["clean"] = self.clean_export
        run_concurrently(jobs)

    def advertising(self, by_device: bool = False) -> DataFrame:
        self.prefetch(by_device)
        inp = self.inp
        return VL.advertising_value(self.audience_cells(by_device), inp.impressions_per_view, inp.rpm,
                                    C.customers_by_cell(self.customers(by_device, True), by_device),
                                    rule="guard" if by_device else "override", by_device=by_device)

    def subscription(self, by_device: bool = False) -> DataFrame:
        inp = self.inp
        lifetime = inp.subscription_lifetime_device if by_device else inp.subscription_lifetime
        return VL.subscription_value(lifetime, self.arpu(by_device), by_device)

    def value_by_cell(self, by_device: bool = False, shared: bool = False) -> DataFrame:
        """K5 / K6."""
        name = ("weighted_device_loyalty_login_state" if by_device
                else "weighted_login_state_loyalty")
        return self._table(name, lambda: VL.value_by_cell(
            self.advertising(by_device), self.subscription(by_device), by_device), shared)

    # --- roll-ups ----------------------------------------------------------------

    def weighted(self, keep: str, by_device: bool = False) -> DataFrame:
        """K7-K10."""
        customers = self.customers(by_device, True)
        weight = R.customer_weight(customers, keep, by_device)
        return R.weighted_rollup(self.value_by_cell(by_device, True), weight, keep, by_device)

    def total_tclv_login_state(self) -> DataFrame:
        """K11."""
        return R.total_tclv(self.weighted("login_state"), self.customers(shared=True), ["login_state"],
                            calendar=True)

    def total_tclv_login_state_loyalty(self) -> DataFrame:
        """K12."""
        return R.total_tclv(self.value_by_cell(shared=True), self.customers(shared=True),
                            ["login_state", "loyalty_segment"])

    # --- earlier ad-hoc models ------------------------------------------------------

    def legacy_states(self, by_device: bool = False) -> DataFrame:
        """States with No Consent as a share of the total (earlier models)."""
        clean = self.clean_device_aggregate() if by_device else self.clean_export(with_pageviews=False)
        return A.add_no_consent(clean, self.inp.consent_rate, "share", by_device)

    def loyalty_split_report(self) -> DataFrame:
        """Device x state x segment users, new users and lifetime."""
        return A.loyalty_split(self.legacy_states(True), self.legacy_ratio(True), True, legacy=True)

    def legacy_ratio(self, by_device: bool = False) -> DataFrame:
        """S6, in the form with or without devices, if given, else K1 / K2 in its form."""
        given = self.inp.loyalty_ratio_legacy_device if by_device else self.inp.loyalty_ratio_legacy
        return given if given is not None else legacy_ratios(self.loyalty_ratio(by_device))

    def true_customers(self) -> DataFrame:
        """S10 if given, else K3."""
        given = self.inp.true_customer
        return given if given is not None else self.customers(shared=True)

    def legacy_cells(self, per_segment: bool = True) -> DataFrame:
        split = A.loyalty_split(self.legacy_states(), self.legacy_ratio(), legacy=True)
        return A.audience_lifetime(split, per_segment=per_segment)

    def advertising_v1(self) -> DataFrame:
        """Per-state advertising value x 10, month as text with '-01'."""
        inp = self.inp
        pv = A.pageviews_by_cell(inp.manual_pageviews, per_segment=False)
        adv = VL.advertising_value(self.legacy_cells(per_segment=False), inp.impressions_per_view, inp.rpm,
                                   pageviews=pv, rule="users", scale=10.0, per_segment=False)
        return adv.select("advertising_value",
                          F.concat(F.col("month").cast("string"), F.lit("-01")).alias("month"),
                          "publication", "login_state", "views_per_user", "impressions_per_pageviews",
                          "impressions_per_user", "rpm", "lifetime")

    def legacy_advertising(self) -> DataFrame:
        """Earlier login-state model: true customers and manual page views."""
        inp = self.inp
        pv = A.pageviews_by_cell(inp.manual_pageviews)
        return VL.advertising_value(self.legacy_cells(), inp.impressions_per_view, inp.rpm,
                                    customers=C.customers_by_cell(self.true_customers()), pageviews=pv,
                                    rule="customers")

    def weighted_legacy(self, keep: str) -> DataFrame:
        """Earlier login-state / loyalty models: value before weight, then the
        roll-up with that roll-up's customer weights: the given tables (S6, S10,
        S13) where there are any, else the chain's own."""
        values = VL.value_by_cell(self.legacy_advertising(), self.subscription())
        given = getattr(self.inp, "customer_weight_" + {"login_state": keep, "loyalty_segment": "loyalty"}[keep])  # S13
        weight = given if given is not None else R.customer_weight(self.true_customers(), keep)
        return R.weighted_rollup(values, weight, keep)
