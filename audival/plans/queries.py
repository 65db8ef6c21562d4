"""One registered query per operator of the models and reports. Each takes
(spark, data_dir), reads the driver's tables there and returns the
operator's output at its place in the model chain. Doubles are rounded to a
fixed binary grid so that results compare exactly across engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from audival.functions import columns as FC
from audival.operators import audience as A
from audival.operators import customers as C
from audival.operators import report as RP
from audival.operators import rollup as R
from audival.plans.daily import DailyRollup, buckets_for
from audival.plans.models import Chain, legacy_ratios
from audival.plans.inputs import Inputs
from audival.plans.stage import Stager
from audival.sources import adserver, fixtures
from audival.sources.tables import Tables
from audival.streaming.landed import LandedTable, ingest_landed

# Doubles are rounded to a binary grid of 2**-16: a decimal-valued input
# (prices, their means) never sits exactly half-way on it, so the last-bit
# differences of summation order between engines cannot flip a rounding.
_SCALE = float(2 ** 16)

# The ad report's definition. The web report's dimensions and
# filters are our own choice over the events table (FIXTURES.md).
WEB_DIMENSIONS = ["date", "eventName"]
WEB_METRICS = ["totalUsers", "newUsers", "sessions", "screenPageViews", "eventCount"]
WEB_FILTERS = {"report_filter": 'eventName ends_with "Up"', "report_filter_contains": 'pagePath contains "/FR/"',
               "report_filter_exact": "customUser:user_status exact subscribed",
               "report_filter_begins_with": 'customUser:product_name begins_with "monat"'}
USER_DIMENSIONS = ["deviceCategory", "customUser:user_status", "customUser:product_name"]
AD_KINDS = {"impressions": "int_value", "revenue_without_cpd": "double_value"}
#: A range that leaves days of the events table out.
PART_OF_RANGE = ("2024-01-05", "2024-01-11")
AD_DEFINITION = {
    "dimensions": ["date", "ppid_status", "serving_restriction", "ad_unit_name_level_1", "device_category"],
    "metrics": ["impressions", "revenue_without_cpd"],
    "dateRangeType": "CUSTOM_DATE",
    "adUnitView": "HIERARCHICAL",
    "report_type": "HISTORICAL",
}


def rounded(c: F.Column) -> F.Column:
    """Round half away from zero on the scaled double, the same arithmetic
    any engine does for ``round(x * 1e5) / 1e5``, so results compare exactly across engines."""
    return F.round(c * F.lit(_SCALE)) / F.lit(_SCALE)


def present(df: DataFrame) -> DataFrame:
    return df.select(*[rounded(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


_CHAINS: dict[tuple[str, str], Chain] = {}


def chain_for(spark: SparkSession, data_dir: str, staged: bool = True) -> Chain:
    """The chain over the landed inputs of ``data_dir``. Staged, it is made
    once per application and folder, so its stages are written to the
    checkpoint folder once, however many queries read them."""
    if not staged:
        return Chain(Inputs.from_testdata(spark, data_dir), None)
    key = (spark.sparkContext.applicationId, data_dir.rstrip("/"))
    if key not in _CHAINS:
        _CHAINS[key] = Chain(Inputs.from_testdata(spark, data_dir), Stager(spark))
    return _CHAINS[key]


_GIVEN: dict[tuple[str, str], Chain] = {}


def given_chain_for(spark: SparkSession, data_dir: str) -> Chain:
    """The chain over the landed inputs and given tables of the earlier models
    (S6, S10, S13) that are not its own results."""
    key = (spark.sparkContext.applicationId, data_dir.rstrip("/"))
    if key not in _GIVEN:
        own, store = chain_for(spark, data_dir), Stager(spark)
        tables = fixtures.given_tables(
            legacy_ratios(own.loyalty_ratio()), legacy_ratios(own.loyalty_ratio(True)),
            own.customers(shared=True).select("month", "publication", "login_state", "loyalty_segment", "customers"),
            R.customer_weight(own.customers(shared=True), "login_state"),
            R.customer_weight(own.customers(shared=True), "loyalty_segment"))
        stored = {n: store.write(df, n) for n, df in tables.items()}
        _GIVEN[key] = Chain(own.inp.with_tables(**stored), Stager(spark))
    return _GIVEN[key]


def given_query(name: str):
    def register(fn: Callable[[Chain], DataFrame]):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return present(fn(given_chain_for(spark, data_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return register


def query(name: str):
    def register(fn: Callable[[Chain], DataFrame]):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return present(fn(chain_for(spark, data_dir)))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return register


def events_query(name: str):
    def register(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return present(fn(Tables(spark, data_dir).events))
        run.__name__ = name
        _REGISTRY[name] = run
        return fn
    return register


_LANDED: dict[tuple[str, str], DataFrame] = {}


def landed_for(spark: SparkSession, data_dir: str) -> DataFrame:
    """The landed ad-server rows of ``data_dir``, stored once per application
    like the model inputs: reports read them, they do not make them."""
    key = (spark.sparkContext.applicationId, data_dir.rstrip("/"))
    if key not in _LANDED:
        _LANDED[key] = Stager(spark).write(adserver.landed_rows(Tables(spark, data_dir).events), "landed_rows")
    return _LANDED[key]


def landed_query(name: str):
    def register(fn: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return present(fn(landed_for(spark, data_dir)))
        run.__name__ = name
        _REGISTRY[name] = run
        return fn
    return register


_DELIVERED: dict[tuple[str, str], DataFrame] = {}


def delivered_for(spark: SparkSession, data_dir: str) -> DataFrame:
    """The table that the stream makes of two deliveries of ``data_dir``: all
    landed rows, then a correction of some days. Made once per application."""
    key = (spark.sparkContext.applicationId, data_dir.rstrip("/"))
    if key not in _DELIVERED:
        store, landed = Stager(spark), landed_for(spark, data_dir).drop("event_id")
        for name, rows in (("1-all", landed), ("2-corrected", adserver.corrected(landed))):
            rows.write.option("header", True).csv(store.path(f"deliveries/{name}"))
        ingest_landed(spark, store.path("deliveries/*"), AD_DEFINITION, store.path("table"), store.path("checkpoint"),
                      kinds=AD_KINDS).awaitTermination()
        _DELIVERED[key] = LandedTable(spark, store.path("table"), AD_DEFINITION, AD_KINDS).table()
    return _DELIVERED[key]


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- column rules ---------------------------------------------------------------

@query("month_from_yearmonth")
def q_month_from_yearmonth(ch):
    return ch.inp.ga4_export.select("yearMonth", FC.month_from_yearmonth("yearMonth").alias("month"))


@query("month_from_yyyy_mm")
def q_month_from_dash(ch):
    return ch.inp.ga4_device_aggregate.select(F.col("month").alias("month_text"),
                                           FC.month_from_dash("month").alias("month"))


@query("device_normalise")
def q_device(ch):
    return ch.inp.user_metrics_monthly.select(
        "requestSource", FC.normalise_device("requestSource", ch.inp.device_prefix).alias("device"))


@query("login_state_classify")
def q_classify(ch):
    return ch.inp.ga4_export.select(
        "yearMonth", "customUseruser_status", "customUserproduct_name", "customEventrequestSource",
        FC.classify_login_state("customUseruser_status", "customUserproduct_name").alias("login_state"))


# --- audience ----------------------------------------------------------------

@query("clean_ga4")
def q_clean_ga4(ch):
    return ch.clean_export()


@query("clean_ga4_export_device")
def q_clean_ga4_export_device(ch):
    return ch.clean_export(by_device=True)


@query("clean_ga4_device_aggregate")
def q_clean_ga4_device_aggregate(ch):
    return ch.clean_device_aggregate()


@query("clean_ga4_device_enriched")
def q_enriched(ch):
    return ch.enriched()


@query("no_consent_uplift_legacy")
def q_uplift_legacy(ch):
    return ch.legacy_states()


@query("no_consent_uplift_legacy_device")
def q_uplift_legacy_device(ch):
    return ch.legacy_states(True)


@query("no_consent_uplift")
def q_uplift(ch):
    return ch.audience_states()


@query("no_consent_uplift_device")
def q_uplift_device(ch):
    return ch.audience_states(True)


@query("user_status_of_login_state")
def q_user_status_of(ch):
    return ch.audience_states().select("month", "publication", "login_state",
                                          FC.user_status_of("login_state").alias("user_status"))


@query("consent_status")
def q_consent_status(ch):
    return ch.audience_states().select("month", "publication", "login_state",
                                          FC.consent_status("login_state").alias("consent_status"))


@query("loyalty_split")
def q_split(ch):
    return A.loyalty_split(ch.audience_states(), ch.loyalty_ratio())


@query("loyalty_split_device")
def q_split_device(ch):
    return A.loyalty_split(ch.audience_states(True), ch.loyalty_ratio(True), True)


@query("audience_lifetime")
def q_lifetime(ch):
    return ch.audience_cells()


@query("audience_lifetime_device")
def q_lifetime_device(ch):
    return ch.audience_cells(True)


@query("loyalty_split_report")
def q_split_report(ch):
    return ch.loyalty_split_report()


@query("pageviews_by_cell")
def q_pageviews(ch):
    return A.pageviews_by_cell(ch.inp.manual_pageviews)


@query("pageviews_by_login_state")
def q_pageviews_ls(ch):
    return A.pageviews_by_cell(ch.inp.manual_pageviews, per_segment=False)


# --- customers -----------------------------------------------------------------

@query("user_metrics_base")
def q_base(ch):
    return ch.base()


@query("user_metrics_base_device")
def q_base_device(ch):
    return ch.base(True)


@query("total_users")
def q_total_users(ch):
    return C.total_users(ch.base())


@query("total_users_device")
def q_total_users_device(ch):
    return C.total_users(ch.base(True), True)


@query("loyalty_ratio")
def q_k1(ch):
    return ch.loyalty_ratio()


@query("loyalty_ratio_device_scope")
def q_k2(ch):
    return ch.loyalty_ratio(True)


@query("rus_ratio")
def q_reach(ch):
    return C.reach_ratio(ch.inp.manual_monthly, ch.base())


@query("ground_truth_customers")
def q_gt(ch):
    return ch.ground_truth()


@query("ground_truth_customers_device")
def q_gt_device(ch):
    return ch.ground_truth(True)


@query("subscriber_mix")
def q_mix(ch):
    return C.subscriber_mix(ch.inp.manual_monthly)


@query("logged_in_ratio")
def q_li(ch):
    return C.logged_in_ratio(ch.base())


@query("logged_in_ratio_device")
def q_li_device(ch):
    return C.logged_in_ratio(ch.base(True), True)


@query("subscribed_ratio")
def q_sr(ch):
    return C.subscribed_ratio(ch.base())


@query("subscribed_ratio_device")
def q_sr_device(ch):
    return C.subscribed_ratio(ch.base(True), True)


@query("no_consent_customers_legacy")
def q_nc_legacy(ch):
    return ch.customers_legacy()


@query("no_consent_customers")
def q_nc(ch):
    return C.no_consent_customers(ch.ground_truth(), ch.inp.manual_monthly, "ratio", ch.loyalty_ratio())


@query("no_consent_customers_device")
def q_nc_device(ch):
    return C.no_consent_customers(ch.ground_truth(True), ch.inp.manual_monthly, "plain", by_device=True)


@query("logged_in_customers")
def q_li_customers(ch):
    return C.logged_in_customers(C.logged_in_ratio(ch.base()), ch.loyalty_ratio(), ch.inp.manual_monthly)


@query("logged_in_customers_device")
def q_li_customers_device(ch):
    return C.logged_in_customers(C.logged_in_ratio(ch.base(True), True), ch.loyalty_ratio(True),
                                 ch.inp.manual_monthly, True)


@query("subscription_customers")
def q_sub_customers(ch):
    return C.subscription_customers(C.subscribed_ratio(ch.base()), ch.loyalty_ratio(), ch.inp.manual_monthly)


@query("subscription_customers_device")
def q_sub_customers_device(ch):
    return C.subscription_customers(C.subscribed_ratio(ch.base(True), True), ch.loyalty_ratio(True),
                                    ch.inp.manual_monthly, True)


@query("customers")
def q_k3(ch):
    return ch.customers()


@query("customers_device_scope")
def q_k4(ch):
    return ch.customers(True)


@query("customers_by_cell")
def q_customers_by_cell(ch):
    return C.customers_by_cell(ch.customers())


@query("customers_by_cell_device")
def q_customers_by_cell_device(ch):
    return C.customers_by_cell(ch.customers(True), True)


# --- value ---------------------------------------------------------------------

@query("views_per_user_plain")
def q_vpu_plain(ch):
    adv = ch.legacy_advertising()
    return adv.select("month", "publication", "login_state", "loyalty_segment", "views_per_user")


@query("views_per_user_override")
def q_vpu_override(ch):
    adv = ch.advertising()
    return adv.select("month", "publication", "login_state", "loyalty_segment", "views_per_user")


@query("views_per_user_zero_guard")
def q_vpu_guard(ch):
    adv = ch.advertising(True)
    return adv.select("month", "publication", "device", "login_state", "loyalty_segment", "views_per_user")


@query("advertising_value")
def q_adv(ch):
    return ch.advertising()


@query("advertising_value_device")
def q_adv_device(ch):
    return ch.advertising(True)


@query("advertising_v1")
def q_adv_v1(ch):
    return ch.advertising_v1()


@query("subscription_arpu")
def q_arpu(ch):
    return ch.arpu()


@query("subscription_arpu_device")
def q_arpu_device(ch):
    return ch.arpu(True)


@query("subscription_value")
def q_sub_value(ch):
    return ch.subscription()


@query("subscription_value_device")
def q_sub_value_device(ch):
    return ch.subscription(True)


@query("value_by_cell")
def q_k5(ch):
    return ch.value_by_cell()


@query("value_by_cell_device")
def q_k6(ch):
    return ch.value_by_cell(True)


# --- roll-ups --------------------------------------------------------------------

@query("customer_weight_login_state")
def q_w_ls(ch):
    return R.customer_weight(ch.customers(), "login_state")


@query("customer_weight_loyalty")
def q_w_loy(ch):
    return R.customer_weight(ch.customers(), "loyalty_segment")


@query("customer_weight_device_login_state")
def q_w_dls(ch):
    return R.customer_weight(ch.customers(True), "login_state", True)


@query("customer_weight_device_loyalty")
def q_w_dloy(ch):
    return R.customer_weight(ch.customers(True), "loyalty_segment", True)


@query("weighted_login_state")
def q_k7(ch):
    return ch.weighted("login_state")


@query("weighted_loyalty")
def q_k8(ch):
    return ch.weighted("loyalty_segment")


@query("weighted_device_login_state")
def q_k9(ch):
    return ch.weighted("login_state", True)


@query("weighted_device_loyalty")
def q_k10(ch):
    return ch.weighted("loyalty_segment", True)


@query("weighted_login_state_legacy")
def q_w_legacy_ls(ch):
    return ch.weighted_legacy("login_state")


@query("weighted_loyalty_legacy")
def q_w_legacy_loy(ch):
    return ch.weighted_legacy("loyalty_segment")


@given_query("loyalty_split_report_given")
def q_split_report_given(ch):
    """O43 with a given ratio table by device."""
    return ch.loyalty_split_report()


@given_query("weighted_login_state_given")
def q_w_given_ls(ch):
    """The earlier login-state model with given ratios, customers and weights."""
    return ch.weighted_legacy("login_state")


@given_query("weighted_loyalty_given")
def q_w_given_loy(ch):
    """The earlier loyalty model: its weights are another table."""
    return ch.weighted_legacy("loyalty_segment")


@query("total_tclv_login_state")
def q_k11(ch):
    return ch.total_tclv_login_state()


@query("total_tclv_login_state_loyalty")
def q_k12(ch):
    return ch.total_tclv_login_state_loyalty()


# --- reports -------------------------------------------------------------------------

@events_query("report")
def q_report(events):
    start, end = fixtures.events_window()
    return RP.run_report(events, WEB_DIMENSIONS, WEB_METRICS, start, end)


for _name, _text in WEB_FILTERS.items():
    @events_query(_name)
    def q_report_filter(events, text=_text):
        start, end = fixtures.events_window()
        return RP.run_report(events, WEB_DIMENSIONS, WEB_METRICS, start, end, text)


@events_query("report_filter_listed")
def q_report_filter_listed(events):
    """The filter as a list of the values that match, which the scan gets."""
    start, end = fixtures.events_window()
    return RP.run_report(events, WEB_DIMENSIONS, WEB_METRICS, start, end, WEB_FILTERS["report_filter"],
                         sources=RP.EVENT_SOURCES)


@events_query("report_users")
def q_report_users(events):
    """The report by device, user status and product, over a part of the days."""
    return RP.run_report(events, USER_DIMENSIONS, WEB_METRICS, *PART_OF_RANGE)


@events_query("report_users_all_days")
def q_report_users_all_days(events):
    """The same report over the whole events table."""
    start, end = fixtures.events_window()
    return RP.run_report(events, USER_DIMENSIONS, WEB_METRICS, start, end)


_ROLLUPS: dict[tuple[str, str], DailyRollup] = {}


def rollup_for(spark: SparkSession, data_dir: str) -> DailyRollup:
    """The daily roll-up of the events of ``data_dir``, made once per
    application; some days are refreshed after the first run."""
    key = (spark.sparkContext.applicationId, data_dir.rstrip("/"))
    if key not in _ROLLUPS:
        events = Tables(spark, data_dir).events
        daily = DailyRollup(spark, Stager(spark).path("daily"), [*WEB_DIMENSIONS, *USER_DIMENSIONS, "pagePath"],
                            buckets_for(spark, f"{data_dir.rstrip('/')}/events.parquet"))
        daily.refresh(events, *fixtures.events_window())
        daily.refresh(events, *PART_OF_RANGE)
        _ROLLUPS[key] = daily
    return _ROLLUPS[key]


def rollup_query(name: str):
    def register(fn: Callable[[DailyRollup], DataFrame]):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return present(fn(rollup_for(spark, data_dir)))
        run.__name__ = name
        _REGISTRY[name] = run
        return fn
    return register


@rollup_query("report_rollup")
def q_report_rollup(daily):
    return daily.report(WEB_DIMENSIONS, WEB_METRICS, *fixtures.events_window())


for _name, _text in WEB_FILTERS.items():
    @rollup_query(_name.replace("report", "report_rollup"))
    def q_report_rollup_filter(daily, text=_text):
        return daily.report(WEB_DIMENSIONS, WEB_METRICS, *fixtures.events_window(), text)


@rollup_query("report_rollup_users")
def q_report_rollup_users(daily):
    return daily.report(USER_DIMENSIONS, WEB_METRICS, *PART_OF_RANGE)


@rollup_query("report_rollup_users_all_days")
def q_report_rollup_users_all_days(daily):
    return daily.report(USER_DIMENSIONS, WEB_METRICS, *fixtures.events_window())


@landed_query("typed_value_parse")
def q_typed(landed):
    return RP.parse_landed(landed, AD_DEFINITION, AD_KINDS)


@landed_query("report_from_definition")
def q_report_definition(landed):
    start, end = fixtures.events_window()
    return RP.report_from_definition(landed, AD_DEFINITION, start, end, AD_KINDS)


@landed_query("report_from_definition_range")
def q_report_definition_range(landed):
    return RP.report_from_definition(landed, AD_DEFINITION, *PART_OF_RANGE, AD_KINDS)


@landed_query("report_from_definition_no_date")
def q_report_definition_no_date(landed):
    """The range holds although the report has no date dimension."""
    spec = AD_DEFINITION | {"dimensions": [d for d in AD_DEFINITION["dimensions"] if d != "date"]}
    return RP.report_from_definition(landed, spec, *PART_OF_RANGE, AD_KINDS)


@landed_query("typed_value_rejects")
def q_typed_rejects(landed):
    """Rows of a bad export that cannot be read, with the reason."""
    out = RP.split_landed(adserver.with_faults(landed), AD_DEFINITION, AD_KINDS, ["event_id"])
    return out.filter("reason is not null").select("event_id", "reason")


@landed_query("typed_value_accepted")
def q_typed_accepted(landed):
    """The other rows, parsed as if there were no bad ones."""
    out = RP.split_landed(adserver.with_faults(landed), AD_DEFINITION, AD_KINDS, ["event_id"])
    return out.filter("reason is null").drop("reason")


def _report_from_deliveries(spark: SparkSession, data_dir: str) -> DataFrame:
    """The report of the streamed table after a correction of some days."""
    start, end = fixtures.events_window()
    return present(RP.report_from_table(delivered_for(spark, data_dir), AD_DEFINITION, start, end))


_REGISTRY["report_from_deliveries"] = _report_from_deliveries
