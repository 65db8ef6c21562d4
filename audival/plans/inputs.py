"""The input tables of the models, bundled with their parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from audival.plans.stage import Stager, run_concurrently
from audival.sources import fixtures as fx
from audival.sources.schemas import conform
from audival.sources.tables import Tables

_LANDED: dict[tuple[str, str], Inputs] = {}

INPUT_NAMES = ("user_metrics_monthly", "ga4_export", "ga4_device_aggregate", "manual_monthly",
               "consent_rate", "rpm", "impressions_per_view", "subscription_arpu",
               "subscription_lifetime", "subscription_lifetime_device", "manual_pageviews")

OPTIONAL_NAMES = ("loyalty_ratio_legacy", "loyalty_ratio_legacy_device", "true_customer",
                  "customer_weight_login_state", "customer_weight_loyalty")


@dataclass
class Inputs:
    user_metrics_monthly: DataFrame
    ga4_export: DataFrame
    ga4_device_aggregate: DataFrame
    manual_monthly: DataFrame
    consent_rate: DataFrame
    rpm: DataFrame
    impressions_per_view: DataFrame
    subscription_arpu: DataFrame
    subscription_lifetime: DataFrame
    subscription_lifetime_device: DataFrame
    manual_pageviews: DataFrame
    # ready-made tables of the earlier models; the chain's own results if absent
    loyalty_ratio_legacy: DataFrame | None = None
    loyalty_ratio_legacy_device: DataFrame | None = None
    true_customer: DataFrame | None = None
    customer_weight_login_state: DataFrame | None = None  # a segment's weight in its login state
    customer_weight_loyalty: DataFrame | None = None  # a login state's weight in its segment
    publication: str = fx.PUBLICATION
    device_prefix: str = fx.DEVICE_PREFIX
    window: tuple[str, str] = field(default=fx.WINDOW)
    # the tables as stored, where they are files: what a change is known by
    sources: dict[str, DataFrame] = field(default_factory=dict)

    def source(self, name: str) -> DataFrame:
        return self.sources.get(name, getattr(self, name))

    @classmethod
    def derive(cls, spark: SparkSession, data_dir: str, facts: DataFrame | None = None,
               cube: DataFrame | None = None) -> Inputs:
        """Inputs derived lazily from the driver's tables by the fixture adapter."""
        f = facts if facts is not None else fx.order_facts(Tables(spark, data_dir))
        c = cube if cube is not None else fx.order_cube(f)
        manual = fx.manual_monthly(c)
        return cls(
            user_metrics_monthly=fx.user_metrics_monthly(c), ga4_export=fx.ga4_export(c),
            ga4_device_aggregate=fx.ga4_device_aggregate(c), manual_monthly=manual,
            consent_rate=fx.consent_rate(manual), rpm=fx.rpm(c),
            impressions_per_view=fx.impressions_per_view(c),
            subscription_arpu=fx.subscription_arpu(f),
            subscription_lifetime=fx.subscription_lifetime(c),
            subscription_lifetime_device=fx.subscription_lifetime(c, by_device=True),
            manual_pageviews=fx.manual_pageviews(c))

    @classmethod
    def land(cls, spark: SparkSession, data_dir: str, stager: Stager | None = None) -> Inputs:
        """Inputs derived from the driver's tables and stored as tables, the
        way the models find them in production. The per-order facts are
        stored first and read twice: once for the order cube (every input but
        one is a small aggregate of it) and once for the per-order
        subscription values."""
        stager = stager or Stager(spark)
        facts = stager.write(fx.order_facts(Tables(spark, data_dir)), "order_facts")
        cube = stager.write(fx.order_cube(facts), "order_cube")
        lazy = cls.derive(spark, data_dir, facts, cube)
        stored = run_concurrently({n: (lambda n=n: stager.write(getattr(lazy, n), n)) for n in INPUT_NAMES})
        return cls(**stored, publication=lazy.publication, device_prefix=lazy.device_prefix,
                   window=lazy.window)

    @classmethod
    def from_testdata(cls, spark: SparkSession, data_dir: str) -> Inputs:
        """Landed inputs of ``data_dir``, landed once per application."""
        key = (spark.sparkContext.applicationId, data_dir.rstrip("/"))
        if key not in _LANDED:
            _LANDED[key] = cls.land(spark, data_dir)
        return _LANDED[key]

    @classmethod
    def from_paths(cls, spark: SparkSession, paths: dict[str, str], **params) -> Inputs:
        """Inputs stored as parquet, one path per name in ``INPUT_NAMES`` and,
        if there, in ``OPTIONAL_NAMES``; typed by ``sources.schemas``."""
        names = [*INPUT_NAMES, *(n for n in OPTIONAL_NAMES if n in paths)]
        stored = {n: spark.read.parquet(paths[n]) for n in names}
        return cls(**{n: conform(df, n) for n, df in stored.items()}, sources=stored, **params)

    def with_tables(self, **tables: DataFrame) -> Inputs:
        values = {n: getattr(self, n) for n in INPUT_NAMES + OPTIONAL_NAMES}
        values.update(tables)
        sources = {n: df for n, df in self.sources.items() if n not in tables}
        return Inputs(**values, publication=self.publication, device_prefix=self.device_prefix,
                      window=self.window, sources=sources)
