"""Declarative reports: dimensions x metrics over an inclusive date range,
with an optional dimension filter; and reports driven by a JSON definition
over landed rows of typed values."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from audival.functions.filters import dimension_filter, matching_values, parse_filter
from audival.functions.typed import TYPES, parse_typed_columns, split_typed_columns

def _bucket() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


# Our definitions of the analytics names over an ``events`` table
# (event_id, ts, user_id, event_type, value, props); see FIXTURES.md.
EVENT_DIMENSIONS: dict[str, Callable[[], Column]] = {
    "date": lambda: F.to_date("ts"),
    "eventName": lambda: F.col("event_type"),
    "deviceCategory": lambda: F.when(_bucket() < 33, "desktop").when(_bucket() < 66, "mobile").otherwise("tablet"),
    "customUser:user_status": lambda: F.when(F.col("user_id").isNull(), "notLoggedIn")
    .when(F.col("event_type") == "purchase", "subscribed").otherwise("notSubscribed"),
    "customUser:product_name": lambda: F.when(F.col("event_type") == "purchase", F.when(
        F.col("value") < 50, "Monatsabo").otherwise("Jahresabo")).otherwise("(not set)"),
    "pagePath": lambda: F.concat(F.lit("/"), F.element_at(F.array(*map(F.lit, ("de", "fr", "it", "en"))),
                                                          F.coalesce(F.pmod(_bucket(), F.lit(4)), F.lit(0)) + 1),
                                 F.lit("/"), F.col("event_type")),
}
#: Metrics of an event table, as sums over users: a user's rows are first
#: combined by day, the days by user, and the users by dimension, so distinct
#: users and sessions are counted without copying rows.
EVENT_METRICS: dict[str, Callable[[], Column]] = {
    "totalUsers": lambda: F.count("user_id"),
    "newUsers": lambda: F.count(F.when(F.col("_signed"), F.col("user_id"))),
    "sessions": lambda: F.coalesce(F.sum(F.when(F.col("user_id").isNotNull(), F.col("_days"))), F.lit(0)),
    "screenPageViews": lambda: F.coalesce(F.sum("_views"), F.lit(0)),
    "eventCount": lambda: F.coalesce(F.sum("_events"), F.lit(0)),
}


#: Dimensions that are a column of the event table as it is.
EVENT_SOURCES = {"eventName": "event_type"}


def daily_rows(rows: DataFrame, dims: list[str], date_col: str = "ts") -> DataFrame:
    """One row per dimensions, user and day: events, views, whether signed up."""
    return rows.groupBy(*dims, "user_id", F.to_date(date_col).alias("_day")).agg(
        F.count(F.lit(1)).alias("_events"), F.count(F.when(F.col("event_type") == "view", 1)).alias("_views"),
        F.max(F.col("event_type") == "signup").alias("_signed"))


def combine_users(daily: DataFrame, dims: list[str]) -> DataFrame:
    """One row per dimensions and user, off the rows by day."""
    return daily.groupBy(*dims, "user_id").agg(
        F.sum("_events").alias("_events"), F.sum("_views").alias("_views"), F.max("_signed").alias("_signed"),
        F.count("_day").alias("_days"))


def resolve(name: str, registry: Mapping, columns: list[str]) -> Callable[[], Column]:
    for key, fn in registry.items():
        if key.lower() == name.lower():
            return fn
    for c in columns:
        if c.lower() == name.lower():
            return lambda c=c: F.col(c)
    raise KeyError(f"unknown report field: {name}")


def date_range(df: DataFrame, date_col: str, start: str, end: str) -> Column:
    """Rows whose day is in [start, end]. Besides the exact day test, the
    raw column gets the same range as plain bounds of its own type
    (``start <= ts < end + 1 day``), which the parquet scan can push down to
    skip row groups; the day test alone is a function of the column and
    cannot be pushed."""
    c = F.col(date_col)
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    kind = dict((f.name, f.dataType.typeName()) for f in df.schema.fields).get(date_col)
    day = F.to_date(c)
    exact = (day >= first) & (day <= last)
    if kind in ("timestamp", "timestamp_ntz"):
        lo = first.cast(kind)
        hi = F.date_add(last, 1).cast(kind)
        return (c >= lo) & (c < hi) & exact
    if kind == "date":
        return (c >= first) & (c <= last)
    return exact


def run_report(df: DataFrame, dimensions: list[str], metrics: list[str], start: str, end: str,
               dimension_filter_text: str | None = None, case_sensitive: bool = False,
               date_col: str = "ts", dimension_defs: Mapping = EVENT_DIMENSIONS,
               metric_defs: Mapping = EVENT_METRICS, sources: Mapping[str, str] | None = None) -> DataFrame:
    """Rows whose date is in [start, end] (inclusive), optionally
    filtered on a dimension (O29), grouped by the dimensions, one column per
    metric; columns are the dimensions then the metrics, as named. Metrics
    of other tables than events come as aggregates in ``metric_defs``. A filter
    on a dimension of ``sources`` (dimension: the column that it is) is first
    evaluated on the column's distinct values in the range, and those that
    match go to the scan as a list."""
    rows = df.filter(date_range(df, date_col, start, end))
    if dimension_filter_text:
        test = dimension_filter(dimension_filter_text, lambda f: resolve(f, dimension_defs, df.columns)(), case_sensitive)
        source = {k.lower(): c for k, c in (sources or {}).items()}.get(parse_filter(dimension_filter_text)[0].lower())
        known = matching_values(rows, source, test) if source else None
        rows = rows.filter(test if known is None else F.col(source).isin(known))
    mets = [resolve(m, metric_defs, [])().alias(m) for m in metrics]
    named = [f"_d{i}" for i in range(len(dimensions))]
    rows = rows.withColumns({n: resolve(d, dimension_defs, df.columns)() for n, d in zip(named, dimensions)})
    if metric_defs is EVENT_METRICS:
        rows = combine_users(daily_rows(rows, named, date_col), named)
    out = rows.groupBy(*named).agg(*mets) if named else rows.agg(*mets)
    return out.select(*[F.col(n).alias(d) for n, d in zip(named, dimensions)], *[F.col(f"`{m}`") for m in metrics])


def load_definition(text_or_path: str, spark: SparkSession | None = None) -> dict:
    """A report definition from JSON text or a JSON file path; with a session
    the path may be in any store that Spark reads."""
    if text_or_path.lstrip().startswith("{"):
        return json.loads(text_or_path)
    if spark is not None:
        return json.loads(spark.read.text(text_or_path, wholetext=True).first()["value"])
    with open(text_or_path, encoding="utf-8") as fh:
        return json.load(fh)


def metric_kinds(landed: DataFrame, definition: Mapping) -> dict[str, str]:
    """What each metric's values are (``int_value`` or ``double_value``), from
    the landed rows: whole numbers only if every value is one."""
    by_lower = {c.lower(): c for c in landed.columns}
    kind = lambda m: F.lower(F.trim(F.substring_index(F.col(by_lower[m.lower()]), ":", 1)))
    names = [m for m in definition.get("metrics", []) if m.lower() in by_lower]
    if not names:
        return {}
    row = landed.agg(*[F.max((kind(m) != "int_value").cast("int")).alias(m) for m in names]).first()
    return {m: "double_value" if row[m] else "int_value" for m in names}


def typed_columns(columns: list[str], definition: Mapping, kinds: Mapping[str, str] | None = None
                  ) -> dict[str, tuple[str, str]]:
    """``out: (column, type)`` of a definition over columns of typed text: the
    ``date`` (always there, as reports are cut by it) a DATE, metrics BIGINT or
    DOUBLE by their kind (``kinds``; a DOUBLE if not named). Names resolve
    case-insensitively; a column that is not there is an error."""
    by_lower = {c.lower(): c for c in columns}
    kinds = {k.lower(): v for k, v in (kinds or {}).items()}
    metrics = list(definition.get("metrics", []))
    names = list(definition.get("dimensions", [])) + metrics
    if "date" not in [n.lower() for n in names]:
        names = ["date", *names]
    wanted = {}
    for name in names:
        src = by_lower.get(name.lower())
        if src is None:
            raise KeyError(f"unknown report field: {name}")
        kind = "date" if name.lower() == "date" else (
            kinds.get(name.lower(), "double_value") if name in metrics else "string_value")
        wanted[name] = (src, TYPES[kind])
    return wanted


def parse_landed(df: DataFrame, definition: Mapping, kinds: Mapping[str, str] | None = None) -> DataFrame:
    """O30 over landed rows: a typed table of the definition's columns (see
    ``typed_columns``). A value that cannot be read is an error."""
    return parse_typed_columns(df, typed_columns(df.columns, definition, kinds))


def split_landed(df: DataFrame, definition: Mapping, kinds: Mapping[str, str] | None = None,
                 keep: list[str] | None = None, reason: str = "reason") -> DataFrame:
    """O30 without an end at the first bad value: the typed columns and
    ``reason``, null for good rows. What is left after a filter on it is what
    ``parse_landed`` gives for the good rows alone."""
    return split_typed_columns(df, typed_columns(df.columns, definition, kinds), keep or [], reason)


class TooManyRejects(ValueError):
    """More rows than allowed could not be read."""


def check_rejects(rows: int, rejected: int, max_share: float, what: str) -> None:
    if rejected > max_share * rows:
        raise TooManyRejects(f"{what}: {rejected} of {rows} rows cannot be read, at most {max_share:.2%} may be")


def report_from_table(typed: DataFrame, definition: Mapping, start: str, end: str) -> DataFrame:
    """O31 over a typed table (``parse_landed``, or what the stream stores):
    rows of the inclusive range, grouped by the definition's dimensions, the
    metrics summed in their own type (a whole-number overflow is an error).
    The range is a plain bound on the DATE column, so a table partitioned by
    day is read for those days only."""
    by_lower = {c.lower(): c for c in typed.columns}
    if "date" not in by_lower:
        raise KeyError("the report table has no date column")
    day = F.col(by_lower["date"])
    rows = typed.filter((day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))
    dims = [F.col(by_lower[d.lower()]).alias(d) for d in definition.get("dimensions", [])]
    sums = [F.sum(by_lower[m.lower()]).alias(m) for m in definition.get("metrics", [])]
    return rows.groupBy(*dims).agg(*sums) if dims else rows.agg(*sums)


def report_from_definition(landed: DataFrame, definition: Mapping, start: str, end: str,
                           kinds: Mapping[str, str] | None = None) -> DataFrame:
    """O30 then O31 straight from landed rows. Without ``kinds`` they are read
    off the rows first. The definition's date-range type, ad-unit view and
    report type are not used; there are no filters. Columns are the dimensions
    then the metrics, as named in the definition."""
    kinds = metric_kinds(landed, definition) if kinds is None else kinds
    return report_from_table(parse_landed(landed, definition, kinds), definition, start, end)
