"""A stored daily roll-up of an event table, from which listed reports are
aggregates without a shuffle on users.

A row is (dimensions, user, day) with its events, views and whether the user
signed up; distinct users, new users and sessions of any report whose
dimensions are among the stored ones follow from it exactly. Rows are bucketed
by user, so combining a user's rows by day and the days by user needs no
exchange; only the last aggregate, one row per task and dimension values,
moves. Rows without a user only add up, so they are spread over the buckets.

``refresh`` computes a range of days into a run of its own and then names it in
the ledger: a run that fails is never read, a day is always read from the last
run that covers it (a day that has lost all its rows included), and a report
over days that no run covers is an error. One writer at a time.

A filter on a dimension is evaluated on the dimension's values, which each run
stores, and those that match go to the scan as a list (O29); where more than
``most_values`` match, the plain filter is used.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from audival.functions.filters import MOST_VALUES, dimension_filter, matching_values, parse_filter
from audival.operators.report import (EVENT_DIMENSIONS, EVENT_METRICS, combine_users, daily_rows, date_range,
                                      resolve)

_LEDGER = "seq long, run string, first date, last date"


def buckets_for(spark: SparkSession, path: str, per_bucket: int = 64 << 20, least: int = 8) -> int:
    """Buckets of a roll-up of the events under ``path``, by their size in files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    length = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return max(least, -(-length // per_bucket))


class DailyRollup:
    """The roll-up below ``path``. ``dimensions`` are stored besides the day
    (``date`` is always there). ``buckets`` is part of the folder's name, as
    files can only be read by the number of buckets they were written with."""

    def __init__(self, spark: SparkSession, path: str, dimensions: list[str], buckets: int,
                 dimension_defs: Mapping = EVENT_DIMENSIONS, most_values: int = MOST_VALUES):
        self.spark, self.defs, self.most, self.buckets = spark, dimension_defs, most_values, buckets
        self.dimensions = [d for d in dimensions if d.lower() != "date"]
        self.root = f"{path.rstrip('/')}/buckets-{buckets}"
        self.table, self.seen = f"daily_{uuid.uuid4().hex}", None

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _ledger(self) -> DataFrame:
        path, fs = self._path("ledger")
        if not fs.exists(path):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).parquet(f"{self.root}/ledger")

    def _create(self, schema) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({cols}) USING parquet PARTITIONED BY (_run, _day) "
                       f"CLUSTERED BY (_user) INTO {self.buckets} BUCKETS LOCATION '{self.root}/rows'")

    # ---------------------------------------------------------------- writing

    def refresh(self, events: DataFrame, start: str, end: str, date_col: str = "ts") -> str:
        """Compute the days in [start, end] anew; returns the name of the run."""
        seq = 1 + (self._ledger().agg(F.max("seq")).first()[0] or 0)
        run = f"{seq}-{uuid.uuid4().hex}"
        rows = events.filter(date_range(events, date_col, start, end)).withColumns(
            {f"_d{i}": resolve(d, self.defs, events.columns)() for i, d in enumerate(self.dimensions)})
        named = [f"_d{i}" for i in range(len(self.dimensions))]
        rows = daily_rows(rows, named, date_col)
        spread = F.xxhash64("_day", *named).cast("string")
        rows = rows.select(*[F.col(n).alias(d) for n, d in zip(named, self.dimensions)], "user_id", "_events", "_views",
                           "_signed", F.coalesce(F.col("user_id").cast("string"), spread).alias("_user"),
                           F.lit(run).alias("_run"), "_day")
        self._create(rows.schema)
        rows.repartition(self.buckets, "_user").write.insertInto(self.table)
        if self.dimensions:
            # the values of every dimension, off the rows just stored
            stored = self.spark.table(self.table).filter(F.col("_run") == run)
            pairs = [F.struct(F.lit(d).alias("dimension"), F.col(f"`{d}`").cast("string").alias("value"))
                     for d in self.dimensions]
            values = stored.select(F.explode(F.array(*pairs)).alias("v")).select("v.*").distinct()
            values.write.mode("overwrite").parquet(f"{self.root}/values/_run={run}")
        entry = self.spark.sql("SELECT CAST(:seq AS LONG) seq, :run run, CAST(:first AS DATE) first, "
                               "CAST(:last AS DATE) last",
                               {"seq": seq, "run": run, "first": start, "last": end})
        entry.write.mode("append").parquet(f"{self.root}/ledger")
        return run

    def expire(self) -> int:
        """Remove runs of which no day is read any more, and runs that failed.
        To be called while neither a refresh nor a report runs."""
        ledger = self._ledger()
        span = ledger.agg(F.min("first"), F.max("last")).first()
        held = {r["run"] for r in self._days(*span)} if span[0] else set()
        gone = set()
        for part in ("rows", "values"):
            path, fs = self._path(part)
            for entry in fs.listStatus(path) if fs.exists(path) else []:
                name = entry.getPath().getName()
                if name.startswith("_run=") and name[5:] not in held:
                    fs.delete(entry.getPath(), True)
                    gone.add(name[5:])
        self.seen = None
        return len(gone)

    # ---------------------------------------------------------------- reading

    def _days(self, start, end) -> list:
        """(run, first, last) stretches of days in [start, end], each day with
        the last run that covers it: at most one row per day."""
        first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
        days = (self._ledger().filter((F.col("first") <= last) & (F.col("last") >= first))
                .select("seq", "run", F.explode(F.sequence(F.greatest("first", first), F.least("last", last))).alias("day"))
                .groupBy("day").agg(F.max_by("run", "seq").alias("run")))
        stretch = F.date_sub("day", F.row_number().over(Window.partitionBy("run").orderBy("day")))
        return (days.select("run", "day", stretch.alias("stretch")).groupBy("run", "stretch")
                .agg(F.min("day").alias("first"), F.max("day").alias("last"), F.count(F.lit(1)).alias("days")).collect())

    def rows(self, start: str, end: str) -> tuple[DataFrame, list[str]]:
        """The stored rows of the days in [start, end] and the runs they are in."""
        held = self._days(start, end)
        wanted = self.spark.sql("SELECT datediff(CAST(:e AS DATE), CAST(:s AS DATE)) + 1", {"s": start, "e": end}).first()[0]
        if sum(r["days"] for r in held) != max(wanted, 0):
            raise ValueError(f"the roll-up has not all days from {start} to {end}")
        if not held:
            held = [{"run": "", "first": start, "last": start}]
        if not self.spark.catalog.tableExists(self.table):
            stored = self.spark.read.parquet(f"{self.root}/rows")
            self._create(stored.withColumns({"_run": F.lit(""), "_day": F.col("_day").cast("date")}).select(
                *[c for c in stored.columns if c not in ("_run", "_day")], F.lit("").alias("_run"), "_day").schema)
        runs = sorted({r["run"] for r in held})
        if self.seen != runs:  # folders of runs that another session has written
            self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
            self.seen = runs
        parts = [(F.col("_run") == r["run"]) & F.col("_day").between(F.lit(r["first"]).cast("date"), F.lit(r["last"]).cast("date"))
                 for r in held]
        return self.spark.table(self.table).filter(reduce(or_, parts)), runs

    def _stored(self, name: str) -> Column:
        if name.lower() == "date":
            return F.col("_day")
        for d in self.dimensions:
            if d.lower() == name.lower():
                return F.col(f"`{d}`")
        raise KeyError(f"not a dimension of the roll-up: {name}")

    def _filter(self, text: str, runs: list[str], case_sensitive: bool) -> Column:
        field = parse_filter(text)[0]
        column, plain = self._stored(field), dimension_filter(text, self._stored, case_sensitive)
        if field.lower() == "date":
            return plain
        values = self.spark.read.parquet(*[f"{self.root}/values/_run={r}" for r in runs]).filter(
            F.lower("dimension") == field.lower())
        known = matching_values(values, "value", dimension_filter(text, lambda _: F.col("value"), case_sensitive), self.most)
        return plain if known is None else column.cast("string").isin(known)

    def report(self, dimensions: list[str], metrics: list[str], start: str, end: str,
               dimension_filter_text: str | None = None, case_sensitive: bool = False) -> DataFrame:
        """O28 and O29 off the roll-up: the same rows as ``run_report`` over
        the events. Dimensions and the filter's field must be stored ones."""
        rows, runs = self.rows(start, end)
        if dimension_filter_text:
            rows = rows.filter(self._filter(dimension_filter_text, runs, case_sensitive))
        mets = [resolve(m, EVENT_METRICS, [])().alias(m) for m in metrics]
        named = [f"_d{i}" for i in range(len(dimensions))]
        rows = rows.withColumns({n: self._stored(d) for n, d in zip(named, dimensions)})
        by_day = rows.groupBy(*named, "_user", "user_id", "_day").agg(
            F.sum("_events").alias("_events"), F.sum("_views").alias("_views"), F.max("_signed").alias("_signed"))
        users = combine_users(by_day, [*named, "_user"])
        out = users.groupBy(*named).agg(*mets) if named else users.agg(*mets)
        return out.select(*[F.col(n).alias(d) for n, d in zip(named, dimensions)], *[F.col(f"`{m}`") for m in metrics])
