"""Landed report rows as a stream: report files dropped into a folder are
picked up as they arrive and their typed values parsed (O30) into a table
partitioned by day, which the batch report (O31, ``report_from_table``) reads.
This replaces waiting on a remote report; the file source tracks in the
checkpoint which files it has read.

Files come in deliveries: the files of one folder below the source, or each
file (``delivery="file"``), in the order of their names. The last delivery that
has rows of a day is that day: its rows replace those of earlier ones, and an
earlier delivery that arrives late changes nothing. A delivery may be spread
over several micro-batches.

Each micro-batch is stored, checked, merged and published in this order, and
each step overwrites what a killed attempt at the same step left:

1. rows are read by the header of their file, values parsed, and everything
   stored once with the reason why a row cannot be read, if it cannot;
2. more rejects than ``max_reject_share`` end the stream before anything is
   published; otherwise they are written to the reject table;
3. the days of the batch are merged with what the table has of the same
   deliveries (but for the files of this batch, so that a replay is no second
   copy) and stored;
4. those days, and only those, are overwritten in the table;
5. one file of the ledger says that the batch is done; a batch that it names is
   not done again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from audival.operators.report import check_rejects, split_landed, typed_columns
from audival.plans.stage import Stager

#: Where a row of the table came from.
DELIVERY, FILE = "_delivery", "_file"
#: Columns a file may have besides those of the definition.
SPARE = 32


def landed_names(definition: Mapping) -> list[str]:
    names = list(definition.get("dimensions", [])) + list(definition.get("metrics", []))
    return names if "date" in [n.lower() for n in names] else ["date", *names]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class LandedTable:
    """The table of one report definition, with its ledger and rejects in
    folders that readers of the table do not see."""

    def __init__(self, spark: SparkSession, path: str, definition: Mapping, kinds: Mapping[str, str] | None = None,
                 max_reject_share: float = 0.01, delivery: str = "folder"):
        if delivery not in ("folder", "file"):
            raise ValueError(f"a delivery is a folder or a file, not {delivery!r}")
        self.spark, self.path = spark, path.rstrip("/")
        self.definition, self.kinds = definition, kinds
        self.max_reject_share, self.delivery = max_reject_share, delivery
        self.names = landed_names(definition)
        self.day = next(n for n in self.names if n.lower() == "date")
        types = {out: to for out, (_, to) in typed_columns(self.names, definition, kinds).items()}
        self.schema = ", ".join(f"`{n}` {types[n]}" for n in self.names if n != self.day)
        self.schema += f", {DELIVERY} string, {FILE} string, `{self.day}` date"

    # ------------------------------------------------------------ reading

    def table(self) -> DataFrame:
        """What is published: the typed columns, where rows are from, and the day."""
        if not _exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def rejects(self) -> DataFrame:
        """Rows that could not be read: stream, batch, delivery, file, the row
        as text by position, and the reason."""
        schema = f"{DELIVERY} string, {FILE} string, row string, reason string, stream string, batch long"
        path = f"{self.path}/_rejects"
        return self.spark.read.schema(schema).parquet(path) if _exists(self.spark, path) else (
            self.spark.createDataFrame([], schema))

    def ledger(self) -> DataFrame:
        """Done batches: their deliveries and days, with rows and rejects."""
        schema = f"{DELIVERY} string, day date, rows long, rejected long, stream string, batch long"
        path = f"{self.path}/_ledger"
        return self.spark.read.schema(schema).parquet(path) if _exists(self.spark, path) else (
            self.spark.createDataFrame([], schema))

    # ------------------------------------------------------------ one batch

    def positions(self) -> StructType:
        """Columns of a file by position, as its header is a row like others."""
        return StructType([StructField(f"c{i}", StringType()) for i in range(len(self.names) + SPARE)])

    def _rows(self, raw: DataFrame, store: Stager) -> DataFrame:
        """The rows of files as (delivery, file, cells, missing, names...), by
        the names in each file's header; ``missing`` names those that it lacks
        and is null where there is no header."""
        lower = [n.lower() for n in self.names]
        spots = [F.col(f"c{i}") for i in range(len(self.names) + SPARE)]
        file = F.col("_metadata.file_path")
        place = F.substring_index(file, "/", -1)  # no pattern: it would be tried from every place of the path, on every row
        if self.delivery == "folder":
            place = F.substring_index(F.substring_index(file, "/", -2), "/", 1)
        raw = raw.filter(F.coalesce(*spots).isNotNull()).select(
            place.alias(DELIVERY), file.alias(FILE), F.col("c0").alias("first"), F.array(*spots).alias("cells"))
        # a value is "kind: value", a header's cells are names; nearly all rows are told by their first cell
        is_header = ~F.contains(F.coalesce("first", F.lit("")), F.lit(":")) & F.exists(
            "cells", lambda c: F.lower(F.trim(c)).isin(lower))
        # one row per file, however often it repeats the header: stored, so that Spark knows how small it is and
        # the rows stay where they are, whatever the size of their file
        headers = raw.filter(is_header).groupBy(F.col(FILE)).agg(F.min(F.transform(
            "cells", lambda c: F.lower(F.trim(c)))).alias("header"))
        headers = store.write(headers.select(
            FILE, F.array_join(F.array_except(F.array(*map(F.lit, lower)), "header"), ", ").alias("missing"),
            *[(F.array_position("header", n).cast("int") - 1).alias(f"at{i}") for i, n in enumerate(lower)]), "headers")
        rows = raw.filter(~F.coalesce(is_header, F.lit(False))).join(headers, FILE, "left")
        return rows.select(DELIVERY, FILE, "cells", "missing",
                           *[F.get("cells", F.col(f"at{i}")).alias(n) for i, n in enumerate(self.names)])

    def _tagged(self, raw: DataFrame, store: Stager) -> DataFrame:
        """Typed columns, where rows are from, and of rejects the reason and
        the row as text."""
        rows = split_landed(self._rows(raw, store), self.definition, self.kinds, [DELIVERY, FILE, "cells", "missing"],
                            "reason")
        reason = F.when(F.col("missing").isNull(), F.lit("the file has no header")).when(
            F.col("missing") != "", F.concat(F.lit("the file has no column "), F.col("missing"))).otherwise(
            F.coalesce("reason", F.when(F.col(self.day).isNull(), F.lit(f"{self.day}: missing"))))
        rows = rows.withColumn("reason", reason).withColumn("row", F.when(F.col("reason").isNotNull(), F.to_json("cells")))
        return rows.drop("cells", "missing")

    def _merged(self, good: DataFrame) -> DataFrame:
        """The days of a batch as they are after it."""
        days = good.groupBy(self.day).agg(F.max(DELIVERY).alias("last"))
        stored = self.table()
        # days are partitions: only theirs are read, and of them one column
        before = stored.join(days.select(self.day), self.day, "left_semi").groupBy(self.day).agg(
            F.max(DELIVERY).alias("stored"))
        now = days.join(before, self.day, "left").select(
            self.day, F.greatest("last", "stored").alias("now"), F.col("stored").alias("was"))
        # of a delivery that goes on, the files that are not in this batch stay
        going_on = now.filter("now = was").select(self.day, F.col("now").alias(DELIVERY))
        files = good.select(FILE).distinct()
        kept = stored.join(going_on, [self.day, DELIVERY], "left_semi").join(files, FILE, "left_anti")
        new = good.join(now.select(self.day, F.col("now").alias(DELIVERY)), [self.day, DELIVERY], "left_semi")
        return new.unionByName(kept)

    def take(self, raw: DataFrame, batch: int, stream: str) -> None:
        """One micro-batch of rows by position (``positions``)."""
        mine = (F.col("stream") == stream) & (F.col("batch") == batch)
        if not self.ledger().filter(mine).isEmpty():
            return
        store = Stager(self.spark)
        tagged = store.write(self._tagged(raw, store), "tagged")
        counts = store.write(tagged.groupBy(DELIVERY, F.col(self.day).alias("day")).agg(
            F.count(F.when(F.col("reason").isNull(), 1)).alias("rows"), F.count("reason").alias("rejected")), "counts")
        total = counts.agg(F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected")).first()
        rows, rejected = total["rows"] or 0, total["rejected"] or 0
        check_rejects(rows + rejected, rejected, self.max_reject_share, f"batch {batch}")
        self._overwrite(tagged.filter("reason is not null").select(
            DELIVERY, FILE, "row", "reason", F.lit(stream).alias("stream"), F.lit(batch).cast("long").alias("batch")),
            "_rejects", ["stream", "batch"])
        good = tagged.filter("reason is null").select(*self.names, DELIVERY, FILE)
        merged = store.write(self._merged(good), "merged")
        self._overwrite(merged, "", [self.day])
        done = counts.withColumns({"stream": F.lit(stream), "batch": F.lit(batch).cast("long")})
        if rows + rejected == 0:  # a batch without rows is done as well
            done = self.spark.createDataFrame([(None, None, 0, 0, stream, batch)], done.schema)
        self._overwrite(done.coalesce(1), "_ledger", ["stream", "batch"])
        store.discard()

    def _overwrite(self, df: DataFrame, folder: str, partitions: list[str]) -> None:
        """Replace the partitions that ``df`` has rows of, and no others."""
        path = f"{self.path}/{folder}".rstrip("/")
        df.repartition(*[F.col(p) for p in partitions], _spread(df)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def _spread(df: DataFrame, files: int = 8) -> Column:
    """Rows of one partition go to a few tasks, so a day with most of the rows
    is not one task's work and a day does not become a file per task."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files))


def ingest_landed(spark: SparkSession, source_dir: str, definition: Mapping, sink_dir: str,
                  checkpoint: str, available_now: bool = True, max_files_per_trigger: int = 1000,
                  kinds: Mapping[str, str] | None = None, max_reject_share: float = 0.01,
                  delivery: str = "folder") -> StreamingQuery:
    """Start the stream: CSV files with a header that names the definition's
    columns in any order, each value typed text. ``available_now`` processes
    what has landed and stops; otherwise the query keeps watching the folder. A
    backlog is taken in micro-batches of at most ``max_files_per_trigger``
    files, so one batch never has to hold all of it. ``kinds`` names the metrics
    that are whole numbers (``int_value``)."""
    table = LandedTable(spark, sink_dir, definition, kinds, max_reject_share, delivery)
    raw = (spark.readStream.schema(table.positions()).option("header", False)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(source_dir).select("*", "_metadata"))

    def take(batch: DataFrame, number: int) -> None:
        # the stream's id, from its checkpoint: a new checkpoint counts anew
        stream = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]
        table.take(batch, number, stream)

    writer = raw.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")
    return writer.start()
