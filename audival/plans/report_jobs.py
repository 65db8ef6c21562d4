"""The two report extracts as Spark jobs: a web-analytics report over an
event table written as CSV (K13), and a definition-driven report over landed
ad-server rows written as gzip CSV (K14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from audival.operators.report import load_definition, report_from_definition, report_from_table, run_report
from audival.plans.sinks import write_report_csv, write_report_file


def _write(report: DataFrame, path: str, gzip: bool) -> None:
    """One file where the path names one, else a folder of parts."""
    one = path.endswith(".csv.gz" if gzip else ".csv")
    (write_report_file if one else write_report_csv)(report, path, gzip)


def web_report(spark: SparkSession, events_path: str, dimensions: list[str], metrics: list[str],
               start: str, end: str, out_path: str, dimension_filter: str | None = None) -> DataFrame:
    """Dimensions x metrics over [start, end], optional ``"field op value"``
    filter; CSV with a header of dimensions then metrics: one file if ``out_path``
    ends in ``.csv``, else a folder of parts."""
    report = run_report(spark.read.parquet(events_path), dimensions, metrics, start, end, dimension_filter)
    _write(report, out_path, gzip=False)
    return spark.read.option("header", True).csv(out_path)


def adserver_report(spark: SparkSession, landed_path: str, definition: str | dict, start: str, end: str,
                    out_path: str, landed_format: str = "parquet") -> DataFrame:
    """Report of a JSON definition (text, path or dict); gzip CSV with the
    definition's header: one file if ``out_path`` ends in ``.csv.gz``, else a
    folder of parts. ``landed_format``: ``parquet`` or ``csv`` for rows of
    typed text, ``typed`` for the parsed table that the stream stores."""
    spec = load_definition(definition, spark) if isinstance(definition, str) else definition
    if landed_format == "typed":
        report = report_from_table(spark.read.parquet(landed_path), spec, start, end)
    else:
        landed = spark.read.option("header", True).format(landed_format).load(landed_path)
        report = report_from_definition(landed, spec, start, end)
    _write(report, out_path, gzip=True)
    return spark.read.option("header", True).csv(out_path)
