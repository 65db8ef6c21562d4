"""One report file, byte for byte."""

import csv
import gzip
import io
import os

import pytest
from pyspark.sql import functions as F

from audival.plans import sinks
from audival.plans.files import Files
from audival.plans.report_jobs import web_report
from audival.plans.sinks import write_report_file

from paths import SMALL

SCHEMA = "`date` date, `user:name` string, n long, paid double"


def expected(names, rows):
    out = io.StringIO(newline="")
    writer = csv.writer(out)
    writer.writerow(names)
    writer.writerows([["" if v is None else v for v in r] for r in rows])
    return out.getvalue().encode()


def content(path, packed):
    with (gzip.open if packed else open)(path, "rb") as f:
        return f.read()


@pytest.mark.parametrize("packed", [False, True])
@pytest.mark.parametrize("size", [0, 7, 3000])
def test_bytes(spark, scratch, packed, size):
    path = os.path.join(scratch, "report.csv" + ".gz" * packed)
    odd = ["plain", 'say "x"', "a,b", "two\nlines", "cr\rhere", "", " space ", None, "Ärger 中"]
    df = spark.range(size).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("date"),
        F.element_at(F.array(*[F.lit(v).cast("string") for v in odd]), (F.col("id") % len(odd) + 1).cast("int")).alias("user:name"),
        (1000 - F.col("id")).alias("n"), (F.col("id") / 4).alias("paid")).repartition(9)
    write_report_file(df, path, gzip=packed)
    key = lambda r: tuple((v is not None, v) for v in r)
    rows = sorted((tuple(r) for r in df.collect()), key=key)
    assert content(path, packed) == expected(["date", "user:name", "n", "paid"], rows)
    assert sorted(n for n in os.listdir(scratch) if not n.endswith(".crc")) == [os.path.basename(path)]  # one file, nothing besides
    assert spark.read.option("header", True).option("multiLine", True).csv(path).count() == size


def test_one_empty_column_and_another_file_of_the_name(spark, scratch):
    path = os.path.join(scratch, "one.csv")
    write_report_file(spark.range(50).select(F.col("id").alias("a,b")), path)
    write_report_file(spark.sql("SELECT CAST(NULL AS STRING) AS x UNION ALL SELECT 'v'"), path)
    assert content(path, False) == expected(["x"], [[None], ["v"]]) == b'x\r\n""\r\nv\r\n'


def test_a_write_that_fails_leaves_the_file_before(spark, scratch, monkeypatch):
    path = os.path.join(scratch, "report.csv")
    write_report_file(spark.range(2), path)

    def lost(*args, **kwargs):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(sinks.Files, "append", lost)
        with pytest.raises(RuntimeError, match="lost"):
            write_report_file(spark.range(9), path)
    assert content(path, False) == b"id\r\n0\r\n1\r\n"
    assert [n for n in os.listdir(scratch) if "writing" in n] == []


def test_parts_are_joined_without_the_driver_reading_them(spark, scratch, monkeypatch):
    """Rows reach the file from several parts; the driver sees names alone."""
    joined = []
    plain = Files.append
    monkeypatch.setattr(Files, "append", lambda self, path, parts, **k: (joined.extend(parts), plain(self, path, parts, **k))[1])
    monkeypatch.setattr(Files, "read", lambda self, path: pytest.fail("read by the driver"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_report_file(spark.range(4000).repartition(6), os.path.join(scratch, "r.csv"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(joined) >= 4
    assert content(os.path.join(scratch, "r.csv"), False).count(b"\r\n") == 4001


def test_web_report_as_one_file(spark, scratch):
    path = os.path.join(scratch, "web.csv")
    out = web_report(spark, f"{SMALL}/events.parquet", ["date", "eventName"], ["eventCount"], "2024-01-01", "2024-01-31", path)
    lines = content(path, False).decode().split("\r\n")
    assert lines[0] == "date,eventName,eventCount" and lines[-1] == "" and lines[1:-1] == sorted(lines[1:-1])
    assert out.count() == len(lines) - 2 and os.path.isfile(path)
