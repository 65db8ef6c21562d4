"""Landed files as a stream: deliveries, replays, rejects and headers."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from audival.operators.report import TooManyRejects, report_from_definition, report_from_table
from audival.plans.queries import AD_DEFINITION, AD_KINDS, present
from audival.plans.stage import Stager
from audival.sources.adserver import landed_rows
from audival.streaming.landed import DELIVERY, FILE, LandedTable, ingest_landed

from paths import SMALL

DEFINITION = {"dimensions": ["date", "site"], "metrics": ["shown", "paid"]}
KINDS = {"shown": "int_value", "paid": "double_value"}
HEADER = ["date", "site", "shown", "paid"]


def rows_of(days, shown=1, sites=("a", "b")):
    return [(f"int_value: 202402{d:02d}", f'string_value: "{s}"', f"int_value: {shown}", f"double_value: {d}.5")
            for d in days for s in sites]


def land(folder, name, rows, header=HEADER, order=None):
    """One CSV file, its columns in ``order``."""
    os.makedirs(folder, exist_ok=True)
    order = order or range(len(HEADER))
    quote = lambda v: '"' + v.replace('"', '\\"') + '"'
    lines = ([",".join(header[i] for i in order)] if header else []) + [",".join(quote(r[i]) for i in order) for r in rows]
    with open(os.path.join(folder, f".{name}"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(os.path.join(folder, f".{name}"), os.path.join(folder, name))


@pytest.fixture()
def place(spark, scratch):
    class Place:
        src, sink, ckpt = (os.path.join(scratch, n) for n in ("src", "sink", "ckpt"))
        table = LandedTable(spark, sink, DEFINITION, KINDS)

        def land(self, delivery, name, rows, **more):
            land(os.path.join(self.src, delivery), name, rows, **more)

        def run(self, ckpt=None, **more):
            ingest_landed(spark, os.path.join(self.src, "*"), DEFINITION, self.sink, ckpt or self.ckpt, kinds=KINDS,
                          **more).awaitTermination()

        def report(self):
            got = report_from_table(self.table.table(), DEFINITION, "2024-02-01", "2024-02-29").collect()
            return sorted((r["date"].day, r["site"], r["shown"], r["paid"]) for r in got)
    return Place()


def clean(days, shown=1, sites=("a", "b")):
    return [(d, s, shown, d + 0.5) for d in days for s in sites]


def test_landed_files_are_ingested_once(spark, scratch):
    src, sink, ckpt = (os.path.join(scratch, n) for n in ("src", "sink", "ckpt"))
    ev = spark.read.parquet(f"{SMALL}/events.parquet")
    landed = landed_rows(ev).drop("event_id")
    landed.repartition(4).write.option("header", True).csv(os.path.join(src, "a"))
    q = ingest_landed(spark, os.path.join(src, "*"), AD_DEFINITION, sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    first = spark.read.parquet(sink).count()
    assert first == ev.count()
    assert len(q.recentProgress) >= 4  # one file per micro-batch, one delivery of them all
    q = ingest_landed(spark, os.path.join(src, "*"), AD_DEFINITION, sink, ckpt)  # nothing new
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == first
    parsed = spark.read.parquet(sink)
    assert set(parsed.columns) == set(AD_DEFINITION["dimensions"] + AD_DEFINITION["metrics"]) | {DELIVERY, FILE}
    assert dict(parsed.dtypes)["date"] == "date"
    # a later delivery of a part of the days: these days are its, the others stay
    part = landed.filter(F.substring("date", 12, 8).cast("int") >= 20240120)
    part.write.option("header", True).csv(os.path.join(src, "b"))
    q = ingest_landed(spark, os.path.join(src, "*"), AD_DEFINITION, sink, ckpt)
    q.awaitTermination()
    after = spark.read.parquet(sink)
    assert after.count() == first
    assert after.filter(F.col(DELIVERY) == "b").count() == part.count() == after.filter("date >= '2024-01-20'").count()


def test_report_over_the_streamed_table(spark, scratch):
    """The report of the stream's table is the report of the landed rows."""
    src, sink, ckpt = (os.path.join(scratch, n) for n in ("src", "sink", "ckpt"))
    rows = landed_rows(spark.read.parquet(f"{SMALL}/events.parquet")).drop("event_id")
    rows.write.option("header", True).csv(src)
    ingest_landed(spark, src, AD_DEFINITION, sink, ckpt, kinds=AD_KINDS).awaitTermination()
    typed = spark.read.parquet(sink)
    assert dict(typed.dtypes)["impressions"] == "bigint"
    for dims in (AD_DEFINITION["dimensions"], ["device_category"]):
        spec = AD_DEFINITION | {"dimensions": dims}
        # rounded: doubles are summed in another order
        got = present(report_from_table(typed, spec, "2024-01-05", "2024-01-11"))
        want = present(report_from_definition(rows, spec, "2024-01-05", "2024-01-11"))
        assert got.count() and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_delivery_landed_again_or_corrected_replaces_its_days(place):
    place.land("d1", "all.csv", rows_of(range(1, 8)))
    place.run()
    assert place.report() == clean(range(1, 8))
    place.land("d2", "all.csv", rows_of(range(1, 8)))  # the same again
    place.run()
    assert place.report() == clean(range(1, 8))
    place.land("d3", "fix.csv", rows_of([3, 4], shown=9))  # a correction of two days
    place.run()
    assert place.report() == sorted(clean([1, 2, 5, 6, 7]) + clean([3, 4], shown=9))
    place.land("d0", "late.csv", rows_of([4, 9], shown=5))  # older than what is there, but for a day of its own
    place.run()
    assert place.report() == sorted(clean([1, 2, 5, 6, 7]) + clean([3, 4], shown=9) + clean([9], shown=5))


def test_one_delivery_in_many_batches_and_many_in_one(place):
    for n in range(5):
        place.land("d1", f"part{n}.csv", rows_of([1, 2], sites=(f"s{n}",)))
    place.run(max_files_per_trigger=1)
    assert place.report() == clean([1, 2], sites=[f"s{n}" for n in range(5)])
    assert place.table.ledger().select("batch").distinct().count() == 5
    for n in range(3):
        place.land(f"e{n}", "one.csv", rows_of([2], shown=n + 10))
    place.run()
    assert place.report() == sorted(clean([1], sites=[f"s{n}" for n in range(5)]) + clean([2], shown=12))


@pytest.mark.parametrize("step", ["_rejects", "", "_ledger"])
def test_a_killed_batch_is_taken_again(place, monkeypatch, step):
    """Killed before or after each step: what comes of it is one clean delivery."""
    place.land("d1", "one.csv", rows_of([1, 2]))
    place.run()
    place.land("d1", "two.csv", rows_of([2, 3], sites=("c",)))
    plain = LandedTable._overwrite

    def killed(self, df, folder, partitions):
        if folder == step:
            if step == "":  # a part of the days is written when it dies
                plain(self, df.filter(F.col("date") == date(2024, 2, 2)), folder, partitions)
            raise RuntimeError("killed")
        plain(self, df, folder, partitions)
    with monkeypatch.context() as m:
        m.setattr(LandedTable, "_overwrite", killed)
        with pytest.raises(Exception, match="killed"):
            place.run()
    place.run()
    assert place.report() == sorted(clean([1, 2]) + clean([2, 3], sites=("c",)))
    assert place.table.ledger().select("batch").distinct().count() == 2


def test_a_batch_in_the_ledger_and_a_lost_checkpoint_change_nothing(place, spark, scratch):
    place.land("d1", "one.csv", rows_of([1, 2]))
    place.land("d2", "two.csv", rows_of([2, 3], shown=4))
    place.run()
    want = place.report()
    place.run(ckpt=os.path.join(scratch, "other"))  # everything is read anew under another stream's id
    assert place.report() == want == sorted(clean([1]) + clean([2, 3], shown=4))
    stream = place.table.ledger().first()["stream"]
    place.table.take(None, 0, stream)  # not looked at


def test_rejects(place, spark):
    good = rows_of(range(1, 29))
    bad = [("int_value: 20249901", 'string_value: "a"', "int_value: 1", "double_value: 1"),
           ("int_value: 20240203", 'string_value: "a"', "int_value: 1.5", "double_value: x"),
           ("int_value: 20240203", "no kind", "int_value: 1", "double_value: 1"),
           ("", "string_value: b", "int_value: 1", "double_value: 1")]
    place.land("d1", "rows.csv", good + bad)
    with pytest.raises(Exception, match="4 of 60 rows"):
        place.run(max_reject_share=0.05)
    assert place.table.table().isEmpty() and place.table.ledger().isEmpty() and place.table.rejects().isEmpty()
    place.run(max_reject_share=0.1)
    assert place.report() == clean(range(1, 29))
    got = place.table.rejects().collect()
    assert sorted(r["reason"] for r in got) == ["date: missing", "date: not a date", "shown: not a bigint; paid: not a double",
                                                "site: no kind"]
    assert all(r[FILE].endswith("/d1/rows.csv") and r[DELIVERY] == "d1" and "value" in r["row"] for r in got)
    assert place.table.ledger().agg(F.sum("rows"), F.sum("rejected")).first() == (56, 4)


def test_columns_by_the_files_own_header(place):
    place.land("d1", "a.csv", rows_of([1], sites=("a",)))
    place.land("d1", "b.csv", rows_of([1], sites=("b",)), order=[3, 1, 0, 2])  # another order
    place.land("d1", "c.csv", [(*r, "string_value: more") for r in rows_of([1], sites=("c",))],
               header=["DATE", "Site", "shown", "paid", "else"], order=[4, 0, 1, 2, 3])  # one more column
    place.run()
    assert place.report() == clean([1], sites=("a", "b", "c"))
    place.land("d2", "d.csv", rows_of([1]), order=[0, 1, 2])  # one less
    place.land("d3", "e.csv", rows_of([1]), header=None)
    place.run(max_reject_share=1.0)
    assert place.report() == clean([1], sites=("a", "b", "c"))
    assert {r["reason"] for r in place.table.rejects().collect()} == {"the file has no column paid",
                                                                      "the file has no header"}


def test_too_many_rejects_is_its_own_error():
    from audival.operators.report import check_rejects
    check_rejects(100, 1, 0.01, "x")
    with pytest.raises(TooManyRejects, match="2 of 100"):
        check_rejects(100, 2, 0.01, "x")
    check_rejects(0, 0, 0.0, "x")


def test_each_file_as_a_delivery(place):
    place.land("x", "2024-02-01.csv", rows_of([1, 2]))
    place.land("x", "2024-02-02.csv", rows_of([2, 3], shown=7))
    place.run(delivery="file")
    assert place.report() == sorted(clean([1]) + clean([2, 3], shown=7))


def test_rows_of_a_batch_stay_where_they_are(spark, place, scratch):
    """Headers are looked up file by file: no row moves to the task of its file, however large that is."""
    place.land("1", "a.csv", rows_of(range(1, 20)))
    place.land("1", "b.csv", rows_of(range(1, 9)), order=[1, 0, 2, 3], header=HEADER)
    raw = spark.read.schema(place.table.positions()).csv(os.path.join(place.src, "*")).select("*", "_metadata")
    tagged = place.table._tagged(raw, Stager(spark))
    assert "hashpartitioning" not in tagged._jdf.queryExecution().executedPlan().toString()
    assert {r["reason"] for r in tagged.collect()} == {None} and tagged.count() == 54
