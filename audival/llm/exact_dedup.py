"""Exact dedup by skew-safe combining (DataFrame functions only).

Copies are combined in three steps, each grouping by digest *and* whole
normalised content, so different texts never merge: within each input task
(map-side), then per salt, then over the salts of a digest. A group of copies
holding a third of all rows is one row per input task before it is shuffled
and one row per salt before the last step.

Defined cases: a null text is the empty text; texts that are empty after
normalising are one group. Ties are broken by the smallest doc_id, a null
doc_id losing to any other; of rows that repeat a doc_id and its text exactly
one is kept. An empty table gives no rows. Other columns are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.llm.shared import WHITE, one_each, release, stages
from audival.plans.stage import Stager

#: Salts of one digest in the middle step.
SALTS = 16
#: One more than the largest id, and the room that ids take in a rank.
_IDS = Decimal(2**63)
_ROOM = Decimal(10**20)


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; null: empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in WHITE.decode():
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def _sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _order(points: Column, doc_id: Column) -> Column:
    """Points and id as one decimal, largest first: more code points, then the
    smaller id (a null id comes last)."""
    back = F.coalesce(F.lit(_IDS) - doc_id.cast("decimal(19,0)"), F.lit(0))
    scaled = points.cast("decimal(10,0)") * F.lit(_ROOM)
    return (scaled + back.cast("decimal(20,0)")).cast("decimal(38,0)")


def _points(text: Column) -> Column:
    return F.char_length(F.coalesce(text, F.lit("")))


def _marked(docs: DataFrame, id_col: str, text_col: str, store: Stager, salts: int = SALTS,
            digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """One row per row of ``docs``, numbered and stored: doc_id, keep_id,
    group_size, winner (of the group's best rank), digest, best, number."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", _points(F.col("text")).alias("points"),
                       normalised(F.col("text")).alias("content"))
    rows = rows.select("*", digest(F.col("content")).alias("digest"), _order(F.col("points"), F.col("doc_id")).alias("rank"))

    salted = (rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
              .groupBy("digest", "content", "salt")
              .agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("best")))
    merged = (salted.repartition("digest").groupBy("digest", "content")
              .agg(F.sum("n").alias("n"), F.max("best").alias("best")))
    # every content of a digest is in one partition now: no further shuffle
    by_digest = store.write(
        merged.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.sum("n").alias("n"),
                                     F.max("best").alias("best")), "digests")
    release(spark)  # the shuffled texts

    small = rows.select("doc_id", "rank", "digest", "content")
    clashing = by_digest.filter("contents > 1").select("digest")
    if clashing.isEmpty():  # proven by content: one digest is one text
        joined = small.drop("content").join(by_digest, "digest")
    else:
        mixed = store.write(small.join(clashing, "digest", "left_semi"), "mixed")
        texts = mixed.groupBy("digest", "content").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("best"))
        plain = small.drop("content").join(by_digest.filter("contents = 1"), "digest").drop("contents")
        joined = plain.unionByName(mixed.join(texts, ["digest", "content"]).drop("content"))
    # the last 20 digits hold 2**63 - doc_id (0: no id)
    back = (F.col("best") % F.lit(_ROOM)).cast("decimal(20,0)")
    keep = F.when(back > 0, (F.lit(_IDS) - back).cast("long"))
    return store.write(joined.select(
        "doc_id", keep.alias("keep_id"), F.col("n").alias("group_size"), (F.col("rank") == F.col("best")).alias("winner"),
        "digest", "best", F.monotonically_increasing_id().alias("number")), "marked")


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
                digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256. ``digest`` only routes; equality is decided on content."""
    marked = _marked(docs, id_col, text_col, stages(docs.sparkSession), salts, digest)
    # rows that repeat id and text tie for the win: the first number of them stays
    first = marked.filter("winner").groupBy("digest", "best").agg(F.min("number").alias("number"))
    out = marked.join(first.select("number", F.lit(True).alias("first")), "number", "left")
    return out.select("doc_id", "keep_id", "group_size", F.coalesce("first", F.lit(False)).alias("kept"),
                      F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, all columns as they
    are. Winners that tie in id and length are told apart by all columns."""
    store = stages(docs.sparkSession)
    marked = _marked(docs, id_col, text_col, store)
    keep = store.write(marked.filter("winner").groupBy(F.col("digest").alias("_digest"), F.col("best").alias("_rank"))
                       .agg(F.count(F.lit(1)).alias("ties")), "keep")
    release(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"), _sha256(normalised(F.col(text_col))).alias("_digest"),
                       _order(_points(F.col(text_col)), F.col(id_col).cast("long")).alias("_rank"))
    return one_each(rows, keep, ["_digest", "_rank"])
