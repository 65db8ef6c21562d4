"""Substring dedup with difference-cover anchors.

Two equal runs of 13 words start at some positions i and j. The set {0, 1, 3}
holds every difference modulo 7, so for some d < 7 both i + d and j + d lie in
it modulo 7, and the 7 words from there on are inside both runs. So only these
7-word anchors, at 3 of 7 positions, are hashed and compared over the corpus:

1. anchors found in two rows or more are shared (each run of texts is combined
   before anything is shuffled);
2. each document learns its shared anchors;
3. shared anchors are extended to the windows of 13 words around them, and the
   smallest doc_id of every such window is found the same way;
4. the words of windows that a smaller doc_id also has are removed.

Every step between is written to the shared folder, and a hot passage is one
row per run of texts before a shuffle; the joins back are skew joins.

Defined cases: null or short texts (under 13 words) have no window and stay as
they are; a null doc_id counts as the largest; repetition within one document
or under one doc_id removes nothing; rows that repeat a doc_id are cut by
their own texts. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.llm.shared import WHITE, WordBatch, grams, release, runs_of, separators, stages

#: Words of a window, the period, its difference cover, words of an anchor.
WINDOW, PERIOD, COVER = 13, 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text whose anchors make a partition.
PART_BYTES = 8 << 20
#: Parts in which windows are compared and texts are dealt to their anchors.
SLICES = 4
#: Parts in which anchors are looked up, a power of two.
LOOKUPS = 2
#: What tells rows apart: the doc_id and 128 bits of the text (zeros where ids
#: are unique).
ROW = ["doc_id", "mark", "more"]
_U64 = np.uint64
_LAST = 2**63 - 1


def _words(column: pa.Array) -> Iterator[tuple[int, WordBatch, np.ndarray]]:
    sep = separators(WHITE)
    for lo, _, data, offsets in runs_of(column):
        batch = WordBatch(data, offsets, sep)
        yield lo, batch, batch.hashes(False)


def _anchor_places(batch: WordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, text, place in the text) of the anchors of a run of texts;
    texts without a window have none."""
    size = np.diff(batch.first)
    many = np.where(size >= WINDOW, size - ANCHOR + 1, 0)
    text = np.repeat(np.arange(len(size)), many)
    place = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    chosen = np.isin(np.arange(PERIOD), COVER)[place % PERIOD]
    text, place = text[chosen], place[chosen]
    return batch.first[text] + place, text, place


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each run of texts, and whether one text (1) or more
    (2) of the run have them. A text is in one run, so an anchor of two texts
    adds up to two or more."""
    for got in batches:
        for lo, batch, words in _words(got.column("text")):
            at, text, _ = _anchor_places(batch)
            if not len(at):
                continue
            h = grams(words, ANCHOR, 11)[at]
            order = np.lexsort((text, h))
            h, text = h[order], text[order]
            first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            last = np.append(first[1:], len(h)) - 1
            yield from _cut([h[first].view(np.int64), np.where(text[first] < text[last], 2, 1).astype(np.int32)],
                            ["anchor", "n"])


def _cut(columns: list[np.ndarray], names: list[str], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[at:at + rows]) for c in columns], names=names)


def _placed_anchors(batches: Iterator[pa.RecordBatch], part: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The anchors whose lowest bits are ``part``."""
    for got in batches:
        owner = [got.column(c).to_numpy(zero_copy_only=False) for c in ROW]
        for lo, batch, words in _words(got.column("text")):
            at, text, place = _anchor_places(batch)
            if len(at):
                h = grams(words, ANCHOR, 11)[at]
                mine = h & _U64(parts - 1) == _U64(part)
                yield from _cut([h[mine].view(np.int64), *(c[lo + text[mine]] for c in owner),
                                 place[mine].astype(np.int32)], ["anchor", *ROW, "place"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows around the shared anchors of each text: two hashes of
    independent word hashes, 96 bits."""
    for got in batches:
        row = [got.column(c).to_numpy(zero_copy_only=False) for c in ROW]
        places = got.column("places")
        for lo, batch, words in _words(got.column("text")):
            starts, owner = [], []
            for d in range(len(batch.first) - 1):
                last = int(batch.first[d + 1] - batch.first[d]) - WINDOW
                p = np.asarray(places[lo + d].values, dtype=np.int64)
                s = np.unique((p[:, None] - np.arange(PERIOD)).ravel())
                s = s[(s >= 0) & (s <= last)]
                starts.append(s)
                owner.append(np.full(len(s), d))
            if not starts or not sum(map(len, starts)):
                continue
            s, d = np.concatenate(starts), np.concatenate(owner)
            at = batch.first[d] + s
            one, two = grams(words, WINDOW, 13)[at], grams(batch.hashes(False, 1), WINDOW, 17)[at]
            yield from _cut([one.view(np.int64), (two >> _U64(32)).astype(np.uint32).view(np.int32),
                             *(c[lo + d] for c in row), s.astype(np.int32)], ["window", "check", *ROW, "place"])


def _keep(words: list[bytes], places: np.ndarray) -> tuple[int, list[bytes]]:
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(gone, places, 1)
    np.add.at(gone, np.minimum(places + WINDOW, len(words)), -1)
    stay = np.cumsum(gone[:-1]) == 0
    return len(words) - int(stay.sum()), [w for w, s in zip(words, stay.tolist()) if s]


def _texts(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for at in range(0, got.num_rows, 512):
            part = got.slice(at, 512)
            n, removed, out = [], [], []
            for text, places in zip(part.column("text"), part.column("places")):
                words = text.as_py().split()
                gone = 0
                n.append(len(words))
                if places.is_valid:
                    gone, words = _keep(words, np.asarray(places.values, dtype=np.int64))
                removed.append(gone)
                kept = b" ".join(words)
                out.append(hashlib.sha256(kept).hexdigest() if digest else kept.decode())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(out, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"])


def repeated_places(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, more, places): starts of the windows to remove. ``docs`` has
    doc_id (never null), mark and more (hashes that tell texts of one doc_id
    apart) and text (bytes)."""
    spark, store = docs.sparkSession, stages(docs.sparkSession)
    # nearly all anchors are distinct: they are dealt as they are and counted
    # once, in partitions whose tables stay small
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))
    seen = docs.select("text").mapInArrow(_anchors, "anchor long, n int").repartition(parts, "anchor")
    shared = store.write(seen.groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "shared")
    release(spark)
    # what is looked up is distinct and small beside what looks: it is hashed, the other side is not sorted; a part of
    # the anchors at a time, so that only a part of the places is being shuffled
    found = []
    for k in range(LOOKUPS):
        placed = docs.mapInArrow(lambda it, k=k: _placed_anchors(it, k, LOOKUPS),
                                 "anchor long, doc_id long, mark long, more long, place int")
        mine = shared.filter(F.pmod("anchor", F.lit(LOOKUPS)) == k)
        found.append(store.write(placed.join(mine.hint("shuffle_hash"), "anchor").groupBy(*ROW).agg(
            F.collect_set("place").alias("places")), f"anchored-{k}"))  # at most the document's length, however many copies
        del placed
        release(spark)
    store.drop("shared")
    # a place has one anchor, so no place is in two parts; texts are dealt a part of the rows at a time
    found = reduce(DataFrame.unionByName, found).groupBy(*ROW).agg(F.flatten(F.collect_list("places")).alias("places"))
    windows = []
    slice_ = F.pmod(F.xxhash64(*ROW), F.lit(SLICES))
    for k in range(SLICES):
        windows.append(store.write(docs.filter(slice_ == k).join(found.filter(slice_ == k).hint("shuffle_hash"), ROW).mapInArrow(
            _windows, "window long, check int, doc_id long, mark long, more long, place int"), f"windows-{k}"))
        release(spark)
    for k in range(LOOKUPS):
        store.drop(f"anchored-{k}")
    windows = reduce(DataFrame.unionByName, windows)
    # windows are looked at a part of their hashes at a time, so that only a part of them is being shuffled
    hits = []
    for k in range(SLICES):
        part = windows.filter(F.pmod("window", F.lit(SLICES)) == k)
        least = store.write(part.groupBy("window", "check").agg(
            F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").drop("hi"), "least")
        release(spark)
        hits.append(store.write(part.join(least.hint("shuffle_hash"), ["window", "check"]).filter("doc_id > lo").select(
            *ROW, "place"), f"hits-{k}"))
        store.drop("least")
        release(spark)
    for k in range(SLICES):
        store.drop(f"windows-{k}")
    out = store.write(reduce(DataFrame.unionByName, hits).groupBy(*ROW).agg(F.collect_set("place").alias("places")), "places")
    for k in range(SLICES):
        store.drop(f"hits-{k}")
    release(spark)
    return out


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and the kept words joined by one
    space (``digest``: their SHA-256)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    rows = rows.select("id", F.coalesce("id", F.lit(_LAST)).alias("doc_id"), F.col("t").cast("binary").alias("text"), "t")
    # rows of one doc_id are told apart by their texts; where ids are unique that costs nothing
    unique = rows.groupBy("doc_id").count().filter("count > 1").isEmpty()
    none = F.lit(0).cast("long")
    rows = rows.withColumn("mark", none if unique else F.xxhash64("t")).withColumn(
        "more", none if unique else F.xxhash64(F.lit(1), "t")).drop("t")
    places = repeated_places(rows.drop("id"))
    return rows.join(places.hint("shuffle_hash"), ROW, "left").select("id", "text", "places").mapInArrow(
        lambda it: _texts(it, digest), "doc_id long, n_words long, n_removed long, kept string")


def repeat_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return cut_repeats(docs, digest=True).withColumnRenamed("kept", "kept_sha256")
