"""Hard-negative mining with a residue-number-system GEMM.

Scores are exact inner products of whole-number vectors. They are not summed
as wide integers: the component matrices are taken modulo several small primes,
centred, and multiplied in float32, where every sum of at most ``DEPTH``
products stays below 2**24 and is exact in any order. Chinese remaindering
(mixed radix) gives the signed score back. The primes are chosen by the
vectors' length, their number by the largest component, so that the product of
the primes exceeds the range of scores.

Rows are dealt into chunks of bounded size. An anchor is one row per chunk it
must be scored with; chunk rows and anchors are shuffled together by chunk,
rows first, so a task holds one chunk and lets the anchors stream past it in
small blocks. Nothing goes through the driver, and no side is broadcast. Of
each chunk an anchor keeps only what can be among its first:

1. positives: chunks of rows with the anchor's label, first ``positives`` rows;
2. negatives: chunks of all rows; for each positive the first ``negatives``
   rows of another label inside its window of scores.

Spark windows over those candidates make the final selection.

Defined cases: a row without vec_id, label or vector, or with a null or
non-finite component, takes no part. Vectors of different lengths count as
padded with zeros. Rows that repeat a vec_id each take part (an anchor row
each, and never with a row of their own vec_id as a positive); rows equal in
score and vec_id are interchangeable. Scores that could leave 63 bits are an
error. Extra columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from audival.llm.shared import stages

#: Rows of a chunk, and the least worth a task of its own; most scores of a block.
CHUNK, LEAST, BLOCK = 1 << 16, 1 << 12, 1 << 20
#: Products summed in float32 at a time.
DEPTH = 1024


# ------------------------------------------------------------ residue numbers

def primes_for(length: int, bound: int) -> list[int]:
    """Primes whose product exceeds the scores from -bound to bound, each small
    enough that the sums of a block of products are exact in float32."""
    depth = max(1, min(length, DEPTH))
    top = 2 * int((2**24 // depth) ** 0.5)
    sieve = np.ones(top + 1, dtype=bool)
    sieve[:3] = False  # centred residues need an odd prime
    sieve[4::2] = False
    for n in range(3, int(top**0.5) + 1, 2):
        if sieve[n]:
            sieve[n * n::n] = False
    out, product = [], 1
    for p in np.flatnonzero(sieve)[::-1].tolist():
        if product > 2 * bound:
            return out or [p]
        out.append(p)
        product *= p
    raise ValueError("vectors too long or components too large for the primes at hand")


@dataclass(frozen=True)
class Residues:
    """The number system for vectors of ``length`` components and scores of at
    most ``bound`` in size."""

    length: int
    bound: int
    primes: tuple[int, ...]

    @classmethod
    def of(cls, length: int, largest: int) -> Residues:
        bound = length * largest * largest
        if 2 * bound >= 2**63:
            raise ValueError(f"scores of {length} components up to {largest} do not fit 63 bits")
        return cls(length, bound, tuple(primes_for(length, bound)))

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The centred residues of whole-number rows, one float32 matrix per prime."""
        out = []
        for p in self.primes:
            r = vectors % p
            r[r > p // 2] -= p
            out.append(r.astype(np.float32))
        return out

    def scores(self, one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
        """Exact inner products of the rows of two split matrices."""
        value, product = None, 1
        for p, a, b in zip(self.primes, one, two):
            # shifted by the bound, so that no score is negative
            r = np.full((len(a), len(b)), self.bound % p, dtype=np.int64)
            for at in range(0, self.length, DEPTH):
                r += (a[:, at:at + DEPTH] @ b[:, at:at + DEPTH].T).astype(np.int32) % p
            if value is None:
                value = r % p
            else:
                digit = (r - value) % p * pow(product, -1, p) % p
                value += digit * product
            product *= p
        return value - self.bound


# ------------------------------------------------------------------ in chunks

def first_of(scores: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the places ``at``, in ascending order of ids, the ``k`` first by
    score, ties by id (not sorted)."""
    if len(at) <= k:
        return at
    part = scores[at]
    least = np.partition(part, len(part) - k)[len(part) - k]
    above = at[part > least]
    return np.concatenate([above, at[part == least][:k - len(above)]])


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """Vectors as rows, shorter ones padded with zeros."""
    out = np.zeros((len(column), length), dtype=np.int64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) and (sizes == length).all():
        return flat.astype(np.int64).reshape(len(column), length)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """((side, chunk), whether anchors, rows) in the order of the batches."""
    for got in batches:
        side, chunk = got.column("side").to_numpy(), got.column("chunk").to_numpy()
        anchors = got.column("is_anchor").to_numpy(zero_copy_only=False)
        turn = np.flatnonzero((side[1:] != side[:-1]) | (chunk[1:] != chunk[:-1]) | (anchors[1:] != anchors[:-1])) + 1
        for a, b in zip([0, *turn.tolist()], [*turn.tolist(), got.num_rows]):
            if a < b:
                yield (int(side[a]), int(chunk[a])), bool(anchors[a]), got.slice(a, b - a)


class _Chunk:
    """The rows of a chunk in order of vec_id, split once."""

    def __init__(self, parts: list[pa.RecordBatch], system: Residues):
        ids = np.concatenate([p.column("vec_id").to_numpy() for p in parts])
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.labels = np.concatenate([p.column("label").to_numpy() for p in parts])[order]
        self.split = system.split(np.concatenate([_matrix(p.column("v"), system.length) for p in parts])[order])


def _scored(batches: Iterator[pa.RecordBatch], system: Residues) -> Iterator[tuple[_Chunk, pa.RecordBatch, np.ndarray]]:
    """(chunk, block of anchors, their scores with the chunk's rows)."""
    now, parts, chunk = None, [], None
    for name, anchors, rows in _parts(batches):
        if name != now:
            now, parts, chunk = name, [], None
        if not anchors:
            parts.append(rows)
            continue
        if not parts and chunk is None:
            continue
        if chunk is None:
            chunk, parts = _Chunk(parts, system), []
        step = max(1, BLOCK // len(chunk.ids))
        for at in range(0, rows.num_rows, step):
            block = rows.slice(at, step)
            yield chunk, block, system.scores(system.split(_matrix(block.column("v"), system.length)), chunk.split)


def _positives(batches: Iterator[pa.RecordBatch], system: Residues, k: int) -> Iterator[pa.RecordBatch]:
    for chunk, block, scores in _scored(batches, system):
        rows, ids = block.column("row").to_pylist(), block.column("vec_id").to_numpy()
        out = []
        for i, row in enumerate(rows):
            at = first_of(scores[i], np.flatnonzero(chunk.ids != ids[i]), k)
            out += [(row, int(chunk.ids[j]), int(scores[i, j])) for j in at]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)],
                                         names=["row", "positive_id", "positive_score"])


def _negatives(batches: Iterator[pa.RecordBatch], system: Residues, k: int, low: int, high: int
               ) -> Iterator[pa.RecordBatch]:
    names = ["row", "anchor_id", "turn", "positive_id", "positive_score", "negative_id", "negative_score"]
    for chunk, block, scores in _scored(batches, system):
        out = []
        anchors = zip(*(block.column(c).to_pylist() for c in ("row", "vec_id", "label", "positives")))
        for i, (row, anchor, label, positives) in enumerate(anchors):
            other = np.flatnonzero(chunk.labels != label)
            for turn, positive in enumerate(positives):
                # low * positive <= 100 * score <= high * positive, in whole numbers
                p, s = positive["score"], scores[i, other]
                at = other[(s >= -(-low * p // 100)) & (s <= high * p // 100)]
                out += [(row, anchor, turn, positive["id"], p, int(chunk.ids[j]), int(scores[i, j]))
                        for j in first_of(scores[i], at, k)]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(len(names))],
                                         names=names)


# ------------------------------------------------------------------- in Spark

def _usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """row, vec_id, label and the whole-number vector of rows that take part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    out = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                      x.alias("x")).filter("vec_id is not null and label is not null and x is not null")
    odd = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return out.filter(~odd).select(F.monotonically_increasing_id().alias("row"), "vec_id", "label",
                                   F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _chunks(rows: Column, parallelism: int) -> Column:
    """How many chunks for a number of rows: none above CHUNK, and small
    tables are spread over the cores."""
    spread = F.least(F.lit(parallelism), F.ceil(rows / F.lit(LEAST)))
    return F.greatest(F.ceil(rows / F.lit(CHUNK)), spread).cast("int")


def _met(rows: DataFrame, anchors: DataFrame, partitions: int) -> DataFrame:
    """Rows and anchors by chunk, the rows of a chunk before its anchors."""
    both = rows.withColumn("is_anchor", F.lit(False)).unionByName(
        anchors.withColumn("is_anchor", F.lit(True)), allowMissingColumns=True)
    return both.repartition(partitions, "side", "chunk").sortWithinPartitions("side", "chunk", "is_anchor")


def hard_negatives(rows: DataFrame, anchor: Callable[[Column], Column], id_col: str = "vec_id",
                   label_col: str = "label", vector_col: str = "embedding", scale: int = 256, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90,
                   relabel: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Per anchor and positive its first hard negatives: anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score. ``anchor`` says by
    vec_id which rows are anchors, ``relabel`` may change a label by vec_id and
    label; a negative's score is ``low`` to ``high`` per cent of the positive's."""
    spark = rows.sparkSession
    store = stages(spark)
    usable = _usable(rows, id_col, label_col, vector_col, scale)
    if relabel is not None:
        usable = usable.withColumn("label", relabel(F.col("vec_id"), F.col("label")))
    size = F.transform("v", lambda c: F.abs(c.cast("double")))
    usable = store.write(usable, "usable")
    found = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("length"),
                       F.max(F.array_max(size)).alias("largest")).first()
    system = Residues.of(found["length"] or 0, int(found["largest"] or 0))
    kind = next(k for k, top in (("smallint", 2**15), ("int", 2**31), ("bigint", 2**63)) if (found["largest"] or 0) < top)
    usable = usable.withColumn("v", F.col("v").cast(f"array<{kind}>"))
    asking = usable.filter(anchor(F.col("vec_id")))
    parallelism = spark.sparkContext.defaultParallelism

    # a label's rows in chunks of their own
    labels = store.write(usable.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "many", _chunks(F.col("n"), parallelism)).drop("n"), "labels")
    side, parts = F.col("label").alias("side"), F.sequence(F.lit(0), F.col("many") - 1)
    own = usable.join(labels, "label").select(
        side, F.pmod(F.xxhash64("row"), F.col("many")).alias("chunk"), "vec_id", "label", "v")
    met = _met(own, asking.join(labels, "label").withColumn("part", F.explode(parts)).select(
        side, F.col("part").cast("long").alias("chunk"), "row", "vec_id", "label", "v"),
        max(1, 2 * int(labels.agg(F.sum("many")).first()[0] or 0)))
    close = met.mapInArrow(lambda it: _positives(it, system, positives),
                           "row long, positive_id long, positive_score long")
    first = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    close = close.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= positives)
    close = close.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "rank", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))).alias("positives"))
    asking = store.write(asking.join(close, "row"), "anchors")

    many = spark.range(1).select(_chunks(F.lit(found["n"]), parallelism)).first()[0] if found["n"] else 1
    side, parts = F.lit(0).cast("long").alias("side"), F.sequence(F.lit(0), F.lit(many - 1))
    met = _met(usable.select(side, F.pmod(F.xxhash64("row"), F.lit(many)).alias("chunk"), "vec_id", "label", "v"),
               asking.withColumn("part", F.explode(parts)).select(
                   side, F.col("part").cast("long").alias("chunk"), "row", "vec_id", "label", "v", "positives"), 2 * many)
    far = met.mapInArrow(
        lambda it: _negatives(it, system, negatives, low, high),
        "row long, anchor_id long, turn long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("row", "turn").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= negatives)
    return far.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
