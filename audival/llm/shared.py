"""What the text operators share: shipping the package to Python workers,
stored stages, and word kernels over Arrow buffers.

The word kernels work on whole Arrow batches: a batch's texts are one byte
array, words are found by a byte table, and 64-bit word hashes come from one
segmented sum. No Python object is made per word.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audival.plans.stage import Stager

WHITE = b" \t\n\x0b\x0c\r"
_U64 = np.uint64


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per context, so that
    tasks import it whatever the driver's working folder is."""
    sc = spark.sparkContext
    if getattr(sc, "_audival_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="audival-ship-"), "audival_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._audival_shipped = True


class Stages(Stager):
    def drop(self, name: str) -> None:
        """Remove a stage that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def stages(spark: SparkSession) -> Stages:
    """A fresh folder for one run's stored stages, in ``spark.checkpoint.dir``."""
    ship(spark)
    return Stages(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of stages whose result is stored by
    now: it does so once the driver's references to them are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches while wide rows are written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the text's UTF-8 bytes (null text: empty), other columns
    pruned, so nothing can clash with an operator's own names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def one_each(rows: DataFrame, keep: DataFrame, keys: list[str], salts: int = 16) -> DataFrame:
    """One ``row`` of ``rows`` for each row of ``keep``, a stored table of
    ``keys`` and ``ties``, the number of rows that have them. Rows with equal
    keys are combined per salt, then over the salts; the least as JSON stays."""
    once = rows.join(keep.filter("ties = 1").select(*keys), keys).select("row.*")
    tied = keep.filter("ties > 1").select(*keys, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    if tied.isEmpty():
        return once
    met = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts))).join(tied, [*keys, "salt"])
    met = met.withColumn("order", F.sha2(F.to_json("row"), 256))
    for group in ([*keys, "salt"], keys):
        met = met.groupBy(*group).agg(F.min_by("row", "order").alias("row"), F.min("order").alias("order"))
    return once.unionByName(met.select("row.*"))


def table_bytes(df: DataFrame, *cols: str) -> tuple[int, int]:
    """(rows, bytes) of the given text or binary columns: the size check that
    stands before anything is broadcast."""
    size = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in cols), F.lit(0).cast("long"))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


# ---------------------------------------------------------------- word kernels

def byte_map(lower: bool) -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    return t


def separators(which: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(which)] = True
    return t


_STEP, _LENGTH = _U64(0x9E3779B97F4A7C15), _U64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x ^= x >> _U64(33)
    x *= _U64(0xC4CEB9FE1A85EC53)
    x ^= x >> _U64(33)
    return x


class WordBatch:
    """Words of a run of texts: byte bounds ``starts``/``ends`` into ``data``,
    and ``first[d]:first[d + 1]`` the word range of text ``d``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sep: np.ndarray):
        self.data, self.offsets = data, offsets
        word = ~sep[data]
        if len(data):
            begins = word.copy()
            begins[1:] &= ~word[:-1]
            cut = offsets[:-1][offsets[:-1] < offsets[1:]]
            begins[cut] = word[cut]
            self.starts = np.flatnonzero(begins)
            finish = word
            last = finish[-1]
            closes = finish.copy()
            closes[:-1] &= ~finish[1:]
            closes[-1] = last
            ends = cut[cut > 0] - 1
            closes[ends] = finish[ends]
            self.ends = np.flatnonzero(closes) + 1
        else:
            self.starts = self.ends = np.zeros(0, dtype=np.int64)
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self, lower: bool, lane: int = 0) -> np.ndarray:
        """A 64-bit hash of each word: its 8-byte blocks are mixed one by one,
        each with its place, and summed up with the length; no block's part in
        it is a polynomial of its bytes. Lanes are independent of each other."""
        if not len(self.starts):
            return np.zeros(0, dtype=_U64)
        lo, hi = int(self.starts[0]), int(self.ends[-1])
        part = np.zeros(hi - lo + 8, dtype=np.uint8)
        part[:hi - lo] = byte_map(True)[self.data[lo:hi]] if lower else self.data[lo:hi]
        eight = np.ndarray(hi - lo + 1, dtype="<u8", buffer=part, strides=(1,))  # the 8 bytes from each place on
        size = self.ends - self.starts
        blocks = (size + 7) // 8
        first = np.cumsum(blocks) - blocks
        if len(blocks) == int(blocks.sum()):
            place, value = np.zeros(len(blocks), dtype=_U64), eight[self.starts - lo]
        else:
            place = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
            value = eight[np.repeat(self.starts - lo, blocks) + 8 * place]
            place = place.astype(_U64)
        last = first + blocks - 1
        beyond = (8 * blocks - size).astype(_U64) * _U64(8)
        value[last] &= _U64(2**64 - 1) >> beyond
        value = mix(value ^ ((place + _U64(1 + 1_000_003 * lane)) * _STEP))
        if len(value) != len(blocks):
            value = np.add.reduceat(value, first)
        return mix(value + size.astype(_U64) * _LENGTH)


def runs_of(column: pa.Array, limit: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a binary column into runs of texts of about ``limit`` bytes (one
    text is never cut): (first row, last row, bytes, offsets)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, off, buf = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        a, b = int(offsets[lo]), int(offsets[hi])
        yield lo, hi, data[a:b], offsets[lo:hi + 1] - a
        lo = hi


def grams(hashes: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each run of ``n`` words (of one flat word array)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=_U64)
    c = np.random.default_rng(seed).integers(1, 2**64 - 1, n, dtype=_U64, endpoint=True) | _U64(1)
    out = hashes[:len(hashes) - n + 1] * c[0]
    for j in range(1, n):
        out += hashes[j:len(hashes) - n + 1 + j] * c[j]
    return mix(out)


#: Texts are taken together up to so many bytes (a longer one alone).
TOGETHER = 4 << 20


def together(texts: pa.Array, most: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """(first, number) of stretches of texts of at most ``most`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < len(texts):
        before = ends[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(ends, before + most, side="right")), lo + 1)
        yield lo, hi - lo
        lo = hi


def placed(ids: list[bytes], place: np.ndarray, dtype: np.dtype) -> tuple[bytes, np.ndarray]:
    """The ids that ``place`` names, one after another, and the byte at which
    those of each place begin (and the last end)."""
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // dtype.itemsize
    flat, start, long = np.frombuffer(b"".join(ids), dtype=dtype), np.cumsum(size) - size, size[place]
    edge = np.concatenate([np.zeros(1, np.int64), np.cumsum(long)])
    at = np.repeat(start[place] - edge[:-1], long) + np.arange(edge[-1])
    return flat[at].tobytes(), edge * dtype.itemsize
