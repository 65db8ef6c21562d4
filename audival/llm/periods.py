"""Periodic runs of words by scale-tiled distribution.

A run is a longest stretch of words with smallest period q that is at least
``TIMES`` periods (and ``LEAST`` words) long. The periods are taken in octaves
[B, 2B). A run whose period lies in that octave holds a multiple b of B with
three whole periods from b on, since it is four long. So for each octave

1. a document is exploded into tiles: words [b - B, b + 7B) around those
   boundaries b whose 2B words occur again q words on, for some q of the
   octave. That is necessary for a run and compared by hash, so nothing is
   lost. A boundary whose next 6B words have a period below B (compared word
   by word) is left out: what it finds has that smaller period;
2. tiles are dealt over the cluster whatever document they are from, and each
   is solved alone: the Z-function from its boundary gives the one period with
   three periods ahead, the Z-function of the reversed words before it how far
   it reaches back. A tile yields one fragment or none;
3. fragments are shuffled by document and period and stitched: fragments of
   one run overlap, those of two runs of a period do not.

Words are compared as numbers that a document gives its own words, never as
hashes. A document without tiles is done in step 1, so only texts with
candidates are stored and joined with their runs.

Defined cases: a null or empty text has no words and no run; rows that repeat
a doc_id are judged each by its own text; a text that is one long run gives
one tile per B words of its octave; extra columns do not matter; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audival.llm.shared import mix, stages

#: A run has at least this many periods and this many words.
TIMES, LEAST = 4, 6
#: Words looked at together in step 1 (a longer text is taken alone).
GROUP = 200_000
#: Tile words, in multiples of B, before and after the boundary.
BEFORE, AFTER = 1, 7
_U64 = np.uint64
_NO_RUNS = hashlib.sha256(b"").hexdigest()

Words = list[bytes]


def _boundaries(x: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, B, b): the boundaries of a group of texts that get a tile. ``x``
    numbers the words, no two texts share a number; ``first`` has the bounds
    of the texts."""
    longest = int(np.diff(first).max(initial=0))
    half, size, below = mix((x + 1).astype(_U64) * _U64(0x9E3779B97F4A7C15)), 1, {}
    while TIMES * size <= longest:
        # hashes of 2B words from those of B words
        half = mix(half[:-size] * _U64(0xD6E8FEB86659FD93) + half[size:])
        rows = -(-len(half) // size)
        grid = np.zeros(rows * size, dtype=_U64)
        grid[:len(half)] = half
        grid = grid.reshape(rows, size)
        again = grid[1:] == grid[:-1, :1]
        hits = np.flatnonzero(again.any(axis=1))
        text = np.searchsorted(first, hits * size, side="right") - 1
        carried = {}
        for j, t in zip(hits.tolist(), text.tolist()):
            b, end = j * size, int(first[t + 1])
            if b + 3 * size > end:
                continue
            small, far = below.get(b), b + 6 * size
            if small and far + small <= end and np.array_equal(x[b:far], x[b + small:far + small]):
                carried[b] = small
                continue
            carried[b] = small or size + int(again[j].argmax())
            yield t, size, b
        below, size = carried, 2 * size


def _explode(batches: Iterator[pa.RecordBatch], plant: Callable[[int | None, Words], Words] | None,
             digest: bool) -> Iterator[pa.RecordBatch]:
    """Rows of documents and rows of tiles (those have an octave). With
    ``digest`` a document without tiles is one digest instead of its words."""
    def documents(rows: list[tuple[int, int | None, Words]], tiled: set[int]) -> pa.RecordBatch:
        texts = [b" ".join(words) for _, _, words in rows]
        return _batch(
            [r[0] for r in rows], [r[1] for r in rows], [len(r[2]) for r in rows],
            [t if i in tiled else None for i, t in enumerate(texts)],
            [None if i in tiled else hashlib.sha256(t).hexdigest() for i, t in enumerate(texts)],
            [None] * len(rows), [None] * len(rows), [None] * len(rows), [None] * len(rows))

    def group(rows: list[tuple[int, int | None, Words]]) -> Iterator[pa.RecordBatch]:
        numbers, base = [], 0
        for _, _, words in rows:
            seen: dict[bytes, int] = {}
            numbers.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) + base)
            base += len(seen)
        x = np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int64)
        first = np.concatenate([[0], np.cumsum([len(n) for n in numbers])]).astype(np.int64)
        tiled, tiles, held = set(), [], 0

        def flush() -> pa.RecordBatch:
            none = [None] * len(tiles)
            return _batch([t[0] for t in tiles], none, none, none, none, *([t[i] for t in tiles] for i in range(1, 5)))

        for t, size, b in _boundaries(x, first):
            lo, end = int(first[t]), int(first[t + 1])
            a, z = max(lo, b - BEFORE * size), min(end, b + AFTER * size)
            tiled.add(t)
            ids = (x[a:z] - x[a:z].min()).astype(np.int32)
            tiles.append((rows[t][0], size, b - lo, a - lo, ids))
            held += z - a
            if held >= GROUP:
                yield flush()
                tiles, held = [], 0
        if tiles:
            yield flush()
        yield documents(rows, tiled if digest else set(range(len(rows))))

    rows, held = [], 0
    for got in batches:
        for at in range(0, got.num_rows, 256):
            part = got.slice(at, 256)
            for key, doc_id, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                words = text.split()
                if plant is not None:
                    words = plant(doc_id, words)
                if rows and held + len(words) > GROUP:
                    yield from group(rows)
                    rows, held = [], 0
                rows.append((key, doc_id, words))
                held += len(words)
    if rows:
        yield from group(rows)


_EXPLODED = "key long, doc_id long, n_words long, words binary, collapsed string, octave int, boundary int, lo int, ids array<int>"


def _batch(*columns: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int32(), pa.int32(),
             pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                      names=[f.split()[0] for f in _EXPLODED.split(", ")])


def z_function(x: list[int], upto: int) -> list[int]:
    """For each place below ``upto``, how many words from there on are the
    words from the start on (0 for the start itself)."""
    n = len(x)
    upto = min(upto, n)
    z, left, right = [0] * upto, 0, 0
    for i in range(1, upto):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(x: list[int], size: int, at: int) -> tuple[int, int, int] | None:
    """(period, lo, hi) of the run across boundary ``at`` of a tile, if its
    smallest period is in [size, 2 * size) and three periods lie ahead: words
    lo .. hi - 1 are equal to those a period on."""
    z = z_function(x[at:], 2 * size)
    q = next((q for q in range(size, len(z)) if z[q] >= 2 * q), 0)
    if not q or any(q % d == 0 and z[d] >= 3 * q - d for d in range(1, q // 2 + 1)):
        return None
    back = z_function(x[:at + q][::-1], q + 1)
    return q, at - (back[q] if q < len(back) else 0), at + z[q]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        out = []
        keys, sizes, at, lo = (got.column(c).to_pylist() for c in ("key", "octave", "boundary", "lo"))
        for i, ids in enumerate(got.column("ids")):
            found = solve_tile(ids.values.to_pylist(), sizes[i], at[i] - lo[i])
            if found:
                out.append((keys[i], found[0], lo[i] + found[1], lo[i] + found[2]))
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)],
                                         names=["key", "period", "lo", "hi"])


def _stitched(fragments: DataFrame) -> DataFrame:
    """(key, start, period, length) of the runs."""
    by = Window.partitionBy("key", "period").orderBy("lo", "hi")
    reach = F.max("hi").over(by.rowsBetween(Window.unboundedPreceding, -1))
    parts = fragments.withColumn("new", (reach.isNull() | (F.col("lo") > reach)).cast("int"))
    parts = parts.withColumn("run", F.sum("new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    runs = parts.groupBy("key", "period", "run").agg(F.min("lo").alias("start"), F.max("hi").alias("hi"))
    runs = runs.select("key", "start", "period", (F.col("hi") + F.col("period") - F.col("start")).alias("length"))
    return runs.filter((F.col("length") >= LEAST) & (F.col("length") >= TIMES * F.col("period")))


def _finish(batches: Iterator[pa.RecordBatch], digest: bool) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for at in range(0, got.num_rows, 256):
            part = got.slice(at, 256)
            out = []
            for doc_id, text, runs in zip(*(part.column(c).to_pylist() for c in ("doc_id", "words", "runs"))):
                words, runs = text.split(), runs or []
                gone = np.zeros(len(words) + 1, dtype=np.int64)
                for r in runs:
                    gone[r["start"] + r["period"]] += 1
                    gone[r["start"] + r["length"]] -= 1
                stay = (np.cumsum(gone[:-1]) == 0).tolist()
                kept = b" ".join(w for w, s in zip(words, stay) if s)
                best = min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]),
                           default={})
                listed = "".join(f"{r['start']},{r['length']},{r['period']}\n" for r in runs)
                out.append((doc_id, len(words), len(runs), best.get("start"), best.get("length"), best.get("period"),
                            1000 * best["length"] // best["period"] if best else None,
                            hashlib.sha256(listed.encode()).hexdigest() if digest else runs,
                            hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
            yield pa.RecordBatch.from_pylist([dict(zip(_result(digest).names, r)) for r in out], schema=_result(digest))


_RUNS = "array<struct<start: long, period: long, length: long>>"


def _result(digest: bool) -> pa.Schema:
    runs = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "period", "length")]))
    return pa.schema([(n, pa.int64()) for n in ("doc_id", "n_words", "n_runs", "start", "length", "period",
                                                "exponent_milli")]
                     + ([("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())] if digest
                        else [("runs", runs), ("collapsed", pa.string())]))


def _tiled(docs: DataFrame, id_col: str, text_col: str, plant, digest: bool) -> tuple[DataFrame, DataFrame]:
    """The stored rows of step 1 and, per key, the runs in order of start."""
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    cut = stages(docs.sparkSession).write(rows.mapInArrow(lambda it: _explode(it, plant, digest), _EXPLODED), "exploded")
    tiles = cut.filter("octave is not null").select("key", "octave", "boundary", "lo", "ids")
    fragments = tiles.repartition("key", "octave", "boundary").mapInArrow(
        _solve, "key long, period long, lo long, hi long")
    runs = _stitched(fragments).groupBy("key").agg(F.sort_array(F.collect_list(F.struct(
        "start", "period", "length"))).alias("runs"))  # at most a document's runs
    return cut.filter("octave is null"), runs


def _finished(docs: DataFrame, id_col: str, text_col: str, plant, digest: bool) -> DataFrame:
    rows, runs = _tiled(docs, id_col, text_col, plant, digest)
    schema = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    schema += "runs_sha256 string, collapsed_sha256 string" if digest else f"runs {_RUNS}, collapsed string"
    done = rows.filter("words is not null").select("key", "doc_id", "words").join(runs, "key", "left").mapInArrow(
        lambda it: _finish(it, digest), schema)
    if not digest:
        return done
    none = F.lit(None).cast("long")
    bare = rows.filter("words is null").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_runs"),
        *[none.alias(c) for c in ("start", "length", "period", "exponent_milli")],
        F.lit(_NO_RUNS).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"))
    return bare.unionByName(done)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                plant: Callable[[int | None, Words], Words] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_runs, the run with the most periods (start,
    length, period, exponent_milli), runs_sha256, collapsed_sha256. ``plant``
    may change a text's words before they are looked at."""
    return _finished(docs, id_col, text_col, plant, True)


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  plant: Callable[[int | None, Words], Words] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_runs, the run with the most periods, all
    ``runs`` by start, and ``collapsed``: the words left when only the first
    period of each run stays, joined by one space."""
    return _finished(docs, id_col, text_col, plant, False)


def planted(doc_id: int | None, words: Words) -> Words:
    """A repetition in every tenth document, by the checksum of its id: from a
    word on, the words are those of one period again and again. A text without
    an id stays as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]
