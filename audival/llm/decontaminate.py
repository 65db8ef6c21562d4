"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the benchmark's windows of 13 words (a shorter item is one
window of its own length). For each pattern length m a block is two words (one,
if m is 1): the shift table says how far the search may jump when the block
that ends at its cursor is not the end of a pattern, the suffix buckets name
the patterns that end with a block, and a direct comparison of the words
confirms an occurrence. All texts of a batch are searched in lockstep, each
text cut into overlapping segments, so a very long text is many cursors. Word
bounds are found for whole texts; words are hashed at visited cursors only.

Patterns are sent to the tasks only in blocks of a checked size
(``BLOCK_BYTES`` of benchmark text); a larger benchmark is searched block by
block and the spans of a document are united afterwards.

Defined cases: null or wordless texts have no words and are never
contaminated; repeated items each count; an empty benchmark finds nothing;
documents that repeat a doc_id are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.llm.shared import WordBatch, byte_map, mix, runs_of, ship, stages, table_bytes

#: Words of a window.
WINDOW = 13
#: Benchmark text searched for at a time.
BLOCK_BYTES = 32 << 20
#: Words of a segment, besides the overlap.
SEGMENT = 512
_SHIFT_BITS = 18
_U64 = np.uint64
#: Fixed: a word is a run of letters a-z, digits and characters beyond ASCII.
_SEP = np.ones(256, dtype=bool)
_SEP[48:58] = _SEP[65:91] = _SEP[97:123] = False
_SEP[128:] = False
_MAP = byte_map(True)
_MAP[_SEP] = 32
_TRANSLATE = bytes(_MAP)

def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TRANSLATE).split()


def _masked(view: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The first eight bytes of words, bytes beyond their ends cleared."""
    room = np.minimum(size, 8).astype(_U64) * _U64(8)
    keep = np.where(room == 64, _U64(2**64 - 1), (_U64(1) << (room & _U64(63))) - _U64(1))
    return view[start] & keep


def _block_hash(view: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, words: int) -> np.ndarray:
    """Hash of the block of ``words`` words that ends at word ``at``: of each
    word its length and its first and last eight bytes."""
    out = np.zeros(len(at), dtype=_U64)
    for back in range(words):
        s, e = starts[at - back], ends[at - back]
        size = e - s
        tail = np.maximum(e - 8, s)
        out = mix(out * _U64(0x9E3779B97F4A7C15) + _masked(view, s, size)
                  + mix(_masked(view, tail, e - tail) ^ size.astype(_U64)))
    return out


def _eight_byte_view(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    return padded, np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


class Patterns:
    """Shift table, suffix buckets and patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], set[str]]):
        self.length, self.block = length, min(2, length)
        self.items = patterns
        self.shift = np.full(1 << _SHIFT_BITS, length - self.block + 1, dtype=np.uint8 if length < 256 else np.int64)
        joined = [b" ".join(p) for p in patterns]
        flat = np.frombuffer(b" ".join(joined), dtype=np.uint8)
        _, view = _eight_byte_view(flat)
        batch = WordBatch(flat, np.array([0, len(flat)]), _SEP)
        first = np.arange(len(patterns)) * length
        for end in range(self.block - 1, length):  # a block ending at word `end` of a pattern
            h = _block_hash(view, batch.starts, batch.ends, first + end, self.block)
            slot = (h >> _U64(64 - _SHIFT_BITS)).astype(np.int64)
            np.minimum.at(self.shift, slot, length - 1 - end)
            if end == length - 1:
                self.suffixes = np.unique(h)

    def search(self, text: np.ndarray, view: np.ndarray, batch: WordBatch,
               found: list[tuple[int, int, tuple[bytes, ...]]]) -> None:
        """Append (first word, end word, pattern) of every occurrence."""
        m = self.length
        lo, hi = batch.first[:-1], batch.first[1:]
        span = hi - lo - m + 1  # windows of each text
        parts = np.maximum(0, -(-span // SEGMENT))
        doc = np.repeat(np.arange(len(lo)), parts)
        part = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        cursor = lo[doc] + part * SEGMENT + m - 1
        stop = np.minimum(hi[doc], lo[doc] + (part + 1) * SEGMENT + m - 1)
        while len(cursor):
            h = _block_hash(view, batch.starts, batch.ends, cursor, self.block)
            jump = self.shift[(h >> _U64(64 - _SHIFT_BITS)).astype(np.int64)].astype(np.int64)
            at = np.flatnonzero(jump == 0)
            if len(at):
                near = np.searchsorted(self.suffixes, h[at])
                near[near == len(self.suffixes)] = 0
                for c in cursor[at[self.suffixes[near] == h[at]]].tolist():
                    a = int(batch.starts[c - m + 1])
                    words = tuple(words_of(text[a:int(batch.ends[c])].tobytes()))
                    if words in self.items:  # the words themselves are compared
                        found.append((c - m + 1, c + 1, words))
                jump[at] = 1
            cursor = cursor + jump
            live = cursor < stop
            cursor, stop = cursor[live], stop[live]


def build_patterns(items: list[tuple[str, bytes]], window: int) -> list[Patterns]:
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item, text in items:
        words = words_of(text)
        if not words:
            continue
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            by_length.setdefault(size, {}).setdefault(tuple(words[i:i + size]), set()).add(item)
    return [Patterns(n, p) for n, p in sorted(by_length.items())]


def _united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_spans(batches: Iterator[pa.RecordBatch], items: list[tuple[str, bytes]], window: int,
               drop_empty: bool) -> Iterator[pa.RecordBatch]:
    tables = build_patterns(items, window)
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    for got in batches:
        for lo, hi, data, offsets in runs_of(got.column("text")):
            lowered = _MAP[data]
            padded, view = _eight_byte_view(lowered)
            batch = WordBatch(padded[:-8], offsets, _SEP)
            found: list[tuple[int, int, tuple[bytes, ...]]] = []
            for table in tables:
                table.search(padded, view, batch, found)
            by_doc: dict[int, list[tuple[int, int, set[str]]]] = {}
            for (a, b, words), d in zip(found, np.searchsorted(batch.first, [f[0] for f in found], side="right") - 1):
                base = int(batch.first[d])
                hits = next(t.items[words] for t in tables if t.length == len(words))
                by_doc.setdefault(int(d), []).append((a - base, b - base, hits))
            n = np.diff(batch.first)
            rows = sorted(by_doc) if drop_empty else range(hi - lo)
            yield pa.RecordBatch.from_arrays(
                [got.column(c).take(pa.array([lo + d for d in rows], pa.int64())) for c in got.schema.names if c != "text"]
                + [pa.array(n[list(rows)] if len(rows) else [], pa.int64()),
                   pa.array([[{"from": a, "to": b} for a, b in _united([(a, b) for a, b, _ in by_doc.get(d, [])])]
                             for d in rows], kind),
                   pa.array([sorted({i for _, _, s in by_doc.get(d, []) for i in s}) for d in rows],
                            pa.list_(pa.string()))],
                names=[c for c in got.schema.names if c != "text"] + ["n_words", "spans", "items"])


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """The benchmark in blocks of about ``block_bytes``; each block is read on
    its own, so the driver never holds more than one."""
    rows, size = table_bytes(items, "text")
    blocks = max(1, -(-(size + 16 * rows) // block_bytes))
    for b in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        yield [(r["item"], bytes(r["text"])) for r in part.collect()]


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = (), text_col: str = "text",
                       item_col: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` with n_words, the word spans covered by
    benchmark windows (half-open, united) and the items found there. One map
    over the documents, without a shuffle, while the benchmark is one block."""
    ship(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    items = items.select(F.coalesce("item", F.lit("")).alias("item"), "text")
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"]
                       + ["n_words long", "spans array<struct<from:long,to:long>>", "items array<string>"])
    blocks = _blocks(items, block_bytes)
    parts = [rows.mapInArrow(lambda it, block=block: find_spans(it, block, window, False), schema) for block in blocks]
    if len(parts) == 1:
        return parts[0]
    # rows are numbered once, so that equal documents stay apart
    store = stages(docs.sparkSession)
    rows = store.write(rows.withColumn("_number", F.monotonically_increasing_id()), "numbered")
    parts = [rows.mapInArrow(lambda it, block=block: find_spans(it, block, window, False),
                             schema.replace("n_words long", "`_number` long, n_words long"))
             for block in _blocks(items, block_bytes)]
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    merged = whole.groupBy("_number", *keep, "n_words").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    spans = F.expr("""aggregate(s, cast(array() as array<struct<from:long,to:long>>), (acc, x) ->
        if(size(acc) > 0 and x.`from` <= element_at(acc, -1).`to`,
           concat(slice(acc, 1, size(acc) - 1), array(named_struct('from', element_at(acc, -1).`from`,
                  'to', greatest(x.`to`, element_at(acc, -1).`to`)))),
           concat(acc, array(x))))""")
    return merged.select(*keep, "n_words", spans.alias("spans"), "items")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated (at least a twentieth of the words are hit)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(options.get("text_col", "text")).alias("text"))
    found = contaminated_spans(rows, benchmark, keep=("doc_id",), **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["to"] - s["from"])
    out = found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    packed = docs.select(F.struct("*").alias("_row"), F.col("text").alias("text"))
    found = contaminated_spans(packed, benchmark, keep=("_row",), **options)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["to"] - s["from"])
    return found.filter(~((hit > 0) & (20 * hit >= F.col("n_words")))).select("_row.*")

