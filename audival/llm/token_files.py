"""Token ids as Arrow stream files with fixed-size lists.

``write_tokens`` range-partitions the documents by id, so the shards in order
are one stream of ids in ascending doc_id order. A shard is an Arrow IPC file
of record batches of ``BATCH`` sequences; a row is a fixed-size list of
``SEQUENCE`` ids and one of as many mask bits (false only in the padding of a
shard's last sequence). Ids are 16-bit if the vocabulary allows it. Since all
sequences are of one length, sequence ``k`` is row ``k % BATCH`` of batch
``k // BATCH`` and is read from the mapped file without a copy.

A task writes its shard under a name of its own and the index that Spark
commits names the shard, so the files of failed or repeated attempts are never
read. Files are written by their URI, into the shared checkpoint folder unless
told otherwise.

Defined cases: a null or empty text is only its end id; rows that repeat a
doc_id are kept, ordered by text; a null doc_id comes first; an empty table
writes no shard.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from audival.llm.shared import placed, stages, together

#: Ids of a sequence, sequences of a record batch.
SEQUENCE = 1024
BATCH = 64
#: Words remembered per Python worker.
REMEMBERED = 700_000
#: Longer words (in bytes) are never remembered.
LONGEST = 64
#: Bytes of texts taken together, words given to the library at once.
TOGETHER, AT_ONCE = 8 << 20, 512
#: A text with one of these is not cut: runs of white space, or white space other than the space and the line feed.
_WHOLE = "  | \n|\n |[" + "".join(map(chr, (
    9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
    0x3000))) + "]"
#: Fixed: how the vocabulary's file writes a space.
SPACE = "\u0120"


class ChunkEncoder:
    """A library tokenizer with remembered words.

    A byte-level vocabulary never merges across a single space between two
    other characters, so a text is cut there and each word with the space
    before it is encoded by the library once. Cutting, finding the distinct
    words and putting their ids back in place are Arrow and numpy steps over
    many texts; only distinct words are Python values."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = self.library.get_vocab()
        self.dtype = np.dtype("<u2" if len(vocab) <= 1 << 16 else "<u4")
        self.opens = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)  # tokens that begin with a space
        self.opens[[i for t, i in vocab.items() if t.startswith(SPACE)]] = True
        self.known: dict[str, bytes] = {}  # words after a space

    def library_ids(self, chunks: list[str]) -> list[bytes]:
        got = self.library.encode_batch_fast(chunks, add_special_tokens=False)
        return [array(self.dtype.char, e.ids).tobytes() for e in got]

    def spaced_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word after a space. Many words are one text for the
        library; its tokens that begin with a space are where words begin."""
        out: list[bytes] = []
        for at in range(0, len(words), AT_ONCE):
            part = words[at:at + AT_ONCE]
            raw = b"" if "" in part else self.library_ids(["".join([" " + w for w in part])])[0]
            begin = np.flatnonzero(self.opens[np.frombuffer(raw, dtype=self.dtype)]) * self.dtype.itemsize
            if len(begin) == len(part):
                edges = [*begin.tolist(), len(raw)]
                out += [raw[a:b] for a, b in zip(edges, edges[1:])]
            else:  # a special token took a space, or another vocabulary
                out += self.library_ids([" " + w for w in part])
        return out

    def remembered(self, words: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known = {}
        ids = list(map(self.known.get, words))
        missing = [w for w, i in zip(words, ids) if i is None]
        if missing:
            new = dict(zip(missing, self.spaced_ids(missing)))
            ids = [new[w] if i is None else i for w, i in zip(words, ids)]
            self.known.update((w, i) for w, i in new.items() if len(w) <= LONGEST)
        return ids

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (not null)."""
        whole = pc.match_substring_regex(texts, _WHOLE)
        # a text that is not cut is its own first word
        cut = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        words = cut.flatten().dictionary_encode()
        begin = cut.offsets.to_numpy()[:-1]
        place = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        first = words.dictionary.take(pa.array(place[begin])).to_pylist()
        for k in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            first[k] = texts[k].as_py()
        inside = np.ones(len(place), dtype=bool)
        inside[begin] = False
        used = np.zeros(len(words.dictionary), dtype=bool)
        used[place[inside]] = True
        at = np.cumsum(used) - 1
        ids = self.remembered(words.dictionary.filter(pa.array(used)).to_pylist())
        place = at[place]
        place[begin] = len(ids) + np.arange(len(first))
        ids += self.library_ids(first)

        out, edge = placed(ids, place, self.dtype)
        edges = [*edge[begin].tolist(), len(out)]
        return [out[a:b] for a, b in zip(edges, edges[1:])]


_loaded: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _loaded:
        _loaded[path] = ChunkEncoder(path)
    return _loaded[path]


class ShardWriter:
    """Appends ids to one shard; holds at most one record batch."""

    def __init__(self, uri: str, dtype: np.dtype, sequence: int, batch: int):
        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
        fs.create_dir(os.path.dirname(path), recursive=True)
        self.dtype, self.sequence, self.room = dtype, sequence, sequence * batch
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, sequence)), ("mask", pa.list_(pa.bool_(), sequence))],
                                {"sequence": str(sequence), "batch": str(batch)})
        self.sink = fs.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.wait, self.waiting, self.total = [], 0, 0

    def _put(self, ids: np.ndarray) -> None:
        pad = -len(ids) % self.sequence
        mask = np.ones(len(ids) + pad, dtype=bool)
        mask[len(ids):] = False
        flat = np.concatenate([ids, np.zeros(pad, dtype=self.dtype)])
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.sequence) for x in (flat, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def add(self, ids: bytes) -> int:
        """Start of these ids in the shard."""
        start = self.total
        part = np.frombuffer(ids, dtype=self.dtype)
        self.total += len(part)
        while self.waiting + len(part) >= self.room:
            take = self.room - self.waiting
            self._put(np.concatenate([*self.wait, part[:take]]))
            self.wait, self.waiting, part = [], 0, part[take:]
        if len(part):
            self.wait.append(part)
            self.waiting += len(part)
        return start

    def close(self) -> None:
        if self.waiting:
            self._put(np.concatenate(self.wait))
        self.writer.close()
        self.sink.close()


class ShardReader:
    """Random access to a shard; local files are mapped, not read."""

    def __init__(self, uri: str):
        fs, path = pyarrow.fs.FileSystem.from_uri(uri)
        source = pa.memory_map(path) if isinstance(fs, pyarrow.fs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(source)
        meta = self.file.schema.metadata
        self.sequence, self.batch = int(meta[b"sequence"]), int(meta[b"batch"])
        self._at, self._ids = -1, np.zeros(0)

    def sequence_of(self, k: int) -> tuple[pa.Array, pa.Array]:
        """Ids and mask of sequence ``k``, zero-copy."""
        got = self.file.get_batch(k // self.batch)
        return tuple(got.column(c)[k % self.batch].values for c in (0, 1))

    def ids(self, start: int, n: int) -> np.ndarray:
        room, parts = self.sequence * self.batch, []
        while n > 0:
            k, lo = divmod(start, room)
            if k != self._at:
                column = self.file.get_batch(k).column(0)
                self._at, self._ids = k, column.flatten().to_numpy(zero_copy_only=True)
            part = self._ids[lo:min(room, lo + n)]
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return np.concatenate(parts) if len(parts) != 1 else parts[0]


def _write(batches: Iterator[pa.RecordBatch], path: str, folder: str, end: int, sequence: int,
           batch: int) -> Iterator[pa.RecordBatch]:
    coder, shard, uri = encoder(path), None, f"{folder}/shard-{uuid.uuid4().hex}.arrow"
    for got in batches:
        for lo, n in together(got.column("text"), TOGETHER):
            part = got.slice(lo, n)
            if shard is None:
                shard = ShardWriter(uri, coder.dtype, sequence, batch)
            last = np.array([end], dtype=coder.dtype).tobytes()
            coded = [ids + last for ids in coder.encode(part.column("text"))]
            starts = [shard.add(ids) for ids in coded]
            n = [len(ids) // coder.dtype.itemsize for ids in coded]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([uri] * len(n)), pa.array(starts, pa.int64()), pa.array(n, pa.int64())],
                names=["doc_id", "shard", "at", "n_tokens"])
    if shard is not None:
        shard.close()


def write_tokens(docs: DataFrame, path: str, folder: str | None = None, end: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", sequence: int = SEQUENCE, batch: int = BATCH) -> DataFrame:
    """Write the shards; returns their index: doc_id, shard (file), at (place
    in the shard), n_tokens, start (place in the whole stream)."""
    store = stages(docs.sparkSession)
    folder = folder or store.path("shards")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    index = store.write(
        ordered.mapInArrow(lambda it: _write(it, path, folder, end, sequence, batch),
                           "doc_id long, shard string, at long, n_tokens long"), "index")
    # one row per shard: ids never straddle shards, so the smallest id orders them
    sums = index.groupBy("shard").agg(F.min("doc_id").alias("lowest"), F.sum("n_tokens").alias("n"))
    before = Window.orderBy(F.asc_nulls_first("lowest")).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return index.join(bases, "shard").select("doc_id", "shard", "at", "n_tokens",
                                             (F.col("base") + F.col("at")).alias("start"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader, uri = None, None
    for got in batches:
        crc = []
        for shard, at, n in zip(*(got.column(c).to_pylist() for c in ("shard", "at", "n_tokens"))):
            if shard != uri:
                reader, uri = ShardReader(shard), shard
            crc.append(zlib.crc32(reader.ids(at, n).astype("<u4").tobytes()))
        yield pa.RecordBatch.from_arrays(
            [got.column("doc_id"), got.column("start"), got.column("n_tokens"), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, read back from the shards."""
    return index.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
