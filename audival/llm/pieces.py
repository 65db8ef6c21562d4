"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text starts as its characters, spaces written as U+2581 with one more in
front. An agenda holds every pair of adjacent symbols whose join is a piece,
ordered by score, then by place. The best pair is joined, pairs that held one
of its parts are stale and are skipped when they come up, and the two pairs
with the new neighbours go on the agenda. What is left are the pieces; a
character that is none becomes its UTF-8 bytes.

No piece of such a vocabulary goes from another character into a space, and
some control characters are in no longer piece at all. No pair ever crosses
such a boundary, so a text is cut there and each segment has an agenda of its
own: a heap, or, for the distinct short segments of an Arrow batch, a row of a
matrix, all rows being worked on in lockstep. Short segments are remembered
within a task, in a table of bounded size.

Decoding joins the pieces, takes the space in front away and turns runs of
byte pieces into characters, each byte that is part of none into U+FFFD.

Every Arrow batch can be checked against the sentencepiece library, ids and
decoded text; ``same_as_library`` then says so for each row.

Defined cases: a null text is empty and has the begin and end ids only; equal
ids, ties and extra columns do not matter, each row is coded by its own text;
an empty table gives no rows. Vocabularies of another type, with a character
map of their own, or with user-defined or unused pieces are an error.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.llm.shared import placed, ship, together

SPACE = "▁"
#: Segments remembered by a task, in each of two generations (one more batch's
#: may be added), and the length in characters up to which one is remembered.
REMEMBERED, SHORT = 1 << 18, 32

#: Fixed values of the model file: field numbers and piece types.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MODEL_TYPE, BEGIN_ID, END_ID, SUFFIX, UNKNOWN_SURFACE = 3, 41, 42, 24, 44
CHARACTER_MAP, DUMMY_PREFIX, EXTRA_SPACES, ESCAPE = 2, 3, 4, 5
MERGE_TYPE = 2
#: The place in the order of pairs that do not join.
LAST = 2**31

codecs.register_error("audival-each-byte", lambda e: ("�", e.start + 1))


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
        yield key >> 3, raw[at:at + size]
        at += size


class PieceCoder:
    """The pieces of one model file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = list(fields(f.read()))
        trainer = dict(fields(next((v for k, v in model if k == TRAINER), b"")))
        rules = dict(fields(next((v for k, v in model if k == NORMALIZER), b"")))
        if trainer.get(MODEL_TYPE, 1) != MERGE_TYPE or trainer.get(SUFFIX):
            raise ValueError(f"{path}: not a merge-type vocabulary with spaces in front")
        if rules.get(CHARACTER_MAP) or rules.get(EXTRA_SPACES, 1) or not rules.get(ESCAPE, 1):
            raise ValueError(f"{path}: the vocabulary maps characters or spaces")
        self.prefix = " " if rules.get(DUMMY_PREFIX, 1) else ""
        self.begin, self.end = trainer.get(BEGIN_ID, 1), trainer.get(END_ID, 2)
        unknown = trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode())
        self.order: dict[str, float] = {}  # a piece's place in the agenda: smaller first
        self.id: dict[str, int] = {}
        self.byte: list[int | None] = [None] * 256
        self.surface: list[bytes] = []
        control = []
        self.unknown = 0
        for i, raw in enumerate(v for k, v in model if k == PIECES):
            piece = dict(fields(raw))
            name, kind = piece[1].decode(), piece.get(3, NORMAL)
            shown = b""
            if kind == NORMAL:
                self.order[name] = -struct.unpack("<f", piece.get(2, bytes(4)))[0]
                self.id[name] = i
                shown = name.replace(SPACE, " ").encode()
            elif kind == BYTE:
                shown = bytes([int(name[1:-1], 16)])
                self.byte[shown[0]] = i
            elif kind == CONTROL:
                control.append(i)
            elif kind == UNKNOWN:
                self.unknown, shown = i, unknown
            else:
                raise ValueError(f"{path}: piece {name!r} is of a kind that is not supported")
            self.surface.append(shown)
        self.control = np.isin(np.arange(len(self.surface)), control)
        long = [p for p in self.id if len(p) > 1]
        whole = any(a != SPACE and b == SPACE for p in long for a, b in zip(p, p[1:]))
        joined = set("".join(long))
        alone = "".join(c for c in map(chr, range(32)) if c not in joined)
        stop = re.escape(alone)
        # other texts are their words, each with the space before it
        self.odd = None if whole or not self.prefix else f"^$|^ |  | $|{SPACE}"
        self.alone = "[" + "".join(f"\\x{ord(c):02x}" for c in alone) + "]" if alone else "^$"
        self.cut = None if whole else re.compile(f" *[^ {stop}]+| +" + f"|[{stop}]" * bool(alone))
        self._tables()
        self.forget()

    def forget(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # ------------------------------------------------------------- encoding

    def pieces(self, segment: str) -> list[str]:
        """The pieces of a segment by the agenda of its adjacent pairs, a heap."""
        segment = segment.replace(" ", SPACE)
        order, n = self.order, len(segment)
        size = [1] * n  # of the symbol that starts here, 0 inside one
        before = list(range(-1, n - 1))  # where the symbol in front starts
        agenda = []
        for i in range(n - 1):
            rank = order.get(segment[i:i + 2])
            if rank is not None:
                agenda.append((rank, i, 1, 1))
        heapq.heapify(agenda)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = i + a
            if size[i] != a or size[j] != b:
                continue  # one of the two is part of another symbol by now
            size[i], size[j] = a + b, 0
            end = j + b
            if end < n:
                before[end] = i
                rank = order.get(segment[i:end + size[end]])
                if rank is not None:
                    heapq.heappush(agenda, (rank, i, a + b, size[end]))
            front = before[i]
            if front >= 0:
                rank = order.get(segment[front:end])
                if rank is not None:
                    heapq.heappush(agenda, (rank, front, size[front], a + b))
        out, i = [], 0
        while i < n:
            out.append(segment[i:i + size[i]])
            i += size[i]
        return out

    def spelled(self, pieces: list[str]) -> bytes:
        """Ids of pieces as little-endian 32-bit integers."""
        ids = []
        for piece in pieces:
            known = self.id.get(piece)
            if known is not None:
                ids.append(known)
            else:
                raw = [self.byte[b] for b in piece.encode()]
                ids += [self.unknown] if None in raw else raw
        return struct.pack(f"<{len(ids)}I", *ids)

    def _tables(self) -> None:
        """Symbols as numbers (0: a character of no piece) and the pairs that
        join, for agendas in lockstep."""
        names = ["", *sorted({*self.id, *"".join(self.id)})]
        number = {name: i for i, name in enumerate(names)}
        self.names, self.char = names, np.zeros(0x110000, dtype=np.int32)
        for name in names:
            if len(name) == 1:
                self.char[ord(name)] = number[name]
        self.char[ord(" ")] = self.char[ord(SPACE)]
        self.token = np.array([self.id.get(name, -1) for name in names], dtype=np.int64)
        places = {score: i for i, score in enumerate(sorted(set(self.order.values())))}
        pairs = sorted((number[p[:k]] * len(names) + number[p[k:]], places[self.order[p]], number[p])
                       for p in self.id for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self.pair, self.place, self.joined = (np.array(c) for c in zip(*pairs, (2**62, LAST, 0)))

    def _look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the order and join of pairs of symbols."""
        key = left.astype(np.int64) * len(self.names) + right
        at = np.searchsorted(self.pair, key)
        found = self.pair[at] == key
        return np.where(found, self.place[at], LAST), self.joined[at]

    def lockstep(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, their symbols) of words of one length, as they are done, each
        with an agenda of its own, a row of a matrix: the first smallest entry
        of each row is joined in every step."""
        n, who = len(words[0]), np.arange(len(words))
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        symbols = self.char[points].reshape(len(words), n)
        agenda, joins = self._look(symbols[:, :-1], symbols[:, 1:])
        while len(who):
            row = np.arange(len(who))
            best = agenda.argmin(axis=1) if agenda.shape[1] else np.zeros(len(who), dtype=np.int64)
            live = agenda[row, best] < LAST if agenda.shape[1] else np.zeros(len(who), dtype=bool)
            if not live.all():
                yield who[~live], symbols[~live]
                who, symbols, agenda, joins, best = who[live], symbols[live], agenda[live], joins[live], best[live]
                row = row[:len(who)]
                if not len(who):
                    return
            symbols[row, best] = joins[row, best]
            stay = np.ones(symbols.shape, dtype=bool)
            stay[row, best + 1] = False
            symbols = symbols[stay].reshape(len(who), -1)
            stay = np.ones(agenda.shape, dtype=bool)
            stay[row, best] = False
            agenda, joins = (m[stay].reshape(len(who), -1) for m in (agenda, joins))
            for side in (best - 1, best):  # the pairs with the neighbours
                r = row[(side >= 0) & (side < agenda.shape[1])]
                k = side[r]
                agenda[r, k], joins[r, k] = self._look(symbols[r, k], symbols[r, k + 1])

    def learn(self, segments: list[str]) -> None:
        """Remember the ids of short segments that are not known yet."""
        groups: dict[int, list[str]] = {}
        for s in segments:
            groups.setdefault(len(s), []).append(s)
        for words in groups.values():
            for who, symbols in self.lockstep(words):
                ids, size = self.token[symbols], 4 * symbols.shape[1]
                raw = ids.astype("<u4").tobytes()
                for k, (i, whole) in enumerate(zip(who.tolist(), (ids.min(axis=1) >= 0).tolist())):
                    self.young[words[i]] = raw[k * size:(k + 1) * size] if whole else self.spelled(
                        self.pieces(words[i]))

    def _segments(self, text: str) -> list[str]:
        """The parts of a text that no piece crosses, spaces as they are."""
        text = self.prefix + (text.replace(SPACE, " ") if SPACE in text else text)
        return self.cut.findall(text) if self.cut else [text]

    def _known(self, segments: list[str]) -> list[bytes]:
        """Ids of distinct segments."""
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        known, out = self.young, list(map(self.young.get, segments))
        short, long = [], {}
        for s in {s for s, ids in zip(segments, out) if ids is None}:
            if s in self.old:
                known[s] = self.old[s]
            elif len(s) <= SHORT:
                short.append(s)
            else:
                long[s] = self.spelled(self.pieces(s))
        self.learn(short)
        return [known.get(s) or long[s] if ids is None else ids for s, ids in zip(segments, out)]

    def _words(self, words: pa.Array) -> list[bytes]:
        """Ids of distinct words after a space; a word with characters that
        stand alone is several segments."""
        spaced = [" " + w for w in words.to_pylist()]
        several = np.flatnonzero(pc.match_substring_regex(words, self.alone).to_numpy(zero_copy_only=False)).tolist()
        parts = [self.cut.findall(spaced[k]) for k in several]
        for k, segments in zip(several, parts):
            spaced[k] = segments[0]
        rest = list(chain.from_iterable(p[1:] for p in parts))
        out = self._known(spaced + rest)
        at = len(spaced)
        for k, segments in zip(several, parts):
            out[k] = b"".join([out[k], *out[at:at + len(segments) - 1]])
            at += len(segments) - 1
        return out[:len(spaced)]

    def encode_all(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Ids of texts, the begin and the end id included. Cutting, finding
        the distinct segments and putting their ids back are Arrow and numpy
        steps; texts that are not plain are cut one by one."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        odd = (pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False) if self.odd
               else np.ones(len(texts), dtype=bool))
        words = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
        cut = [self._segments(t) if t else [] for t in texts.filter(pa.array(odd)).to_pylist()]
        begin = np.zeros(len(texts), np.int64)  # of each text among the segments
        plain = words.flatten().dictionary_encode()
        begin[~odd] = words.offsets.to_numpy()[:len(words)]
        begin[odd] = len(plain) + np.cumsum([0, *map(len, cut)])[:-1]
        end = begin + 0
        end[~odd] = words.offsets.to_numpy()[1:]
        end[odd] += np.fromiter(map(len, cut), np.int64, len(cut))
        others = pa.array(list(chain.from_iterable(cut)), pa.string()).dictionary_encode()
        ids = self._words(plain.dictionary) + self._known(others.dictionary.to_pylist())
        place = np.concatenate([plain.indices.to_numpy(zero_copy_only=False).astype(np.int64),
                                others.indices.to_numpy(zero_copy_only=False).astype(np.int64) + len(plain.dictionary)])
        out, edge = placed(ids, place, np.dtype("<u4"))
        first, last = struct.pack("<I", self.begin), struct.pack("<I", self.end)
        return [first + out[a:b] + last for a, b in zip(edge[begin].tolist(), edge[end].tolist())]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    # ------------------------------------------------------------- decoding

    def decode(self, ids: bytes) -> bytes:
        """The text of the ids in UTF-8."""
        numbers = np.frombuffer(ids, dtype="<u4")
        shown = list(map(self.surface.__getitem__, numbers.tolist()))
        # a control piece ends a run of bytes
        stops = np.flatnonzero(self.control[numbers]).tolist()
        if self.prefix:
            first = next((k for k, stop in enumerate([*stops, -1]) if k != stop), 0)
            if first < len(shown) and numbers[first] not in (self.unknown, self.byte[32]):
                shown[first] = shown[first].removeprefix(b" ")
        return b"".join(_text(b"".join(shown[a:b])) for a, b in zip([0, *stops], [*stops, len(shown)]) if a < b)


def _text(raw: bytes) -> bytes:
    try:
        raw.decode()
    except UnicodeDecodeError:
        return raw.decode(errors="audival-each-byte").encode()
    return raw


_loaded: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    """One per Python worker and file; what it remembers lasts for a task."""
    if path not in _loaded:
        _loaded[path] = PieceCoder(path)
    return _loaded[path]


def _library(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _round_trip(batches: Iterator[pa.RecordBatch], path: str, with_ids: bool, check: bool) -> Iterator[pa.RecordBatch]:
    c = coder(path)
    library = _library(path) if check else None
    try:
        for got in batches:
            for lo, n in together(got.column(1)):
                part = got.slice(lo, n)
                coded = c.encode_all(part.column(1))
                decoded = [c.decode(ids) for ids in coded]
                cols = [part.column(0), pa.array([len(i) // 4 for i in coded], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in coded]),
                        pa.array([hashlib.sha256(t).hexdigest() for t in decoded])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if check:
                    theirs = library.encode(part.column(1).to_pylist(), add_bos=True, add_eos=True, num_threads=1, return_type="numpy")
                    again = library.decode(theirs, num_threads=1)
                    cols.append(pa.array([t.astype("<u4").tobytes() == i and a.encode() == d
                                          for t, i, a, d in zip(theirs, coded, again, decoded)], pa.bool_()))
                    names.append("same_as_library")
                if with_ids:
                    cols.append(pa.array([np.frombuffer(i, dtype="<u4").astype(np.int32) for i in coded],
                                         pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    finally:
        c.forget()


def piece_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False, check: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens (begin and end ids counted), ids_sha256,
    decoded_sha256; with ``check`` also same_as_library, with ``with_ids`` the
    ids. One map over the documents, no shuffle."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
              + ", same_as_library boolean" * check + ", ids array<int>" * with_ids)
    return rows.mapInArrow(lambda it: _round_trip(it, path, with_ids, check), schema)
