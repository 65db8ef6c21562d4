"""BPE encoding and decoding as streaming transducers.

Encoding reads a text piece by piece. A piece longer than the buffer is fed to
a bounded-lookahead transducer: from the merge list we compute how many bytes
to the right of a boundary can still decide whether a merge crosses it
(``sufficient_lookahead``); a token that ends at least that far before the end
of the buffer is stable, is emitted and forgotten. Since no merge ever crosses
a stable boundary, the rest is encoded as if it stood alone, so memory is
constant and the ids are those of the whole word. Short words go through the
same merges and are remembered in a table of bounded size.

Decoding is an incremental state machine: ids become bytes, bytes become text
as soon as a character is complete.

Defined cases: a null text is empty and gives no ids; the vocabulary's special
strings are their own tokens; repeated ids and extra columns do not matter.
"""

from __future__ import annotations

import bisect
import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audival.llm.shared import ship

#: Words remembered per Python worker, in each of two generations.
REMEMBERED = 1 << 18
#: Longer words (in characters) are never remembered.
SHORT = 48
#: Fixed: how the vocabulary's file marks the end of a word, and its word pattern.
WORD_END = "</w>"
_WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+""")
_SPACES = regex.compile(r"\p{White_Space}+")
#: Letters and numbers of a later Unicode than Python's: libraries need not agree on them.
_LATER = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
                 if unicodedata.category(c) == "Cn")
_LATER_SET = frozenset(_LATER)


def _ranges(chars: str) -> str:
    """The inside of a character class of the given characters, in order: a
    class is tried part by part, so neighbours are one range."""
    if not chars:
        return ""
    cuts = [i for i in range(1, len(chars)) if ord(chars[i]) != ord(chars[i - 1]) + 1]
    return "".join(f"{chars[a]}-{chars[b - 1]}" for a, b in zip([0, *cuts], [*cuts, len(chars)]))


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary files:
    printable Latin-1 characters stand for themselves, the others for the
    characters from U+0100 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Transducer:
    """The merges of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, marks = spec["model"]["vocab"], byte_alphabet()
        self.inner = [vocab[c] for c in marks]
        self.final = [vocab[c + WORD_END] for c in marks]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            self.rules[vocab[a], vocab[b]] = (rank, vocab[a + b])
        back = {c: bytes([b]) for b, c in enumerate(marks)}
        self.raw = {i: b"".join(back[c] for c in s.removesuffix(WORD_END)) + b" " * s.endswith(WORD_END)
                    for s, i in vocab.items()} | {i: s.encode() for s, i in self.special.items()}
        self.token_bytes = [self.strings.get(i, "").encode() for i in range(max(self.strings) + 1)]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.lookahead = sufficient_lookahead(self.rules)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.path, self.settled = path, None

    def settled_words(self, text: str) -> list[str]:
        """The words of a text with some of ``_LATER``, with the vocabulary
        library's own normal form and view of what they are."""
        if self.settled is None:
            from tokenizers import Tokenizer
            library = Tokenizer.from_file(self.path)
            self.normal, cut = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
            other = _ranges("".join(c for c in _LATER if len(cut("a" + c)) > 1 and len(cut("!" + c)) == 1))
            none = f"--[{other}]" if other else ""
            self.settled = regex.compile(
                rf"""'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}{none}]+|[\p{{N}}{none}]|"""
                rf"""(?:[^\p{{White_Space}}\p{{L}}\p{{N}}]{f"|[{other}]" if other else ""})+""", regex.V1)
        return self.settled.findall(self.normal(text))

    # ------------------------------------------------------------- encoding

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges to symbols, the earliest rule first."""
        rules = self.rules
        while len(ids) > 1:
            best, to, pair = 1 << 60, 0, None
            for two in zip(ids, ids[1:]):
                rule = rules.get(two)
                if rule is not None and rule[0] < best:
                    best, to = rule
                    pair = two
            if pair is None:
                break
            a, b = pair
            out, i, n = [], 0, len(ids)
            while i < n:
                if i + 1 < n and ids[i] == a and ids[i + 1] == b:
                    out.append(to)
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids

    def stream(self, pieces: Iterable[bytes], room: int | None = None) -> Iterator[int]:
        """Ids of one word that arrives in pieces, each as soon as it is
        stable. At most ``room`` bytes wait (four lookaheads by default)."""
        room = room or 4 * self.lookahead
        wait = bytearray()
        for piece in pieces:
            for at in range(0, len(piece), room):
                wait += piece[at:at + room]
                if len(wait) <= room:
                    continue
                # the last byte is held back: it may be the one that ends the word
                ids, end = self.merge([self.inner[b] for b in wait[:-1]]), 0
                for i in ids:
                    if end + self.width(i) > len(wait) - 1 - self.lookahead:
                        break
                    end += self.width(i)
                    yield i
                del wait[:end]
        if wait:
            yield from self.merge([self.inner[b] for b in wait[:-1]] + [self.final[wait[-1]]])

    def width(self, token: int) -> int:
        return len(self.strings[token].removesuffix(WORD_END))

    def word(self, word: str) -> bytes:
        """Ids of a word as little-endian 32-bit integers."""
        got = self.old.get(word)
        if got is None:
            raw = word.encode()
            if len(word) <= SHORT:
                ids = self.merge([self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]])
            else:
                return np.fromiter(self.stream([raw]), dtype="<u4").tobytes()
            got = np.array(ids, dtype="<u4").tobytes()
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[word] = got
        return got

    def encode(self, text: str) -> bytes:
        if self.cut is not None and "<|" in text:
            return b"".join(np.array([self.special[t]], dtype="<u4").tobytes() if t in self.special else self.plain(t)
                            for t in self.cut.split(text) if t)
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        if not text.isascii():
            if not _LATER_SET.isdisjoint(text):
                return self._ids(self.settled_words(text))
            # lower case is taken character by character: no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self._ids(_WORDS.findall(_SPACES.sub(" ", text).lower()))

    def _ids(self, words: list[str]) -> bytes:
        known, out = self.young, []
        for w in words:
            ids = known.get(w)
            if ids is None:
                ids = self.word(w)
                known = self.young
            out.append(ids)
        return b"".join(out)

    # ------------------------------------------------------------- decoding

    def decode_pieces(self, ids: bytes, size: int = 4096) -> Iterator[bytes]:
        """The vocabulary strings of the ids with a space between them, in
        UTF-8, piece by piece (the file has no decoder of its own)."""
        sep = b""
        for at in range(0, len(ids), 4 * size):
            part = np.frombuffer(ids[at:at + 4 * size], dtype="<u4").tolist()
            yield sep + b" ".join([self.token_bytes[i] for i in part])
            sep = b" "

    def decode_text(self, ids: Iterable[int]) -> Iterator[str]:
        """The plain text, word ends as spaces: bytes wait until they are a
        whole character."""
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            if text := state.decode(self.raw[i]):
                yield text
        if text := state.decode(b"", final=True):
            yield text


def sufficient_lookahead(rules: dict[tuple[int, int], tuple[int, int]]) -> int:
    """Bytes right of a boundary that can decide whether a merge crosses it.

    A rule (u, v) at a boundary needs v, and v is formed unless an earlier rule
    takes one of the parts at its right edge away; that rule needs its own
    right side, and so on with ever earlier rules. The longest such chain,
    summed in bytes, is found rule by rule in order of rank."""
    made = {to: (a, b, rank) for (a, b), (rank, to) in rules.items()}
    width: dict[int, int] = {}

    def size(t: int) -> int:
        if t not in width:
            width[t] = size(made[t][0]) + size(made[t][1]) if t in made else 1
        return width[t]

    ranks: dict[int, list[int]] = {}
    reach: dict[int, list[int]] = {}  # running maximum over the rules of a left part
    most = 1
    for (a, b), (rank, _) in sorted(rules.items(), key=lambda r: r[1][0]):
        beyond, part, until = 0, b, rank
        while True:
            if part in ranks and (k := bisect.bisect_left(ranks[part], until)):
                beyond = max(beyond, reach[part][k - 1])
            if part not in made:
                break
            until, part = made[part][2], made[part][1]
        need = size(b) + beyond
        ranks.setdefault(a, []).append(rank)
        reach.setdefault(a, []).append(max(need, reach[a][-1] if reach.get(a) else 0))
        most = max(most, need)
    return most


_loaded: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One per Python worker and file, so remembered words outlive a task."""
    if path not in _loaded:
        _loaded[path] = Transducer(path)
    return _loaded[path]


def _round_trip(batches: Iterator[pa.RecordBatch], path: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    t = transducer(path)
    for got in batches:
        for lo in range(0, got.num_rows, 512):
            part = got.slice(lo, 512)
            n, ids_sha, text_sha, ids_out = [], [], [], []
            for text in part.column(part.num_columns - 1).to_pylist():
                ids = t.encode(text)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                decoded = hashlib.sha256()
                for piece in t.decode_pieces(ids):
                    decoded.update(piece)
                text_sha.append(decoded.hexdigest())
                ids_out.append(ids)
            cols = [part.column(i) for i in range(part.num_columns - 1)]
            cols += [pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(text_sha)]
            if with_ids:
                cols.append(pa.array([np.frombuffer(i, dtype="<u4").astype(np.int32) for i in ids_out], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(cols, names=[f"c{i}" for i in range(len(cols))])


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if
    asked for, the ids. One map over the documents, no shuffle."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(lambda it: _named(_round_trip(it, path, with_ids), schema), schema)


def _named(batches: Iterator[pa.RecordBatch], schema: str) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in schema.split(", ")]
    for b in batches:
        yield b.rename_columns(names)
