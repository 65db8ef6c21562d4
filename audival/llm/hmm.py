"""LM scoring with a hidden Markov language model.

Latent states emit word classes and a class emits its words:
P(word | state) = E[state, class] * P(word | class). Every training word seen
``OWN_FROM`` times or more is a class of its own; the others back off to a
class shared by their last bytes, in which the unseen words have the
probability of its words seen once. The end of a text is a token. So the model
grows with the words of the corpus, and emissions are a Spark table, one row a
class, that never passes through the driver:

* ``runs``: texts become sequences of word numbers, a run of texts at a time;
* words are dealt into buckets by hash; a run's words of a bucket are one row,
  and so is what comes back to the run: their training counts and classes;
* the emission table has one row a bucket: its classes, their counts by state
  and, for each run, the places of the run's classes among them;
* Baum-Welch: in every round a bucket sends each run the emissions of its
  classes, the run sums its expected counts, and they are added up by bucket
  into the next table. The runs go through a round in ``PARTS`` parts, one
  after another, so only one part's emissions and counts are being shuffled.
  The driver has only the start and transition tables and the emission totals
  of the states. Training sequences are pieces of at most ``PIECE`` tokens, all
  texts whole;
* a text's score is the exact forward recursion over the whole text, scaled
  in every step.

Defined cases: a null or wordless text is one end token; a null doc_id hashes
as empty text; rows that repeat a doc_id are scored one by one; an empty table
gives no rows; without training texts the classes are uniform.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.llm.shared import (WHITE, Stages, WordBatch, byte_map, mix, release, runs_of, separators, small_batches,
                                stages, texts)

#: States, training count from which a word has a class of its own, shared
#: classes, Baum-Welch rounds, tokens of a training piece.
STATES, OWN_FROM, SHARED, ROUNDS, PIECE = 8, 2, 2048, 8, 256
#: Tokens of a run (one text is never cut) and of what is trained on at a time.
RUN_TOKENS, PART_TOKENS = 1 << 22, 1 << 19
#: Buckets of words for each shuffle partition, parts of the runs in a round.
BUCKETS, PARTS = 2, 3
_U64 = np.uint64
_END = np.int64(-7046029254386353131)
_CODED = ("run long, doc_ids array<long>, held array<boolean>, lengths binary, classes binary, "
          "n_classes int, places binary, shared binary, known array<long>, base array<double>, within array<double>")
_RUNS = ("run long, doc_ids array<long>, held array<boolean>, lengths binary, numbers binary, "
         "n_kinds int, kinds binary, counts binary, shapes binary")
_TABLE = ("bucket int, cls binary, weight binary, counts binary, runs array<long>, sizes array<int>, "
          "places array<binary>, sums array<double>")
_NEEDS = "run long, bucket int, n int, of int, places binary, emit binary"
_SUMS = "bucket int, n int, of int, places binary, sums binary"


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


# ------------------------------------------------------------------ the runs

def _runs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    sep, lower = separators(WHITE), byte_map(True)
    run = TaskContext.get().partitionId() << 32
    for got in batches:
        parts, begin = [], 0
        for lo, hi, data, offsets in runs_of(got.column("text")):
            batch = WordBatch(lower[data], offsets, sep)
            sizes = np.diff(batch.first) + 1
            tokens = np.full(int(sizes.sum()), _END)
            inner = np.ones(len(tokens), dtype=bool)
            inner[np.cumsum(sizes) - 1] = False
            tokens[inner] = batch.hashes(True).view(np.int64)
            shape = np.zeros(len(tokens), dtype=np.int32)
            shape[inner] = _shapes(batch)
            train = ~got.column("held").slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool)
            kinds, at, number = _distinct(tokens)
            count = np.bincount(number, weights=np.repeat(train, sizes), minlength=len(kinds))
            parts.append((sizes, number.astype(np.int32), kinds, count, shape[at]))
            if hi < got.num_rows and sum(len(x[1]) for x in parts) < RUN_TOKENS:
                continue
            yield _run(run, got.slice(begin, hi - begin), buckets, parts)
            parts, begin, run = [], hi, run + 1


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, a place of each, and the number of each value."""
    kinds, number = np.unique(x, return_inverse=True)
    at = np.empty(len(kinds), dtype=np.int64)
    at[number[::-1]] = np.arange(len(x))[::-1]
    return kinds, at, number


def _run(run: int, rows: pa.RecordBatch, buckets: int, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Texts as numbers among the run's distinct words, which are in order of bucket."""
    sizes, _, words, counts, shapes = (np.concatenate(x) for x in zip(*parts))
    kinds, at, number = _distinct(words)
    count = np.bincount(number, weights=counts, minlength=len(kinds))
    order = np.argsort(_bucket(kinds, buckets), kind="stable")
    place = np.empty(len(kinds), dtype="<i4")
    place[order] = np.arange(len(kinds))
    each = np.split(place[number], np.cumsum([len(x[2]) for x in parts])[:-1])
    numbers = np.concatenate([x[part[1]] for x, part in zip(each, parts)])
    return pa.RecordBatch.from_arrays(
        [pa.array([run], pa.int64()), _row(rows.column("doc_id")), _row(rows.column("held")), _blob(sizes.astype("<i4")),
         _blob(numbers), pa.array([len(kinds)], pa.int32()), _blob(kinds[order]), _blob(count[order].astype("<i4")),
         _blob(shapes[at][order])],
        names=["run", "doc_ids", "held", "lengths", "numbers", "n_kinds", "kinds", "counts", "shapes"])


def _shapes(batch: WordBatch) -> np.ndarray:
    """Shared class of each word, by its last three bytes."""
    out = np.zeros(len(batch.starts), dtype=_U64)
    for back in (1, 2, 3):
        at = batch.ends - back
        out = out * _U64(257) + np.where(at >= batch.starts, batch.data[np.maximum(at, 0)].astype(_U64) + _U64(1), _U64(0))
    return (mix(out) % _U64(SHARED)).astype(np.int32)


def _blob(x: np.ndarray) -> pa.Array:
    return pa.array([pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True) if len(x) else b""],
                    pa.binary())


def _row(values: pa.Array | np.ndarray) -> pa.Array:
    """A list column of one row."""
    values = values if isinstance(values, pa.Array) else pa.array(values)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _unblob(column: pa.Array, row: int, dtype: str, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, dtype=dtype)
    raw = pa.decompress(column[row].as_py(), decompressed_size=n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True)
    return np.frombuffer(raw, dtype=dtype)


def _dealt(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(bucket, run, tokens, counts, shapes): the distinct words of each run by bucket."""
    for got in batches:
        for row in range(got.num_rows):
            n = got.column("n_kinds")[row].as_py()
            kinds, counts, shapes = (_unblob(got.column(c), row, t, n) for c, t in
                                     (("kinds", "<i8"), ("counts", "<i4"), ("shapes", "<i4")))
            which, at = np.unique(_bucket(kinds, buckets), return_index=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(which), pa.array(np.full(len(which), got.column("run")[row].as_py()))]
                + [_cut(x, at) for x in (kinds, counts, shapes)], names=["bucket", "run", "tokens", "counts", "shapes"])


def _cut(x: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes of each stretch that begins at ``at``."""
    return pa.array([part.tobytes() for part in np.split(x, at[1:])], pa.binary())


def _joined(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    """All rows of a binary column, one after another."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=dtype)


def _counted(dealt: pa.Table) -> pa.Table:
    """(run, bucket, classes, ns): each run's words of a bucket with their
    training counts and classes; and, as run -1, the bucket's classes with
    their counts and numbers of words seen once and seen."""
    dealt = dealt.take(np.argsort(dealt.column("run").to_numpy()))
    tokens, first, number = _distinct(_joined(dealt.column("tokens"), "<i8"))
    n = np.bincount(number, weights=_joined(dealt.column("counts"), "<i4")).astype("<i8")
    cls = np.where((n >= OWN_FROM) | (tokens == _END), tokens, _joined(dealt.column("shapes"), "<i4")[first])
    sizes = np.array([len(x) // 8 for x in dealt.column("tokens").to_pylist()])
    at = np.cumsum(sizes) - sizes
    kinds, which = np.unique(cls, return_inverse=True)
    totals = [np.bincount(which, weights=x).astype("<i8").tobytes() for x in (n, n == 1, n > 0)]
    runs = pa.concat_arrays([dealt.column("run").combine_chunks(), pa.array([-1], pa.int64())])
    bucket = pa.array(np.full(len(runs), dealt.column("bucket")[0].as_py()), pa.int32())
    return pa.table(
        [runs, bucket, pa.concat_arrays([_cut(cls[number], at), pa.array([kinds.astype("<i8").tobytes()], pa.binary())]),
         pa.concat_arrays([_cut(n[number], at), pa.array([b"".join(totals)], pa.binary())])],
        names=["run", "bucket", "classes", "ns"])


def _class_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, n, once, words, classes) of a bucket's shared classes, and of all others together as class -1."""
    for got in batches:
        for cls, ns in zip(got.column("classes"), got.column("ns")):
            cls, ns = (np.frombuffer(x.as_buffer(), dtype="<i8") for x in (cls, ns))
            ns = np.concatenate([ns.reshape(3, -1), np.ones((1, len(cls)), dtype="<i8")])
            own = (cls < 0) | (cls >= SHARED)
            ns = np.concatenate([ns[:, ~own], ns[:, own].sum(axis=1, keepdims=True)], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.append(cls[~own], -1), *ns)],
                                             names=["cls", "n", "once", "words", "classes"])


@dataclass(frozen=True)
class ClassTables:
    """Training totals and, by shared class, the words' total and those seen once."""
    total: int
    words: int
    mass: np.ndarray
    once: np.ndarray

    def log_unigram(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.total + 0.1 * (self.words + 1)))

    def log_within(self, count: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """log10 P(word | class)."""
        shared = (cls >= 0) & (cls < SHARED)
        at = np.where(shared, cls, 0)
        mass, once = self.mass[at], self.once[at] + 0.5
        return np.where(shared, np.log10(np.where(count > 0, count, once) / (mass + once)), 0.0)


@dataclass(frozen=True)
class Words:
    """The stored words of all runs by bucket, and the weight of all classes."""
    rows: DataFrame
    tables: ClassTables
    weight: float
    store: Stages


def _bucket(cls: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(cls.astype(np.int64).view(_U64) ^ _U64(0x5851F42D4C957F2D)) % _U64(buckets)).astype(np.int32)


def _code(run: pa.Table, words: pa.Table, tables: ClassTables, buckets: int) -> pa.Table:
    """A run with its words' counts and classes: class sequences as ranks
    among the run's classes, most frequent first, each rank's place among them
    in order of bucket and class, and per text the sums that do not depend on
    the states."""
    words = words.take(np.argsort(words.column("bucket").to_numpy()))
    count, cls = _joined(words.column("ns"), "<i8"), _joined(words.column("classes"), "<i8")
    ids, held = (run.column(c)[0].values for c in ("doc_ids", "held"))
    sizes = _unblob(run.column("lengths"), 0, "<i4", len(ids)).astype(np.int64)
    number = _unblob(run.column("numbers"), 0, "<i4", int(sizes.sum()))
    at = np.cumsum(sizes) - sizes
    sums = [np.add.reduceat(x[number], at) for x in
            ((count > 0).astype(np.int64), tables.log_unigram(count), tables.log_within(count, cls))]
    kinds, local = np.unique(cls, return_inverse=True)
    place = np.empty(len(kinds), dtype="<i4")
    place[np.argsort(_bucket(kinds, buckets), kind="stable")] = np.arange(len(kinds))
    local = local.astype("<i4")[number]
    order = np.argsort(-np.bincount(local, minlength=len(kinds)), kind="stable")
    rank = np.empty(len(kinds), dtype="<i4")
    rank[order] = np.arange(len(kinds))
    shared = kinds[(kinds >= 0) & (kinds < SHARED)].astype("<i8")
    return pa.table(
        [run.column("run"), _row(ids), _row(held), run.column("lengths"), _blob(rank[local]),
         pa.array([len(kinds)], pa.int32()), _blob(place[order]), pa.array([shared.tobytes()], pa.binary())]
        + [_row(x) for x in sums],
        names=["run", "doc_ids", "held", "lengths", "classes", "n_classes", "places", "shared", "known", "base", "within"])


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, run, kinds, ns): a run's words of a bucket that are classes of
    their own; as run -1 the bucket's with their counts."""
    for got in batches:
        for row in range(got.num_rows):
            run, cls = got.column("run")[row].as_py(), np.frombuffer(got.column("classes")[row].as_buffer(), dtype="<i8")
            own, ns = (cls < 0) | (cls >= SHARED), None
            if run < 0:
                ns = np.frombuffer(got.column("ns")[row].as_buffer(), dtype="<i8")[:len(cls)][own].tobytes()
            if own.any():
                yield pa.RecordBatch.from_arrays(
                    [got.column("bucket").slice(row, 1), got.column("run").slice(row, 1),
                     pa.array([np.unique(cls[own]).tobytes()], pa.binary()), pa.array([ns], pa.binary())],
                    names=["bucket", "run", "kinds", "ns"])


def _shared(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The same of a run's shared classes, whose buckets are not their words'."""
    for got in batches:
        for row in range(got.num_rows):
            kinds = np.frombuffer(got.column("shared")[row].as_buffer(), dtype="<i8")
            bucket = _bucket(kinds, buckets)
            which, at = np.unique(np.sort(bucket), return_index=True)
            if len(which):
                run = np.full(len(which), got.column("run")[row].as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which), pa.array(run), _cut(kinds[np.argsort(bucket, kind="stable")], at),
                     pa.nulls(len(which), pa.binary())], names=["bucket", "run", "kinds", "ns"])


# ------------------------------------------------------------------ the model

@dataclass(frozen=True)
class Model:
    start: np.ndarray  # state of a text's first token
    inside: np.ndarray  # state of a training piece's first token
    move: np.ndarray
    emit: np.ndarray  # class x state


def first_emissions(prior: np.ndarray, cls: np.ndarray, states: int) -> np.ndarray:
    """Near the class frequencies, with a disturbance fixed by class and state."""
    salt = np.arange(1, 2 * states + 1, dtype=_U64) * _U64(0xD6E8FEB86659FD93)
    even = (mix(cls.astype(np.int64).view(_U64)[:, None] ^ salt) >> _U64(11)).astype(float) / 2**53
    normal = np.sqrt(-2 * np.log(even[:, :states] + 2**-54)) * np.cos(2 * np.pi * even[:, states:])
    return prior[:, None] * np.exp(0.7 * normal)


def first_model(prior: np.ndarray, states: int) -> Model:
    """Every state near the class frequencies; states tend to stay."""
    emit = first_emissions(prior, np.arange(len(prior)), states)
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    even = np.full(states, 1 / states)
    return Model(even, even, move, emit / emit.sum(axis=0))


def forward(model: Model, cls: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 P(class sequence) of each text, all texts in step."""
    order = np.argsort(-sizes, kind="stable")
    at, sizes = at[order], sizes[order]
    live = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), side="right") if len(sizes) else []
    out = np.zeros(len(at))
    alpha = np.zeros((len(at), len(model.start)))
    for t, n in enumerate(live):
        step = model.emit[cls[at[:n] + t]]
        alpha = (model.start if t == 0 else alpha[:n] @ model.move) * step
        scale = alpha.sum(axis=1)
        out[:n] += np.log10(scale)
        alpha /= scale[:, None]
    back = np.empty(len(at))
    back[order] = out
    return back


def expected_counts(model: Model, cls: np.ndarray, at: np.ndarray, sizes: np.ndarray, first: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch sums over pieces: starts, inside starts, moves, emissions.
    All pieces in step, a row a state; floats are those of ``model.emit``."""
    states, real = len(model.start), model.emit.dtype
    order = np.argsort(-sizes, kind="stable")
    at, sizes, first = at[order], sizes[order], first[order]
    live = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), side="right")
    edge = np.concatenate([[0], np.cumsum(live)])
    which = np.concatenate([cls[at[:n] + t] for t, n in enumerate(live)]).astype(np.intp)
    step = np.take(np.ascontiguousarray(model.emit.T), which, axis=1)  # each token's emissions, then over its scale
    post = np.empty_like(step)
    on, back = np.ascontiguousarray(model.move.T, dtype=real), model.move.astype(real)
    alpha = np.where(first, model.start[:, None], model.inside[:, None]).astype(real)
    for t, n in enumerate(live):
        now = step[:, edge[t]:edge[t + 1]]
        alpha = (on @ alpha[:, :n] if t else alpha) * now
        scale = 1 / alpha.sum(axis=0)
        alpha *= scale
        now *= scale
        post[:, edge[t]:edge[t + 1]] = alpha
    move = np.zeros((states, states))
    beta = np.ones((states, 0), dtype=real)
    for t in range(len(live) - 1, -1, -1):
        here, now = post[:, edge[t]:edge[t + 1]], np.ones((states, int(live[t])), dtype=real)
        if m := beta.shape[1]:
            onward = beta * step[:, edge[t + 1]:edge[t + 2]]
            move += here[:, :m] @ onward.T
            now[:, :m] = back @ onward
        here *= now  # from here on the states' posterior
        scale = 1 / here.sum(axis=0)
        here *= scale
        beta = now * scale
    emit = np.empty((states, len(model.emit)))
    for k in range(states):
        emit[k] = np.bincount(which, weights=post[k], minlength=len(model.emit))
    opening = post[:, :len(sizes)]
    return (opening[:, first].sum(axis=1, dtype=float), opening[:, ~first].sum(axis=1, dtype=float), move * model.move,
            emit.T)


def _pieces(sizes: np.ndarray, train: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = np.cumsum(sizes) - sizes
    at, sizes = at[train], sizes[train]
    parts = -(-sizes // piece)
    text = np.repeat(np.arange(len(sizes)), parts)
    k = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    return at[text] + k * piece, np.minimum(piece, sizes[text] - k * piece), k == 0


def _first(index: pa.Table, tables: ClassTables, total: float, states: int) -> pa.Table:
    """A bucket's row of the first emission table."""
    kinds = {}
    for run, x in zip(index.column("run").to_pylist(), index.column("kinds").to_pylist()):
        kinds.setdefault(run, []).append(np.frombuffer(x, dtype="<i8"))
    own = kinds.pop(-1, [np.zeros(0, dtype="<i8")])[0]
    runs = {run: np.unique(np.concatenate(x)) for run, x in sorted(kinds.items())}
    shared = np.unique(np.concatenate([own[:0], *(x[(x >= 0) & (x < SHARED)] for x in runs.values())]))
    # unseen words get weight in a class even where no training word is
    weight = np.concatenate([_joined(index.column("ns").drop_null(), "<i8"), tables.mass[shared] + tables.once[shared]]) + 0.5
    cls = np.concatenate([own, shared])
    order = np.argsort(cls)
    cls, weight = cls[order], weight[order]
    places = [np.searchsorted(cls, x) for x in runs.values()]
    counts = first_emissions(weight / total, cls, states)
    return _bucket_row(index.column("bucket")[0].as_py(), cls.tobytes(), weight.tobytes(), counts, counts.sum(axis=0),
                       list(runs), [len(at) for at in places],
                       [_blob(np.diff(at, prepend=0).astype("<i4"))[0].as_py() for at in places])


def _bucket_row(bucket: int, cls: bytes, weight: bytes, counts: np.ndarray, sums: np.ndarray, runs: list, sizes: list,
                places: list) -> pa.Table:
    return pa.table(
        [pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in (cls, weight, counts.astype("<f4").tobytes())),
         pa.array([runs], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
         pa.array([places], pa.list_(pa.binary())), _row(sums)],
        names=["bucket", "cls", "weight", "counts", "runs", "sizes", "places", "sums"])


def _places(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(np.frombuffer(pa.decompress(blob, decompressed_size=4 * n, codec="zstd"), dtype="<i4"))


def _part(run: int, parts: int) -> int:
    return ((run >> 32) + run) % parts


def _spread(batches: Iterator[pa.RecordBatch], norm: np.ndarray, part: int, parts: int) -> Iterator[pa.RecordBatch]:
    """What the runs of a part need of each bucket."""
    states = len(norm)
    for got in batches:
        for row in range(got.num_rows):
            share = np.frombuffer(got.column("counts")[row].as_buffer(), dtype="<f4").reshape(-1, states)
            share = (share / norm).astype("<f4")
            for run, n, places in zip(*(got.column(c)[row].as_py() for c in ("runs", "sizes", "places"))):
                if _part(run, parts) == part:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([run], pa.int64()), got.column("bucket").slice(row, 1), pa.array([n], pa.int32()),
                         pa.array([len(share)], pa.int32()), pa.array([places], pa.binary()),
                         pa.array([share[_places(places, n)].tobytes()], pa.binary())],
                        names=["run", "bucket", "n", "of", "places", "emit"])


def _gathered(coded: pa.Table, needs: pa.Table, states: int
              ) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A run's rows of the emission table by bucket, and with them its
    emissions by rank, the ranks' places, lengths, classes and texts held out."""
    needs = needs.take(np.argsort(needs.column("bucket").to_numpy()))
    places = _unblob(coded.column("places"), 0, "<i4", coded.column("n_classes")[0].as_py())
    emit = _joined(needs.column("emit"), "<f4").reshape(-1, states)[places]
    held = coded.column("held")[0].values.to_numpy(zero_copy_only=False).astype(bool)
    sizes = _unblob(coded.column("lengths"), 0, "<i4", len(held)).astype(np.int64)
    cls = _unblob(coded.column("classes"), 0, "<i4", int(sizes.sum()))
    return needs, emit, places, sizes, cls, held


def _expect(coded: pa.Table, needs: pa.Table, model: Model, piece: int, buckets: int) -> pa.Table:
    """A run's expected counts by bucket; its starts and moves are a row of a
    bucket below zero."""
    states = len(model.start)
    needs, emit, places, sizes, cls, held = _gathered(coded, needs, states)
    # what a class's emissions have in common does not change the states' posterior
    emit = np.asfortranarray(emit)
    emit /= emit.sum(axis=1, keepdims=True)
    model = Model(model.start, model.inside, model.move, emit)
    at, size, first = _pieces(sizes, ~held, piece)
    part = np.cumsum(size) // PART_TOKENS
    total = [np.zeros(states), np.zeros(states), np.zeros((states, states)), np.zeros(emit.shape[::-1]).T]
    for k in np.unique(part):
        which = part == k
        for x, y in zip(total, expected_counts(model, cls, at[which], size[which], first[which])):
            x += y
    n = needs.column("n").to_numpy()
    sums = np.empty(emit.shape, dtype="<f4")
    sums[places] = total[3]
    sums = _cut(sums, np.cumsum(n) - n)
    run = coded.column("run")[0].as_py()
    moves = np.concatenate([x.ravel() for x in total[:3]]).tobytes()
    return pa.table([pa.array([*needs.column("bucket").to_pylist(), -1 - _part(run, buckets)], pa.int32()),
                     pa.array([*n, 0], pa.int32()), pa.array([*needs.column("of").to_pylist(), 0], pa.int32()),
                     pa.array([*needs.column("places").to_pylist(), None], pa.binary()),
                     pa.concat_arrays([sums, pa.array([moves], pa.binary())])], names=["bucket", "n", "of", "places", "sums"])


def _add(sums: pa.Table, counts: np.ndarray) -> np.ndarray:
    """Rows without places are sums of all the bucket's classes."""
    for n, places, x in zip(*(sums.column(c) for c in ("n", "places", "sums"))):
        x = np.frombuffer(x.as_buffer(), dtype="<f4").reshape(-1, counts.shape[1])
        if places.is_valid:
            counts[_places(places.as_py(), n.as_py())] += x
        else:
            counts += x
    return counts


def _moves(sums: pa.Table) -> np.ndarray:
    return np.sum([np.frombuffer(x.as_buffer()) for x in sums.column("sums")], axis=0)


def _so_far(sums: pa.Table, states: int) -> pa.Table:
    """The sums of a bucket over the parts up to now, a row without places."""
    bucket, of = sums.column("bucket")[0].as_py(), sums.column("of")[0].as_py()
    got = _moves(sums) if bucket < 0 else _add(sums, np.zeros((of, states))).astype("<f4")
    return pa.table([pa.array([bucket], pa.int32()), pa.array([of], pa.int32()), pa.array([of], pa.int32()),
                     pa.array([None], pa.binary()), pa.array([got.tobytes()], pa.binary())],
                    names=["bucket", "n", "of", "places", "sums"])


def _update(sums: pa.Table, table: pa.Table, total: float, states: int) -> pa.Table:
    """The next row of a bucket; below zero one row of starts and moves."""
    if not table.num_rows:
        return _bucket_row(sums.column("bucket")[0].as_py(), b"", b"", np.zeros((0, states)), _moves(sums), [], [], [])
    row = table.to_pylist()[0]
    counts = _add(sums, np.repeat(5.0 * np.frombuffer(row["weight"])[:, None] / total, states, axis=1))
    return _bucket_row(row["bucket"], row["cls"], row["weight"], counts, counts.sum(axis=0), row["runs"], row["sizes"],
                       row["places"])


def _emissions(batches: Iterator[pa.RecordBatch], states: int) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for row in range(got.num_rows):
            cls, weight, counts = (np.frombuffer(got.column(c)[row].as_buffer(), dtype=t) for c, t in
                                   (("cls", "<i8"), ("weight", "<f8"), ("counts", "<f4")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(cls), got.column("bucket")[row].as_py(), dtype="<i4")), pa.array(cls),
                 pa.array(weight), pa.ListArray.from_arrays(pa.array(np.arange(len(cls) + 1) * states, pa.int32()),
                                                            pa.array(counts.astype(float)))],
                names=["bucket", "cls", "weight", "counts"])


@dataclass(frozen=True)
class Trained:
    model: Model  # without emissions
    table: DataFrame  # the emission table, a row a bucket
    norm: np.ndarray  # its counts' sums by state
    emissions: DataFrame  # bucket, cls, weight, counts by state: a row a class


def _totals(table: DataFrame, states: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the counts by state, and of starts and moves: of the model's
    fixed size, whatever the corpus."""
    norm, flat = np.zeros(states), np.full(2 * states + states * states, 1e-3)
    for r in table.select((F.col("bucket") < 0).alias("moves"), F.posexplode("sums").alias("place", "value")).groupBy(
            "moves", "place").agg(F.sum("value").alias("value")).collect():
        (flat if r["moves"] else norm)[r["place"]] += r["value"]
    return np.where(norm > 0, norm, 1.0), flat


def spread_emissions(table: DataFrame, norm: np.ndarray, part: int = 0, parts: int = 1) -> DataFrame:
    return table.filter("bucket >= 0").select("bucket", "counts", "runs", "sizes", "places").mapInArrow(
        lambda it: _spread(it, norm, part, parts), _NEEDS)


def train(coded: DataFrame, words: Words, states: int, rounds: int, piece: int, buckets: int, parts: int = PARTS
          ) -> Trained:
    """Removes the stored words once the emission table is made of them."""
    spark, tables, total = coded.sparkSession, words.tables, words.weight
    model, store = first_model(np.ones(1), states), stages(spark)
    parted = "bucket int, run long, kinds binary, ns binary"
    index = words.rows.mapInArrow(_own, parted).unionByName(
        coded.select("run", "shared").mapInArrow(lambda it: _shared(it, buckets), parted))
    with small_batches(spark, 16):
        table = store.write(index.groupBy("bucket").applyInArrow(lambda a: _first(a, tables, total, states), _TABLE), "table")
    words.store.discard()
    release(spark)
    norm, _ = _totals(table, states)
    for _ in range(rounds):
        so_far, last = None, store
        for part in range(parts):
            needs = spread_emissions(table, norm, part, parts)
            rows = coded.filter(F.pmod(F.shiftright("run", 32) + F.col("run"), F.lit(parts)) == part)
            sums = rows.select("run", "held", "lengths", "classes", "n_classes", "places").groupBy("run").cogroup(needs.groupBy("run")).applyInArrow(
                lambda a, b: _expect(a, b, model, piece, buckets), _SUMS)
            sums, before, store = sums.unionByName(so_far) if part else sums, store, stages(spark)
            with small_batches(spark, 16):
                if part < parts - 1:
                    so_far = store.write(sums.groupBy("bucket").applyInArrow(lambda a: _so_far(a, states), _SUMS), "sums")
                else:
                    table = store.write(sums.groupBy("bucket").cogroup(table.filter("bucket >= 0").groupBy("bucket")).applyInArrow(
                        lambda a, b: _update(a, b, total, states), _TABLE), "table")
            if part:
                before.discard()
            release(spark)
        last.discard()
        norm, flat = _totals(table, states)
        start, inside, move = flat[:states], flat[states:2 * states], flat[2 * states:].reshape(states, states)
        model = Model(start / start.sum(), inside / inside.sum(), move / move.sum(axis=1, keepdims=True), model.emit)
    emissions = table.filter("bucket >= 0").select("bucket", "cls", "weight", "counts").mapInArrow(
        lambda it: _emissions(it, states), "bucket int, cls long, weight double, counts array<double>")
    return Trained(model, table, norm, emissions)


def _score(coded: pa.Table, needs: pa.Table, model: Model) -> pa.Table:
    _, emit, _, sizes, cls, held = _gathered(coded, needs, len(model.start))
    model = Model(model.start, model.inside, model.move, emit.astype(float))
    states = forward(model, cls, np.cumsum(sizes) - sizes, sizes)
    known, base, within = (coded.column(c)[0].values for c in ("known", "base", "within"))
    return pa.table([coded.column("doc_ids")[0].values, pa.array(held), pa.array(sizes), known, base,
                     pa.array(states + within.to_numpy())],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def coded_runs(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> tuple[DataFrame, Words, ClassTables]:
    """The coded runs, the words of all runs, and the totals."""
    spark = docs.sparkSession
    store, early, kept = (stages(spark) for _ in range(3))
    rows = texts(docs, id_col, text_col).withColumn("held", crc_of_id(F.col("doc_id")) % 10 == 0)
    runs = early.write(rows.mapInArrow(lambda it: _runs(it, buckets), _RUNS), "runs")
    dealt = runs.select("run", "n_kinds", "kinds", "counts", "shapes").mapInArrow(
        lambda it: _dealt(it, buckets), "bucket int, run long, tokens binary, counts binary, shapes binary")
    with small_batches(spark, 4):  # rows are whole runs
        words = kept.write(dealt.groupBy("bucket").applyInArrow(
            _counted, "run long, bucket int, classes binary, ns binary"), "words")
    release(spark)
    sums = words.filter("run < 0").select("classes", "ns").mapInArrow(
        _class_totals, "cls long, n long, once long, words long, classes long").groupBy("cls").agg(
        *[F.sum(c).alias(c) for c in ("n", "once", "words", "classes")]).toPandas()  # SHARED + 1 rows at most
    shared = sums[sums["cls"] >= 0]
    mass, once = np.zeros(SHARED), np.zeros(SHARED)
    mass[shared["cls"]], once[shared["cls"]] = shared["n"], shared["once"]
    tables = ClassTables(int(sums["n"].sum()), int(sums["words"].sum()), mass, once)
    classes = len(shared) + int(sums[sums["cls"] < 0]["classes"].sum())
    weight = float(tables.total + once.sum() + 0.5 * classes) or 1.0

    with small_batches(spark, 4):
        coded = store.write(
            runs.select("run", "doc_ids", "held", "lengths", "numbers").groupBy("run").cogroup(
                words.filter("run >= 0").groupBy("run")).applyInArrow(lambda a, b: _code(a, b, tables, buckets), _CODED),
            "coded")
    early.discard()  # all that is needed from here on is in the coded runs and the words
    release(spark)
    return coded, Words(words, tables, weight, kept), tables


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = STATES,
                rounds: int = ROUNDS, piece: int = PIECE) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (unigram), score (log10 probability under the model)."""
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded, words, tables = coded_runs(docs, id_col, text_col, buckets)
    trained = train(coded, words, states, rounds, piece, buckets)
    needs = spread_emissions(trained.table, trained.norm)
    model = trained.model
    scored = coded.drop("shared").groupBy("run").cogroup(needs.groupBy("run")).applyInArrow(
        lambda a, b: _score(a, b, model),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tables.total).cast("long").alias("train_tokens"),
        "base_score", "score")
