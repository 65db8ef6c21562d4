"""Near-duplicates by MinHash with tensored banding.

A plain banding of L tables with keys of k minima computes L * k minima. Here
each document computes two small collections of ``SIDE`` keys of ``MINIMA``
minima; table (i, j) is keyed by left key i together with right key j. That is
SIDE**2 tables with keys of 2 * MINIMA minima for only 2 * SIDE * MINIMA minima:
about the square root. A pair with similarity s meets in a table with
probability (1 - (1 - s**MINIMA)**SIDE)**2: 0.9998 at s = 0.75, 0.001 at s = 0.2
(texts that share a passage).

1. Rows with equal shingle sets (size and 128-bit sum) are one class; each
   class has a number, and only one row of each class is compared.
2. Tables are not listed: members are dealt by left key, those without a shared
   left and a shared right key being dropped, and right keys are looked at
   when two are compared.
3. Candidates are confirmed on full shingle sets. Under each left key every member
   is first compared with one hub (the member with most mates), then the
   members outside the largest component with a second hub. What is then
   still with members of other components is looked at by its rarest shingles:
   two sets that are similar enough have one of those in common, so texts that
   share most of their words but are not similar are never listed pair by
   pair. No candidate is skipped: a pair is left out only when both are already
   connected or their sets cannot be similar enough.

Defined cases: a text without words has an empty set, is linked with nothing
and is its own component; a text with fewer than five words has its whole word
sequence as one shingle. Rows that repeat a doc_id are linked by their own
texts, each of them. A component is named by its smallest doc_id; rows without
a doc_id are linked like others, and a component of such rows alone has no
name. ``kept`` marks the rows of the named document; where a component has
several (or no name), ``drop_near_duplicates`` leaves one row of it. An empty
table gives no rows; other columns are not touched. Rows of one doc_id are
told apart by a 64-bit hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.llm.graph import components
from audival.llm.shared import (WHITE, Stages, WordBatch, grams, mix, one_each, release, runs_of, separators,
                                small_batches, stages, texts)

#: Words of a shingle; keys per side; minima per key.
SHINGLE, SIDE, MINIMA = 5, 24, 4
#: Similarity as a ratio of whole numbers.
NUMERATOR, DENOMINATOR = 75, 100
#: Rounds with hubs before the remaining pairs are looked for by rare shingles.
HUB_ROUNDS = 2
#: Keys of texts that are sent to the tasks at a time, parts in which texts are looked for.
SENT, PARTS = 1 << 20, 8
#: What tells shingle sets apart.
CLASS = ["f1", "f2", "n_shingles"]
_U64 = np.uint64


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    sep = separators(WHITE)
    for lo, hi, data, offsets in runs_of(column):
        batch = WordBatch(data, offsets, sep)
        words = batch.hashes(True)
        flat = grams(words, size, size)
        for a, b in zip(batch.first[:-1].tolist(), batch.first[1:].tolist()):
            if b - a >= size:
                got = np.sort(flat[a:b - size + 1])
                yield got[np.concatenate([[True], got[1:] != got[:-1]])]
            else:
                yield grams(words[a:b], b - a, b - a) if b > a else np.zeros(0, dtype=_U64)


def _families(side: int, minima: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    n = 2 * side * minima
    return (r.integers(0, 2**64 - 1, n, dtype=_U64, endpoint=True),
            r.integers(0, 2**64 - 1, n, dtype=_U64, endpoint=True) | _U64(1))


def _sums(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a shingle set."""
    if not len(s):
        return 0, 0
    return np.add.reduce(s).astype(np.int64), np.add.reduce(mix(s ^ _U64(0xA5A5A5A5A5A5A5A5))).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch], side: int, minima: int) -> Iterator[pa.RecordBatch]:
    flip, times = _families(side, minima)
    salt = np.arange(1, 2 * side + 1, dtype=_U64) * _U64(0xD6E8FEB86659FD93)
    for got in batches:
        n, first, second, keys = [], [], [], []
        for s in shingle_sets(got.column("text")):
            n.append(len(s))
            one, two = _sums(s)
            first.append(one)
            second.append(two)
            if not len(s):
                keys.append(None)
                continue
            low = np.full(len(flip), 2**64 - 1, dtype=_U64)
            for at in range(0, len(s), 4096):
                np.minimum(low, ((s[at:at + 4096, None] ^ flip) * times).min(axis=0), out=low)
            key = salt.copy()
            for part in low.reshape(2 * side, minima).T:
                key = mix(key + part)
            keys.append(key.astype(np.int64))
        yield pa.RecordBatch.from_arrays(
            [got.column("doc_id"), got.column("key"), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()),
             pa.array([None if k is None else k[:side] for k in keys], pa.list_(pa.int64())),
             pa.array([None if k is None else k[side:] for k in keys], pa.list_(pa.int64()))],
            names=["doc_id", "key", "n_shingles", "f1", "f2", "lefts", "rights"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        sets = list(shingle_sets(got.column("text")))
        sums = [_sums(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in sums], pa.int64()), pa.array([b for _, b in sums], pa.int64()),
             pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=[*CLASS, "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch], numerator: int, denominator: int) -> Iterator[pa.RecordBatch]:
    for got in batches:
        linked = []
        for x, y in zip(got.column("x"), got.column("y")):
            s, t = (np.frombuffer(v.as_buffer(), dtype=_U64) for v in (x, y))
            if len(s) > len(t):
                s, t = t, s
            at = np.searchsorted(t, s)
            at[at == len(t)] = 0
            both = int(np.count_nonzero(t[at] == s))
            linked.append(denominator * both >= numerator * (len(s) + len(t) - both))
        yield pa.RecordBatch.from_arrays([got.column("a"), got.column("b")], names=["a", "b"]).filter(
            pa.array(linked, pa.bool_()))


def _members(reps: DataFrame, store: Stages) -> DataFrame:
    """(key, rep, n, weight): left keys shared by two representatives or more.
    Only those take part that share a left key with one and a right key with
    one, so two that meet in a table are together under a left key; rows grow
    with the keys of a side, not with the tables."""
    lefts = reps.select("rep", "n", F.explode("lefts").alias("key"))
    near = store.write(_shared(lefts).select("rep").distinct(), "near-left")
    rights = reps.join(near, "rep").select("rep", F.explode("rights").alias("key"))
    near = store.write(_shared(rights).select("rep").distinct(), "near-right")
    members = store.write(_shared(lefts.join(near, "rep")), "members")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
    weight = members.join(sizes, "key").groupBy("rep").agg(F.sum("size").alias("weight"))
    return store.write(members.join(weight, "rep"), "weighted")


def _full_sets(docs: DataFrame, wanted: DataFrame, store: Stages) -> DataFrame:
    """(rep, shingles, rights) of the representatives ``wanted``. Their texts are
    looked for by the keys, which are sent to the tasks while they are few; texts
    are shuffled only for more, and a part of them at a time."""
    many, out = wanted.count(), []
    parts = max(1, min(PARTS, -(-many // SENT)))
    for k in range(parts):
        part = wanted.filter(F.pmod("key", F.lit(parts)) == k)
        keys = part.select("key")
        texts_ = docs.filter(F.pmod("key", F.lit(parts)) == k).join(
            keys.hint("broadcast") if many <= SENT * parts else keys, "key", "left_semi")
        found = texts_.mapInArrow(_sets, "f1 long, f2 long, n_shingles long, shingles binary")
        out.append(store.write(found.join(part, CLASS).dropDuplicates(CLASS).select("rep", "shingles", "rights"), f"sets-{k}"))
        release(docs.sparkSession)
    return reduce(DataFrame.unionByName, out)


def _shared(rows: DataFrame) -> DataFrame:
    """The rows whose key two representatives or more have."""
    keys = rows.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).filter("lo < hi")
    return rows.join(keys.select("key"), "key", "left_semi")


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for rep, label, x in zip(*(got.column(c) for c in ("rep", "label", "shingles"))):
            s = np.frombuffer(x.as_buffer(), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s), *(pa.array(np.full(len(s), v.as_py())) for v in (rep, label))],
                names=["shingle", "rep", "label"])


def _rare_pairs(state: DataFrame, sets: DataFrame, store: Stages, fits: Column, numerator: int, denominator: int
                ) -> DataFrame:
    """Every pair of representatives that are still in two components and can
    be similar at all, each once. Shingles have one order: first those that only
    one component has, then by the number of sets that have them. Two similar
    sets of n and m shingles have one in common among the first
    n - ceil(n * ratio) + 1 and m - ceil(m * ratio) + 1, and behind the first
    such one there are enough left. Shingles of one component pair nothing."""
    open_ = store.write(state.select("rep", "n", "label").distinct(), "open-reps")
    rows = sets.select(F.col("id").alias("rep"), "shingles").join(open_, "rep").select(
        "rep", "label", "shingles").mapInArrow(_exploded, "shingle long, rep long, label long")
    rows = rows.repartition("shingle")  # dealt once, for the counts and for what is looked up in them
    mixed = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("many"), F.min("label").alias("x"),
                                        F.max("label").alias("y")).filter("x < y").select("shingle", "many")
    # at most the shingles of a text
    order = store.write(rows.join(mixed, "shingle").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("many", "shingle"))).alias("order")), "order").join(open_, "rep")
    release(state.sparkSession)
    first = F.col("n") - F.ceil(F.col("n") * numerator / denominator) + 1 - (F.col("n") - F.size("order"))
    order = order.withColumn("first", first.cast("int")).filter("first > 0")
    rare = order.select("rep", "n", "label", (F.col("n") - F.size("order")).alias("before"),
                        F.posexplode(F.slice("order", F.lit(1), F.col("first"))).alias("i", "at"))
    # what stands from this place on
    rare = store.write(rare.select(F.col("at.shingle").alias("shingle"), "rep", "n", "label",
                                   (F.col("n") - F.col("before") - F.col("i")).alias("left")), "rare")
    one, two = (rare.select("shingle", F.col("rep").alias(k), *[F.col(c).alias(f"{v}{k}") for c, v in (
        ("n", "n"), ("label", "l"), ("left", "left"))]) for k in "ab")
    enough = F.least("lefta", "leftb") * (numerator + denominator) >= (F.col("na") + F.col("nb")) * numerator
    return one.join(two, "shingle").filter(F.col("a") < F.col("b")).filter("la != lb").filter(fits).filter(enough).select(
        "a", "b", "la", "lb").distinct()


def links(docs: DataFrame, classes: DataFrame, reps: DataFrame, store: Stages, numerator: int, denominator: int
          ) -> DataFrame:
    """(node, component) of the representatives that meet in a table."""
    spark = docs.sparkSession
    state = _members(reps, store)
    release(spark)
    wanted = classes.join(state.select("rep").distinct(), "rep").select("rep", *CLASS, "best.key")
    wanted = store.write(wanted.join(reps.select("rep", "rights"), "rep"), "wanted")
    sets = _full_sets(docs, wanted, store).withColumnRenamed("rep", "id")
    for done in ("reps", "near-left", "near-right", "members"):
        store.drop(done)
    fits = (F.least("na", "nb") * denominator) >= (F.greatest("na", "nb") * numerator)  # a bound of the similarity

    def confirmed(pairs: DataFrame, name: str, tables: bool) -> DataFrame:
        """The pairs (a, b, la, lb) that are similar, as edges of components
        (``tables``: of those that have a right key in common)."""
        wide = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"), F.col("rights").alias("ra")), "a")
                .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"), F.col("rights").alias("rb")), "b"))
        if tables:
            wide = wide.filter(F.arrays_overlap("ra", "rb"))
        with small_batches(spark, 256):
            return store.write(wide.select(F.col("la").alias("a"), F.col("lb").alias("b"), "x", "y").mapInArrow(
                lambda it: _confirm(it, numerator, denominator), "a long, b long").distinct(), name)

    labels = wanted.select(F.col("rep").alias("node"), F.col("rep").alias("component"))
    state, last, turn = state.withColumn("label", F.col("rep")), False, 0
    while not last:
        # pairs under a left key that are still in different components
        within = state.groupBy("key", "label").agg(F.count(F.lit(1)).alias("k"))
        open_ = within.groupBy("key").agg(F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("same"),
                                          F.max(F.struct("k", "label")).alias("top"))
        open_ = store.write(open_.filter("all * all > same").select(
            "key", ((F.col("all") * F.col("all") - F.col("same")) / 2).alias("pairs"), "all",
            F.col("top.label").alias("main")), f"open-{turn}")
        load = open_.agg(F.sum("pairs").alias("pairs"), F.sum("all").alias("rows")).first()
        if not load["pairs"]:
            break
        state = store.write(state.join(open_, "key").drop("pairs", "all"), f"state-{turn}")
        last = turn == HUB_ROUNDS
        if last:
            pairs = _rare_pairs(state, sets, store, fits, numerator, denominator)
        else:
            # one hub for the key's members outside the component that has most of them
            outside = state if turn == 0 else state.filter("label != main")
            hub = outside.groupBy("key").agg(F.max(F.struct(
                "weight", (-F.col("rep")).alias("back"), "n", "label")).alias("hub"))
            hub = hub.select("key", (-F.col("hub.back")).alias("b"), F.col("hub.n").alias("nb"),
                             F.col("hub.label").alias("lb"))
            pairs = state.join(hub, "key").select(F.col("rep").alias("a"), F.col("n").alias("na"), "b", "nb",
                                                  F.col("label").alias("la"), "lb").filter("la != lb").filter(fits)
            pairs = pairs.select("a", "b", "la", "lb").distinct()
        edges = confirmed(pairs, f"links-{turn}", tables=not last)
        merged = components(edges, store, f"components-{turn}")
        merged = store.write(merged.select(F.col("node").alias("component"), F.col("component").alias("to")), f"merged-{turn}")
        labels = store.write(labels.join(merged, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")), f"labels-{turn}")
        state = state.drop("main").join(merged.withColumnRenamed("component", "label"), "label", "left").withColumn(
            "label", F.coalesce("to", "label")).drop("to")
        release(spark)
        turn += 1
    return labels


def _key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("long"), F.coalesce(text, F.lit("")).cast("binary"))


def _components(docs: DataFrame, id_col: str, text_col: str, side: int, minima: int, numerator: int, denominator: int,
                store: Stages) -> DataFrame:
    """Per row: doc_id, key, n_shingles and, if it has words, component (a
    number) and best: the row that stands for the component."""
    docs = texts(docs, id_col, text_col).withColumn("key", _key(F.col("doc_id"), F.col("text")))
    sketches = store.write(docs.mapInArrow(
        lambda it: _sketch(it, side, minima), "doc_id long, key long, n_shingles long, f1 long, f2 long, "
                                              "lefts array<long>, rights array<long>"), "sketches")
    filled = sketches.filter("n_shingles > 0")
    # the smallest doc_id, no id last
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best")
    classes = store.write(filled.groupBy(*CLASS).agg(best).withColumn("rep", F.monotonically_increasing_id()), "classes")
    reps = filled.join(classes.select("rep", *CLASS, "best.key"), [*CLASS, "key"]).select(
        "rep", F.col("n_shingles").alias("n"), "lefts", "rights").dropDuplicates(["rep"])
    reps = store.write(reps, "reps")
    rows = store.write(sketches.drop("lefts", "rights"), "row-classes")
    store.drop("sketches")
    release(docs.sparkSession)
    found = links(docs, classes, reps, store, numerator, denominator)
    release(docs.sparkSession)
    labels = store.write(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        *CLASS, "best", F.coalesce("component", "rep").alias("component")), "labels")
    names = labels.groupBy("component").agg(F.min("best").alias("best"))
    labels = labels.drop("best").join(names, "component")
    return rows.join(labels, CLASS, "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", side: int = SIDE,
                    minima: int = MINIMA, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    out = _components(docs, id_col, text_col, side, minima, numerator, denominator, stages(docs.sparkSession))
    out = out.select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id"))
                     .otherwise(F.col("best.doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", side: int = SIDE,
                         minima: int = MINIMA, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, all columns as
    they are. Of texts without words one stays for each doc_id, and each that
    has no doc_id."""
    store = stages(docs.sparkSession)
    rows = store.write(_components(docs, id_col, text_col, side, minima, numerator, denominator, store), "rows")
    linked = rows.filter("component is not null and key = best.key and doc_id <=> best.doc_id")
    bare = rows.filter("component is null")
    first = bare.filter("doc_id is not null").groupBy("doc_id").agg(F.min("key").alias("key"))
    id_ = F.coalesce("doc_id", F.lit(0)).cast("long").alias("_id")
    keys = ["_key", "_id"]
    keep = linked.select(F.col("key").alias("_key"), id_).unionByName(bare.join(first, ["doc_id", "key"]).select(
        F.col("key").alias("_key"), id_)).groupBy(*keys).agg(F.count(F.lit(1)).alias("ties"))
    alone = bare.filter("doc_id is null").select(F.col("key").alias("_key"), id_).distinct()
    keep = store.write(keep.unionByName(alone.withColumn("ties", F.lit(1).cast("long"))), "keep")  # each row of these stays
    release(docs.sparkSession)
    doc_id = F.col(id_col).cast("long")
    whole = docs.select(F.struct("*").alias("row"), _key(doc_id, F.col(text_col)).alias("_key"),
                        F.coalesce(doc_id, F.lit(0)).alias("_id"))
    return one_each(whole, keep, keys)
