"""Residue-number products and hard negatives against plain arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from audival.llm import negatives
from audival.llm.negatives import DEPTH, Residues, first_of, hard_negatives, primes_for


@pytest.mark.parametrize("length,largest", [(1, 1), (3, 0), (64, 160), (64, 40_000), (1024, 300), (2500, 5000),
                                            (7, 2**29), (1, 2**30)])
def test_scores_are_exact(length, largest):
    r = np.random.default_rng(length)
    a, b = (r.integers(-largest, largest, (5, length), endpoint=True) for _ in range(2))
    a[0], b[0], b[1] = largest, largest, -largest
    system = Residues.of(length, largest)
    assert math.prod(system.primes) > 2 * length * largest**2
    assert all(min(length, DEPTH) * (p // 2) ** 2 <= 2**24 for p in system.primes)
    got = system.scores(system.split(a), system.split(b))
    assert got.tolist() == [[sum(x * y for x, y in zip(u, v)) for v in b.tolist()] for u in a.tolist()]


def test_scores_beyond_63_bits_are_an_error():
    with pytest.raises(ValueError, match="63 bits"):
        Residues.of(4, 2**31)
    assert len(set(primes_for(64, 2**50))) == len(primes_for(64, 2**50))


def test_first_of_takes_ties_by_place():
    scores = np.array([5, 7, 7, 1, 7, 9, 5])
    assert sorted(first_of(scores, np.arange(7), 3).tolist()) == [1, 2, 5]
    assert sorted(first_of(scores, np.array([0, 3, 6]), 2).tolist()) == [0, 6]
    assert first_of(scores, np.array([3]), 2).tolist() == [3]


def brute(rows):
    use = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        use.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for anchor, label, v in (u for u in use if u[0] % 100 == 0):
        scored = [(-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in use]
        for s, p, _ in sorted((s, i, m) for s, i, m in scored if m == label and i != anchor)[:5]:
            inside = sorted((t, i) for t, i, m in scored if m != label and 30 * -s <= 100 * -t <= 90 * -s)
            out += [(anchor, p, rank + 1, i, -s, -t) for rank, (t, i) in enumerate(inside[:10])]
    return sorted(out)


def table(seed, n, length, labels, spread=1.0):
    r = random.Random(seed)
    rows = [(i, [r.choice([r.gauss(0.1, spread), 0.25, -0.5]) for _ in range(length)], r.randrange(labels))
            for i in range(n)]
    for i in range(0, n, 9):  # equal vectors: ties of scores
        rows[i] = (i, list(rows[i % 30][1]), rows[i][2])
    return rows


ODD = [(1100, None, 1), (1200, [1.0, None, 2.0, 0.0], 1), (1300, [float("nan"), 1.0, 1.0, 1.0], 1),
       (1400, [float("inf"), 1.0, 1.0, 1.0], 2), (1500, [-float("inf")], 2), (1600, [1.0, 1.0, 1.0, 1.0], None),
       (None, [1.0, 1.0, 1.0, 1.0], 1), (1700, [], 3), (1800, [0.5], 0), (-700, [0.3, 0.2, 0.1, 0.4], 9),
       (1900, [0.5, 0.5, 0.25, 0.125], 77)]


@pytest.mark.parametrize("seed,n,length,labels,chunk", [(1, 620, 4, 3, 90), (2, 410, 16, 10, 1 << 16), (3, 300, 4, 1, 50)])
def test_table(spark, monkeypatch, seed, n, length, labels, chunk):
    monkeypatch.setattr(negatives, "CHUNK", chunk)
    monkeypatch.setattr(negatives, "LEAST", 100)
    rows = table(seed, n, length, labels) + (ODD if length == 4 else [])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3).withColumns(
        {"row": F.lit("x"), "v": F.lit(1), "chunk": F.lit(2), "side": F.lit(None).cast("int"), "positives": F.lit(0)})
    got = hard_negatives(df, anchor=lambda i: i % 100 == 0,
                         relabel=lambda i, label: F.when(i % 7 == 0, (label + 1) % 10).otherwise(label))
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_repeated_rows_take_part_each(spark):
    """Two anchor rows of one id ask each for itself; copies of a negative fill
    ranks of their own."""
    rows = [(0, [1.0], 1), (0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2), (2, [0.5], 2), (3, [0.75], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(map(tuple, hard_negatives(df, anchor=lambda i: i % 100 == 0).collect()))
    one = [(0, 1, 1, 3, 65536, 49152), (0, 1, 2, 2, 65536, 32768), (0, 1, 3, 2, 65536, 32768)]
    assert got == sorted(one + one)


def test_tables_without_rows_or_anchors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives(none, anchor=lambda i: i % 100 == 0).collect() == []
    few = spark.createDataFrame([(1, [0.5], 1), (100, [0.5], 2)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives(few, anchor=lambda i: i == 7).collect() == []
    assert hard_negatives(few, anchor=lambda i: i % 100 == 0).collect() == []
