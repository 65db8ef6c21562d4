"""Periodic runs against the definition."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from audival.llm import periods
from audival.llm.periods import collapse_runs, planted, run_digests, solve_tile, z_function


def brute(words):
    """(start, period, length) of all runs: every period, every longest stretch
    of matches, and no smaller period of the same stretch."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            size = i + q - s
            if size >= max(6, 4 * q):
                part = words[s:s + size]
                if not any(part[:size - p] == part[p:] for p in range(1, q)):
                    out.append((s, q, size))
    return sorted(out)


def want(doc_id, text, plant=True):
    words = (text or "").encode().split()
    if plant and doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, q, size in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    lines = "".join(f"{s},{size},{q}\n" for s, q, size in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    return (doc_id, len(words), len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(kept).hexdigest())


def repeating(r, n):
    """Words with repetitions at all scales, some inside others."""
    out = []
    while len(out) < n:
        part = [r.choice("abcdefgh") for _ in range(r.randint(1, r.choice([2, 3, 9, 40])))]
        if r.random() < 0.3:
            part = part * r.randint(3, 6) + [r.choice("xyz")]
        out += part * r.choice([1, 1, 2, 3, 4, 5, 9]) + part[:r.randint(0, len(part))]
    return out[:n]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    out = [(i, " ".join(repeating(r, r.randint(0, 260)))) for i in range(220)]
    out += [(1000 + i, " ".join(r.choice(["ab", "c", "ä", "中"]) for _ in range(r.randint(1, 60)))) for i in range(80)]
    out += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "b " * 3000), (2004, "a b " * 1200 + "c"),
            (2005, "x x x x x"), (2006, "x x x x x x"), (2007, "a b c a b c a b c a b"), (2008, "a b c " * 4),
            (None, "q " * 40), (None, None), (5, "z " * 9), (5, out[5][1]), (5, out[5][1])]
    out += [(3000 + i, " ".join(f"w{r.randint(0, 3000)}" for _ in range(900))) for i in range(20)]
    return out


def test_runs_are_those_of_the_definition(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).withColumns(
        {"key": F.lit(1), "runs": F.lit("x"), "words": F.lit("y"), "octave": F.lit(3)})
    got = sorted(map(tuple, run_digests(docs, plant=planted).collect()), key=repr)
    assert got == sorted((want(i, t) for i, t in rows), key=repr)
    assert sum(g[2] for g in got) > 300


def test_small_groups_and_plain_texts(spark, rows, monkeypatch):
    """Groups of a few words and no planted repetition; runs and texts as they are."""
    docs = spark.createDataFrame(rows[:120] + rows[300:314], "doc_id long, text string")
    got = collapse_runs(docs).collect()
    for g in got:
        digest = (hashlib.sha256("".join(f"{s},{size},{q}\n" for s, q, size in map(tuple, g["runs"])).encode()).hexdigest(),
                  hashlib.sha256(g["collapsed"].encode()).hexdigest())
        assert any(tuple(g)[:7] + digest == want(i, t, plant=False) for i, t in rows if i == g["doc_id"])
    assert len(got) == 134


def test_tiles_of_one_group_equal_those_of_many(rows):
    import pyarrow as pa
    texts = [(t or "").encode() for _, t in rows]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([None] * len(texts), pa.int64()),
                                        pa.array(texts)], names=["key", "doc_id", "text"])

    def runs(group):
        before, periods.GROUP = periods.GROUP, group
        try:
            got = [b for b in periods._explode(iter([batch]), None, True)]
        finally:
            periods.GROUP = before
        tiles = [r for b in got for r in b.to_pylist() if r["octave"] is not None]
        assert max((len(t["ids"]) - 8 * t["octave"] for t in tiles), default=0) <= 0
        found = {(t["key"], *f) for t in tiles if (f := solve_tile(t["ids"], t["octave"], t["boundary"] - t["lo"]))}
        return {(k, q) for k, q, _, _ in found}
    # a tile also finds what is three periods long; the length is judged once fragments are stitched
    needed = {(i, q) for i, (_, t) in enumerate(rows) for _, q, _ in brute((t or "").split())}
    assert needed <= runs(50) and needed <= runs(200_000)


def test_z_function():
    r = random.Random(1)
    for _ in range(200):
        x = [r.randint(0, 2) for _ in range(r.randint(0, 30))]
        z = z_function(x, len(x))
        for i in range(1, len(x)):
            assert z[i] == next((k for k in range(len(x) - i) if x[k] != x[i + k]), len(x) - i)


def test_a_long_run_in_one_document_is_dealt_over_tiles(spark):
    """A text of one run: small tiles, no tile of a multiple of its period but
    near its end, and one run in the result."""
    text = " ".join(["one", "two", "three"] * 4000)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = run_digests(docs).collect()
    assert len(got) == 1 and tuple(got[0])[:7] == (1, 12000, 1, 0, 12000, 3, 4000000)
    x = periods.np.array([0, 1, 2] * 4000)
    tiles = list(periods._boundaries(x, periods.np.array([0, len(x)])))
    assert sum(8 * size for _, size, _ in tiles) < 32 * len(x)  # not eight times the words for each of the octaves


def test_empty_table(spark, empty):
    assert run_digests(empty, plant=planted).collect() == []
    assert collapse_runs(empty).collect() == []
