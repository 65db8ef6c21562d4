"""Quality classifier by positive-unlabelled learning.

Texts are described by statistics of their bytes, words, word runs and lines
(whole texts; no label, language, source or id enters). Statistics are cut at
quantiles of all training texts into bins, and the score is a logistic model
over the bins. It is trained from trusted positives P and unlabelled texts U by
minimising the non-negative unbiased risk (l is the logistic loss, p the prior)

    p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)])

by Newton steps: each step is one pass that sums gradient and curvature over
all training rows, and one that evaluates the risk for several step lengths;
the driver holds only sums of the model's size. A step that would make the
second term negative gains nothing there, so it is shortened.

The class prior p is estimated from the scores of a P-against-U classifier: it
is the smallest ratio, over thresholds, of the share of U above to the share
of P above, with a confidence term (best-bin estimation).

Defined cases: null and empty texts have all statistics 0 and get that score;
rows that repeat a doc_id are scored alike if their texts are; a document with
several label rows is positive if all say so; without trusted positives or
without unlabelled texts every score is 0.5, as nothing can be learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audival.llm.hmm import crc_of_id
from audival.llm.shared import WHITE, WordBatch, byte_map, grams, runs_of, separators, stages
from audival.plans.stage import Stager

#: Bins of a statistic, Newton steps, weight of the ridge (over the positives).
BINS, STEPS, RIDGE = 8, 8, 4.0
_LENGTHS = (1.0, 0.5, 0.25, 0.125, 0.03)
_U64 = np.uint64
_KINDS = {"lower": b"abcdefghijklmnopqrstuvwxyz", "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
          "stop": b".", "comma": b",;:", "shout": b"!?", "quote": b"\"'`", "markup": b"<>{}[]()=/\\|_", "sign": b"#$%&*@+^~",
          "dash": b"-", "space": b" ", "line": b"\n", "control": bytes([*range(9), 11, 12, 13, *range(14, 32), 127]),
          "beyond": bytes(range(128, 256))}


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a / np.maximum(b, 1)


def _runs_in(text: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and the most frequent one's count, by text."""
    order = np.lexsort((h, text))
    t, h = text[order], h[order]
    new = np.concatenate([[True], (t[1:] != t[:-1]) | (h[1:] != h[:-1])]) if len(t) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, t[at], np.diff(np.append(at, len(t))))
    return np.bincount(t[at], minlength=n), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics for each text of a run."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    of = np.repeat(np.arange(n), size)
    table = np.bincount(of * 256 + data, minlength=256 * n).reshape(n, 256)
    kinds = {k: table[:, list(b)].sum(axis=1) for k, b in _KINDS.items()}
    share = table / np.maximum(size, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)

    white = separators(WHITE)
    words = WordBatch(data, offsets, white)
    many = np.diff(words.first)
    text = np.repeat(np.arange(n), many)
    length = words.ends - words.starts
    h = words.hashes(True)
    distinct, most = _runs_in(text, h, n)
    cols = [np.log1p(size), np.log1p(many), entropy]
    cols += [_ratio(kinds[k], size) for k in _KINDS]
    cols += [_ratio(kinds["upper"], kinds["upper"] + kinds["lower"]), _ratio(kinds["stop"], many),
             _ratio(np.bincount(text, weights=length, minlength=n), many), _ratio(distinct, many), _ratio(most, many),
             np.log1p(distinct) / np.maximum(np.log1p(many), 1e-9)]
    for k in (2, 3):  # repeated word runs
        g = grams(h, k, 100 + k)
        own = text[:len(g)] == text[k - 1:] if len(g) else np.zeros(0, dtype=bool)
        d, m = _runs_in(text[:len(g)][own], g[own], n)
        cols += [_ratio(d, many - k + 1), _ratio(m, many - k + 1)]
    same = np.zeros(len(h), dtype=bool)
    if len(h):
        same[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    lower = np.concatenate([[0], np.cumsum((data >= 97) & (data <= 122))])
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    caps = upper[words.ends] - upper[words.starts]
    final = data[words.ends - 1] if len(h) else np.zeros(0, dtype=np.uint8)
    begin = data[words.starts] if len(h) else final
    by_word = [same, (caps > 1) & (lower[words.ends] == lower[words.starts]), (begin >= 65) & (begin <= 90),
               np.isin(final, list(b"!?")), np.isin(final, list(_KINDS["sign"])), np.isin(final, list(b".")),
               np.isin(begin, list(_KINDS["markup"] + _KINDS["sign"])), length == 1, length > 14]
    cols += [_ratio(np.bincount(text, weights=w, minlength=n), many) for w in by_word]
    longest = np.zeros(n)
    np.maximum.at(longest, text, length)
    cols.append(np.log1p(longest))
    feeds = separators(b"\n")
    lines = WordBatch(data, offsets, feeds)
    count = np.diff(lines.first)
    d, m = _runs_in(np.repeat(np.arange(n), count), lines.hashes(False), n)
    cols += [np.log1p(count), _ratio(d, count), _ratio(m, count), _ratio(many, count)]
    return np.stack(cols, axis=1).astype(np.float32)


#: How many statistics there are.
WIDTH = statistics(np.zeros(0, dtype=np.uint8), np.zeros(2, dtype=np.int64)).shape[1]


def _describe(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for lo, hi, data, offsets in runs_of(got.column("text")):
            x = statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [got.column(c).slice(lo, hi - lo) for c in keep]
                + [pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * WIDTH, pa.int32()), pa.array(x.ravel()))],
                names=[*keep, "x"])


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float32).reshape(rows, WIDTH)


@dataclass(frozen=True)
class Scorer:
    cuts: np.ndarray  # statistic x (BINS - 1)
    weights: np.ndarray  # by statistic and bin, and the constant last

    @staticmethod
    def size(cuts: np.ndarray) -> int:
        return cuts.shape[0] * (2 * cuts.shape[1] + 1) + 1

    def places(self, x: np.ndarray) -> np.ndarray:
        """The weight of each statistic. A value between two cuts has the bin
        between them, one that equals a cut (a share of 0 or 1, often) its own."""
        return np.stack([np.searchsorted(c, x[:, j]) + np.searchsorted(c, x[:, j], side="right")
                         + j * (2 * len(c) + 1) for j, c in enumerate(self.cuts)], axis=1)

    def logit(self, places: np.ndarray) -> np.ndarray:
        return self.weights[places].sum(axis=1) + self.weights[-1]


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _sums(batches: Iterator[pa.RecordBatch], scorer: Scorer, coef: tuple[float, float, float]) -> Iterator[pa.RecordBatch]:
    """A task's part of gradient and curvature: rows (place, value), the
    upper half of the curvature after the gradient. ``coef`` weighs l(f) on P, l(-f) on P and
    l(-f) on U, each divided by its number of rows already."""
    size = len(scorer.weights)
    total, any_rows = np.zeros(size + size * size), False
    for got in batches:
        for at in range(0, got.num_rows, 4096):
            part = got.slice(at, 4096)
            places = scorer.places(_matrix(part.column("x"), part.num_rows))
            positive = part.column("positive").to_numpy(zero_copy_only=False).astype(bool)
            p = 1 / (1 + np.exp(-scorer.logit(places)))
            on, off = np.where(positive, coef[0], 0.0), np.where(positive, coef[1], coef[2])
            slope, bend = off * p - on * (1 - p), (on + off) * p * (1 - p)
            hot = np.zeros((part.num_rows, size))
            hot[np.arange(part.num_rows)[:, None], places] = 1
            hot[:, -1] = 1
            total[:size] += hot.T @ slope
            total[size:] += np.triu(hot.T @ (hot * bend[:, None])).ravel()
            any_rows = True
    if any_rows:
        place = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], names=["place", "value"])


def _risks(batches: Iterator[pa.RecordBatch], scorers: list[Scorer]) -> Iterator[pa.RecordBatch]:
    """A task's sums of l(f) on P, l(-f) on P and l(-f) on U for each scorer."""
    out = np.zeros((len(scorers), 3))
    for got in batches:
        if not got.num_rows:
            continue
        places = scorers[0].places(_matrix(got.column("x"), got.num_rows))
        positive = got.column("positive").to_numpy(zero_copy_only=False).astype(bool)
        for i, s in enumerate(scorers):
            f = s.logit(places)
            out[i] += [_loss(f[positive]).sum(), _loss(-f[positive]).sum(), _loss(-f[~positive]).sum()]
    yield pa.RecordBatch.from_arrays([pa.array(range(out.size), pa.int64()), pa.array(out.ravel())], names=["place", "value"])


def _histogram(batches: Iterator[pa.RecordBatch], scorer: Scorer, bins: int) -> Iterator[pa.RecordBatch]:
    out = np.zeros(2 * bins)
    for got in batches:
        if got.num_rows:
            f = scorer.logit(scorer.places(_matrix(got.column("x"), got.num_rows)))
            positive = got.column("positive").to_numpy(zero_copy_only=False).astype(int)
            level = np.minimum((bins / (1 + np.exp(-f))).astype(int), bins - 1)
            out += np.bincount(positive * bins + level, minlength=2 * bins)
    yield pa.RecordBatch.from_arrays([pa.array(range(len(out)), pa.int64()), pa.array(out)], names=["place", "value"])


def _added(rows: DataFrame, task, size: int) -> np.ndarray:
    """The tasks' vectors summed by Spark; only ``size`` numbers reach the
    driver."""
    out = np.zeros(size)
    got = rows.mapInArrow(task, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toPandas()
    out[got["place"].to_numpy(dtype=np.int64)] = got["value"].to_numpy()
    return out


def _fit(rows: DataFrame, cuts: np.ndarray, n: tuple[int, int], coef: tuple[float, float, float], steps: int) -> Scorer:
    """Newton steps on the risk; ``coef`` as in the formula, before dividing."""
    size = Scorer.size(cuts)
    scorer = Scorer(cuts, np.zeros(size))
    each, ridge = (coef[0] / n[0], coef[1] / n[0], coef[2] / n[1]), RIDGE / n[0]
    best = np.inf
    for _ in range(steps):
        sums = _added(rows, lambda it, s=scorer: _sums(it, s, each), size + size * size)
        upper = sums[size:].reshape(size, size)
        slope, bend = sums[:size] + ridge * scorer.weights, upper + np.triu(upper, 1).T + ridge * np.eye(size)
        step = np.linalg.solve(bend, slope)
        tries = [Scorer(cuts, scorer.weights - length * step) for length in _LENGTHS]
        parts = _added(rows, lambda it, t=tries: _risks(it, t), 3 * len(tries)).reshape(-1, 3) / [n[0], n[0], n[1]]
        # the non-negative risk; for P against U the second term is positive anyway
        risk = coef[0] * parts[:, 0] + np.maximum(0, coef[2] * parts[:, 2] + coef[1] * parts[:, 1])
        risk += [ridge / 2 * (t.weights @ t.weights) for t in tries]
        k = int(np.argmin(risk))
        if risk[k] >= best - 1e-7:
            break
        best, scorer = risk[k], tries[k]
    return scorer


def class_prior(hist: np.ndarray, n: tuple[int, int], delta: float = 0.1) -> float:
    """Best-bin estimate of the share of positives among unlabelled texts."""
    bins = len(hist) // 2
    above_u, above_p = (np.cumsum(h[::-1]) / max(1, m) for h, m in ((hist[:bins], n[1]), (hist[bins:], n[0])))
    slack = sum(np.sqrt(np.log(4 / delta) / (2 * max(1, m))) for m in n)
    ok = above_p > 0
    bound = (above_u[ok] + slack) / above_p[ok]
    k = int(np.argmin(bound))
    return float(np.clip(above_u[ok][k] / above_p[ok][k], 0.01, 0.99))


def trained(described: DataFrame, labels: DataFrame, store: Stager, train: Column, bins: int = BINS,
            steps: int = STEPS) -> tuple[Scorer, float]:
    """Scorer and class prior from rows (doc_id, x); ``train`` says which rows
    may be learned from."""
    marks = labels.groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    rows = described.filter(train).join(marks, F.col("doc_id") == F.col("_id"), "left")
    # trusted positives and texts without a label; other labelled rows are not used
    rows = rows.filter((F.col("quality") == 1) | F.col("_id").isNull())
    rows = store.write(rows.select("x", (F.coalesce("quality", F.lit(0)) == 1).alias("positive")), "training")
    n_p, n_u = rows.agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    if not n_p or not n_u:
        cuts = np.zeros((WIDTH, bins - 1))
        return Scorer(cuts, np.zeros(Scorer.size(cuts))), 0.5
    share = [i / bins for i in range(1, bins)]
    columns = rows.select(*[F.col("x")[j].cast("double").alias(f"x{j}") for j in range(WIDTH)])
    cuts = np.array(columns.approxQuantile([f"x{j}" for j in range(WIDTH)], share, 0.002))
    n = (n_p, n_u)
    # the prior is read off texts that the P-against-U classifier has not seen
    seen = F.pmod(F.xxhash64("x"), F.lit(2)) == 0
    m_p, m_u = rows.filter(seen).agg(F.count_if("positive"), F.count_if(~F.col("positive"))).first()
    versus = _fit(rows.filter(seen), cuts, (max(1, m_p), max(1, m_u)), (0.5, 0.0, 0.5), max(2, steps // 2))
    hist = _added(rows.filter(~seen), lambda it: _histogram(it, versus, 1000), 2000)
    prior = class_prior(hist, (n_p - m_p, n_u - m_u))
    return _fit(rows, cuts, n, (prior, -prior, 1.0), steps), prior


def _scored(batches: Iterator[pa.RecordBatch], scorer: Scorer, keep: list[str]) -> Iterator[pa.RecordBatch]:
    for got in batches:
        f = scorer.logit(scorer.places(_matrix(got.column("x"), got.num_rows)))
        yield pa.RecordBatch.from_arrays([got.column(c) for c in keep] + [pa.array(1 / (1 + np.exp(-f)))],
                                         names=[*keep, "score"])


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, held_out (crc32 of the id is 1 modulo 3; never learned
    from), score, predicted."""
    store = stages(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = rows.select("doc_id", (crc_of_id(F.col("doc_id")) % 3 == 1).alias("held_out"), "text")
    described = store.write(rows.mapInArrow(lambda it: _describe(it, ["doc_id", "held_out"]),
                                            "doc_id long, held_out boolean, x array<float>"), "described")
    scorer, _ = trained(described, labels, store, ~F.col("held_out"))
    out = described.mapInArrow(lambda it: _scored(it, scorer, ["doc_id", "held_out"]),
                               "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` predicted to be good, all columns as they are."""
    store = stages(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    described = store.write(slim.mapInArrow(lambda it: _describe(it, ["doc_id"]), "doc_id long, x array<float>"),
                            "described")
    scorer, _ = trained(described, labels, store, crc_of_id(F.col("doc_id")) % 3 != 1)
    # statistics are a map, so the rows are scored in one more scan without a join
    return docs.mapInArrow(lambda it: _kept(it, scorer, text_col), docs.schema)


def _kept(batches: Iterator[pa.RecordBatch], scorer: Scorer, text_col: str) -> Iterator[pa.RecordBatch]:
    for got in batches:
        for lo, hi, data, offsets in runs_of(got.column(text_col).fill_null("").cast(pa.binary())):
            f = scorer.logit(scorer.places(statistics(data, offsets)))
            yield got.slice(lo, hi - lo).filter(pa.array(f >= 0))
