"""Quality classifier, hidden Markov model and the pipeline."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from audival.llm import hmm
from audival.llm.hmm import Model, coded_runs, expected_counts, first_model, forward, score_texts, train
from audival.llm.quality import class_prior, drop_rejected, quality_scores
from paths import MEDIUM, SMALL


def tiny():
    r = np.random.default_rng(1)
    norm = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return Model(norm(r.random(2), 0), norm(r.random(2), 0), norm(r.random((2, 2)), 1), norm(r.random((3, 2)), 0))


def paths(model, seq, first=True):
    for states in itertools.product(range(2), repeat=len(seq)):
        p = (model.start if first else model.inside)[states[0]] * model.emit[seq[0], states[0]]
        for a, b, c in zip(states, states[1:], seq[1:]):
            p *= model.move[a, b] * model.emit[c, b]
        yield states, p


def test_forward_is_exact():
    m, seqs = tiny(), [[0, 1, 2, 1], [2], [1, 1, 0, 0, 2, 2]]
    flat = np.array(sum(seqs, []))
    sizes = np.array([len(s) for s in seqs])
    got = forward(m, flat, np.cumsum(sizes) - sizes, sizes)
    want = [math.log10(sum(p for _, p in paths(m, s))) for s in seqs]
    assert np.allclose(got, want)
    # likelihoods of all sequences of one length add up to one
    every = [list(s) for s in itertools.product(range(3), repeat=4)]
    total = forward(m, np.array(sum(every, [])), np.arange(81) * 4, np.full(81, 4))
    assert np.isclose((10 ** total).sum(), 1)


def test_expected_counts_match_enumeration():
    m, seqs, first = tiny(), [[0, 1, 2, 1], [2, 0], [1, 1, 0]], np.array([True, False, True])
    start, inside, move, emit = np.zeros(2), np.zeros(2), np.zeros((2, 2)), np.zeros((3, 2))
    for s, f in zip(seqs, first):
        all_paths = list(paths(m, s, f))
        total = sum(p for _, p in all_paths)
        for states, p in all_paths:
            (start if f else inside)[states[0]] += p / total
            for a, b in zip(states, states[1:]):
                move[a, b] += p / total
            for c, k in zip(s, states):
                emit[c, k] += p / total
    sizes = np.array([len(s) for s in seqs])
    got = expected_counts(m, np.array(sum(seqs, [])), np.cumsum(sizes) - sizes, sizes, first)
    for a, b in zip(got, (start, inside, move, emit)):
        assert np.allclose(a, b)


def test_scores(docs, corpus, empty):
    rows = score_texts(docs, rounds=2).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in corpus]
    count = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    want = Counter((i, held(i), len(ws), sum(count[w] > 0 for w in ws), n,
                    round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)) for i, ws in tokens)
    assert Counter((*tuple(r)[:5], round(r.base_score, 4)) for r in rows) == want
    assert all(r.score < 0 for r in rows)
    assert score_texts(empty, rounds=1).collect() == []


def test_every_training_word_has_emissions_of_its_own(spark):
    """More words than any fixed cap, all with one ending: each has a row, with
    its training count spread over the states."""
    rows = [(i, " ".join(f"w{7 * i + j}zzz" for j in range(14))) for i in range(1000)] + [(5000, "once held")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    coded, classes, tables = coded_runs(df, "doc_id", "text", 16)
    got = train(coded, classes, 4, 2, 5, 16).emissions.filter("bucket >= 0 and (cls < 0 or cls >= 2048)").toPandas()
    count = Counter(w for i, t in rows if zlib.crc32(str(i).encode()) % 10 for w in t.split())
    n_train = sum(zlib.crc32(str(i).encode()) % 10 > 0 for i, _ in rows)
    want = sorted([n_train, *(n for n in count.values() if n > 1)])
    assert len(want) > 4096 + 1
    counts = np.array(got["counts"].tolist())
    # the rest of a sum is what smoothing adds to each state
    assert np.allclose(sorted(counts.sum(axis=1)), want, atol=1.5)
    assert sum(np.ptp(c) > 0.05 for c in counts) > 4096
    assert tables.total == sum(count.values()) + n_train


def test_rounds_by_parts_of_the_runs(spark, monkeypatch):
    """Each part's emissions are a fraction of all; the model is that of one part."""
    monkeypatch.setattr(hmm, "stages", lambda s, make=hmm.stages: stored.append(make(s)) or stored[-1])
    stored = []
    rows = [(i, " ".join(f"w{i * j % 97}" for j in range(40))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    got = []
    for parts in (1, 3):
        coded, words, _ = coded_runs(df, "doc_id", "text", 6)
        got.append(train(coded, words, 3, 2, 16, 6, parts))
    sent = [hmm.spread_emissions(got[1].table, got[1].norm, k, n).agg(F.sum(F.length("emit"))).first()[0]
            for k, n in ((0, 1), (0, 3), (1, 3), (2, 3))]
    assert sum(sent[1:]) == sent[0] and max(sent[1:]) < 0.6 * sent[0]
    one, three = (np.array(x.emissions.orderBy("cls").toPandas()["counts"].tolist()) for x in got)
    assert one.shape == three.shape and np.allclose(one, three, rtol=1e-3, atol=1e-3)
    assert np.allclose(got[0].model.move, got[1].model.move, atol=1e-4)
    # of two trainings the coded runs and the last tables are left
    left = [s for s in stored if spark._jvm.java.io.File(s.root.removeprefix("file:")).exists()]
    assert len(left) == 4


def test_counts_tell_words_apart_that_a_polynomial_hash_confuses(spark):
    """A Thue-Morse word is known, its swap is not."""
    one, two = ("".join(b if i.bit_count() % 2 else a for i in range(1024)) for a, b in ("ab", "ba"))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10][:8]
    held = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = spark.createDataFrame([(i, f"{one} the end {i % 3}") for i in ids] + [(held, f"{two} the end")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r for r in score_texts(docs).collect()}
    assert got[held]["n_tokens"] == 4 and got[held]["n_known"] == 3  # the end, and the end of the text
    assert all(got[i]["n_known"] == 5 for i in ids)


def test_model_beats_unigrams_on_held_out_texts(spark):
    got = score_texts(spark.read.parquet(f"{MEDIUM}/documents.parquet"), rounds=4).filter("held_out").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.95 * got[1]


def test_one_state_is_a_class_model():
    prior = np.array([0.5, 0.3, 0.2])
    m = first_model(prior, 1)
    assert np.allclose(forward(m, np.array([0, 1]), np.array([0]), np.array([2])), np.log10(m.emit[0, 0] * m.emit[1, 0]))


def test_prior_from_separable_scores():
    # 60 % of the unlabelled texts score like the positives
    hist = np.zeros(200)
    hist[10:20], hist[80:90] = 4000, 6000
    hist[180:190] = 10000
    assert abs(class_prior(hist, (100_000, 100_000)) - 0.6) < 0.02


def _auc(score, good):
    order = np.argsort(np.argsort(score))
    return (order[good].sum() - good.sum() * (good.sum() - 1) / 2) / (good.sum() * (~good).sum())


def test_quality(spark):
    docs, labels = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_scores(docs, labels).toPandas()
    assert len(got) == docs.count() and got["score"].between(0, 1).all()
    assert ((got["score"] >= 0.5).astype(int) == got["predicted"]).all()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]).all()
    seen = got.merge(labels.toPandas(), on="doc_id")
    unseen = seen[seen["held_out"]]
    assert _auc(unseen["score"].to_numpy(), (unseen["quality"] == 1).to_numpy()) > 0.7
    # labels of held-out documents are never used
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(crc, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_scores(docs, turned).toPandas().set_index("doc_id")["score"]
    assert np.allclose(again.loc[got["doc_id"]].to_numpy(), got["score"].to_numpy())


def test_quality_edges(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 130, 2)] + [(None, 1, 0), (4, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = quality_scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality_scores(empty, labels).collect() == []
    out = drop_rejected(docs, labels)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in got if r.predicted}


def test_pipeline(spark):
    import corpus_pipeline as P

    from tests.llm.test_dedup import expected_components, expected_groups
    from tests.llm.test_search import expected_hits
    from tests.llm.test_tokens import WORD
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    kept = P.quality(spark, docs, SMALL)
    assert kept.columns == docs.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    stay = {keep for keep, _ in expected_groups(rows).values()}
    rows = [r for r in rows if r[0] in stay]
    label, _ = expected_components(rows)
    rows = [r for r in rows if label[r[0]] == r[0]]
    clean = {h[0] for h in expected_hits(rows, bench) if not h[-1]}
    rows = [r for r in rows if r[0] in clean]
    got = P.run(spark, SMALL).collect()
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(WORD)
    assert {(r.doc_id, r.n_tokens) for r in got} == {
        (i, len(library.encode(t, add_special_tokens=False).ids)) for i, t in rows}
    assert 1 < len(got) < docs.count()


def test_stages_on_an_empty_table(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, docs, SMALL).collect() == []
