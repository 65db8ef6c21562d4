"""Exact dedup, near-dedup and substring dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from audival.llm.exact_dedup import copy_groups, drop_copies
from audival.llm.near_dedup import drop_near_duplicates, near_duplicates
from audival.llm.shared import Stages
from audival.llm.substring_dedup import cut_repeats, repeat_digests, repeated_places


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected_groups(corpus):
    groups = defaultdict(list)
    for i, t in corpus:
        groups[squeezed(t)].append((-len(t or ""), i))
    return {k: (min(v)[1], len(v)) for k, v in groups.items()}


def check_groups(corpus, rows, sha=True):
    want = expected_groups(corpus)
    got = Counter((r.doc_id, r.keep_id, r.group_size) for r in rows)
    assert got == Counter((i, *want[squeezed(t)]) for i, t in corpus)
    if sha:
        assert {(r.doc_id, r.text_sha256) for r in rows} == {
            (i, hashlib.sha256(squeezed(t).encode()).hexdigest()) for i, t in corpus}
    # exactly one row of each group stays
    assert sum(r.kept for r in rows) == len(want)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_copies(docs, corpus):
    check_groups(corpus, copy_groups(docs).collect())


def test_copies_compare_content_where_digests_clash(docs, corpus):
    check_groups(corpus, copy_groups(docs, digest=lambda c: F.substring(F.sha2(c, 256), 1, 1)).collect(), sha=False)


def test_null_id_loses(spark):
    df = spark.createDataFrame([(None, "a"), (4, "a"), (None, "b")], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.keep_id), r.kept) for r in copy_groups(df).collect())
    assert got == [("4", "4", True), ("None", "4", False), ("None", "None", True)]


def test_drop_copies(docs, corpus, empty):
    out = drop_copies(docs)
    assert out.columns == docs.columns
    assert len({squeezed(r.text) for r in out.collect()}) == len(expected_groups(corpus))
    assert drop_copies(empty).collect() == [] and copy_groups(empty).collect() == []


def test_drop_copies_leaves_one_row_of_each_group(spark, docs, corpus):
    out = Counter(squeezed(r.text) for r in drop_copies(docs).collect())
    assert out == Counter(expected_groups(corpus).keys())
    rows = [(7, "a b c")] * 40 + [(None, "n m")] * 9 + [(8, "x y"), (8, "x\ty"), (8, "x  y"), (9, "x  y"), (5, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter((r.doc_id, squeezed(r.text)) for r in drop_copies(df).collect())
    assert got == Counter([(7, "abc"), (None, "nm"), (8, "xy"), (5, "")])
    assert sum(r.kept for r in copy_groups(df).collect()) == 4


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def expected_components(corpus):
    sets = {i: shingles(t) for i, t in corpus}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label, sets


def test_near_duplicates(docs, corpus):
    label, sets = expected_components(corpus)
    rows = near_duplicates(docs).collect()
    assert len(rows) == len(corpus)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {
        (i, len(sets[i]), label[i], label[i] == i) for i in label}


def test_near_duplicates_chain(spark):
    """Links A-B-C-... where the ends are far apart, and a text that only one
    member of a group is linked with."""
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[4 * i:] + [f"n{j}" for j in range(4 * i)])) for i in range(12)]
    rows += [(100 + i, " ".join(words[:i * 2] + [f"e{i}"] + words[i * 2 + 1:])) for i in range(30)]
    label, _ = expected_components(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == label


def test_near_duplicates_without_links(spark, empty):
    assert near_duplicates(empty).collect() == []
    df = spark.createDataFrame([(1, "a b c d e f"), (None, "q r s"), (None, None), (2, None)], "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect()}
    assert got == {(1, 2, 1, True), (None, 1, None, True), (None, 0, None, True), (2, 0, 2, True)}


def test_drop_near_duplicates(docs, corpus):
    label, _ = expected_components(corpus)
    out = drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {i for i in label if label[i] == i}


def test_near_duplicates_link_every_text_of_a_repeated_id(spark):
    """Doc 1 has two texts; each has a near copy that must be linked."""
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a[:-1])), (3, " ".join(b[:-1])), (None, " ".join(b[1:]))]
    rows += [(None, "q r s t u v")] * 2
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == Counter(
        [(1, 1, True)] * 2 + [(2, 1, False), (3, 1, False), (None, 1, False)] + [(None, None, True)] * 2)


def test_drop_near_duplicates_leaves_one_row_of_each_component(spark):
    a, b = ([f"{x}{i}" for i in range(60)] for x in "ab")
    rows = [(4, " ".join(a))] * 30 + [(4, "  ".join(a)), (5, " ".join(a[1:])), (None, " ".join(a[:-1]))]
    rows += [(None, " ".join(b[:60 - k])) for k in range(3)] * 4 + [(6, ""), (6, " "), (7, ""), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter((r.doc_id, r.text[:1].strip()) for r in drop_near_duplicates(df).collect())
    assert got == Counter([(4, "a"), (None, "b"), (6, ""), (7, ""), (None, "")])


def expected_cuts(corpus):
    first = {}
    words = [(i, (t or "").encode().split()) for i, t in corpus]
    for i, w in words:
        for k in range(len(w) - 12):
            key = tuple(w[k:k + 13])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = np.zeros(len(w), dtype=bool)
        for k in range(len(w) - 12):
            if first[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = True
        out.append((i, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_cut_repeats(docs, corpus, empty):
    want = expected_cuts(corpus)
    assert any(r for _, _, r, _ in want)
    assert Counter(tuple(r) for r in cut_repeats(docs).collect()) == Counter(want)
    assert {(r.doc_id, r.kept_sha256) for r in repeat_digests(docs).collect()} == {
        (i, hashlib.sha256(k.encode()).hexdigest()) for i, _, _, k in want}
    assert cut_repeats(empty).collect() == []


def test_alignments_do_not_matter(spark):
    """The same run of 13 words at every pair of offsets modulo the period."""
    run = [f"s{i}" for i in range(13)]
    rows = [(i * 20 + j, " ".join([f"p{i}-{j}-{k}" for k in range(i)] + run + [f"q{i}-{j}"])) for i in range(8) for j in (0, 1)]
    got = {r.doc_id: r.n_removed for r in cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 13 * (i > 0) for i, _ in rows}


def test_null_id_is_last(spark):
    run = " ".join(f"s{i}" for i in range(14))
    df = spark.createDataFrame([(None, run), (7, run)], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed) for r in cut_repeats(df).collect()} == {(None, 14), (7, 0)}


def test_copies_of_one_id_share_their_places(spark):
    """The places of a text are collected once, however often it is repeated."""
    text = " ".join(f"s{i}" for i in range(40))
    rows = [(7, 1, 2, text.encode())] + [(9, 1, 2, text.encode())] * 30
    got = repeated_places(spark.createDataFrame(rows, "doc_id long, mark long, more long, text binary")).collect()
    assert [(r.doc_id, sorted(r.places)) for r in got] == [(9, list(range(28)))]
    df = spark.createDataFrame([(7, text)] + [(None, text)] * 30, "doc_id long, text string")
    assert Counter((r.doc_id, r.n_removed) for r in cut_repeats(df).collect()) == Counter([(7, 0)] + [(None, 40)] * 30)


def thue_morse(a: str, b: str, n: int = 1024) -> str:
    return "".join(b if i.bit_count() % 2 else a for i in range(n))


def test_words_that_a_polynomial_hash_confuses(spark):
    """A Thue-Morse word and its swap are different words: neither shingles nor
    windows of one are those of the other."""
    one, two = thue_morse("a", "b"), thue_morse("b", "a")
    tail = " ".join(f"w{i}" for i in range(14))
    rows = [(1, one), (2, two), (3, f"{one} {tail}"), (4, f"{two} {tail}"), (5, f"{two} {tail} end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert got[1] == 1 and got[2] == 2 and got[4] == got[5]
    cut = {r["doc_id"]: r["n_removed"] for r in repeat_digests(docs).collect()}
    assert cut == {1: 0, 2: 0, 3: 0, 4: 14, 5: 15}  # 4 and 3 share the 14 words after the first


def test_texts_of_one_id_with_equal_short_hashes(spark):
    """Rows of a doc_id whose texts have equal 32-bit hashes are still cut by
    their own texts."""
    from pyspark.sql import functions as F
    shared = " ".join(f"s{i}" for i in range(13))
    many = spark.range(300_000).select("id", F.when(F.col("id") % 2 == 0, F.concat(F.lit(shared + " x"), "id")).otherwise(
        F.concat_ws(" ", *[F.concat(F.lit(f"o{k}q"), "id") for k in range(14)])).alias("text"))
    pair = many.groupBy(F.hash("text").alias("h")).agg(
        F.count(F.when(F.col("id") % 2 == 0, 1)).alias("even"), F.count(F.when(F.col("id") % 2 == 1, 1)).alias("odd"),
        F.sort_array(F.collect_list(F.struct((F.col("id") % 2).alias("odd"), "text"))).alias("texts")).filter(
        "even > 0 and odd > 0").first()
    cut, whole = pair["texts"][0]["text"], pair["texts"][-1]["text"]
    docs = spark.createDataFrame([(1, shared), (9, cut), (9, whole)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_removed"]) for r in repeat_digests(docs).collect()) == [(1, 0), (9, 0), (9, 13)]


def test_windows_are_compared_a_part_at_a_time(spark, monkeypatch):
    """No one shuffle holds all windows: the least doc_ids come in parts, which together find what one part does."""
    words = " ".join(f"w{i}" for i in range(200)).encode()
    rows = [(i, 0, 0, words) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, mark long, more long, text binary")
    parts, write = [], Stages.write

    def counted(self, df, name):
        out = write(self, df, name)
        if name == "least":
            parts.append(out.count())
        return out
    monkeypatch.setattr(Stages, "write", counted)
    got = {r["doc_id"]: sorted(r["places"]) for r in repeated_places(docs).collect()}
    assert got == {1: list(range(188)), 2: list(range(188))}
    assert sum(parts) == 188 and max(parts) < 188


def test_group_that_is_alike_but_not_similar_is_not_listed_pair_by_pair(spark, monkeypatch):
    """150 texts at a similarity of about 0.5, of which two are linked: rows
    that are compared do not grow with the square of the group."""
    import audival.llm.near_dedup as near_dedup
    base = [f"w{i}" for i in range(80)]
    rows = [(i, " ".join(base + [f"n{i}x{j}" for j in range(40)])) for i in range(150)]
    rows.append((400, rows[77][1].replace("w3 ", "v3 ")))
    label, _ = expected_components(rows)
    compared = []
    write = Stages.write

    def counted(store, df, name):
        out = write(store, df, name)
        if name == "rare":
            compared.append(out.count())
        return out

    monkeypatch.setattr(Stages, "write", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = near_dedup.near_duplicates(df).collect()
    assert {r.doc_id: r.component_id for r in got} == label and label[400] == 77
    # a text whose first quarter of shingles nobody else has takes no part
    assert compared and max(compared) <= len(rows)


def test_tables_are_not_listed(spark, monkeypatch):
    """Members are a row for each key of a side, not for each table."""
    import audival.llm.near_dedup as near_dedup
    base = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(base[:i] + [f"e{i}"] + base[i + 1:])) for i in range(40)]
    sizes, write = {}, Stages.write

    def counted(store, df, name):
        out = write(store, df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(Stages, "write", counted)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}
    assert max(sizes.values()) <= len(rows) * near_dedup.SIDE


def test_anchors_and_texts_are_dealt_a_part_at_a_time(spark, monkeypatch):
    """No one shuffle holds all places of anchors or all texts."""
    words = [" ".join(f"w{k}" for k in range(j % 4 * 50, j % 4 * 50 + 60)).encode() for j in range(40)]
    docs = spark.createDataFrame([(i, 0, 0, t) for i, t in enumerate(words)], "doc_id long, mark long, more long, text binary")
    places, texts, write = [], [], Stages.write

    def counted(self, df, name):
        out = write(self, df, name)
        if name.startswith("anchored"):
            places.append(out.agg(F.sum(F.size("places"))).first()[0] or 0)
        if name.startswith("windows"):
            texts.append(out.select("doc_id").distinct().count())
        return out
    monkeypatch.setattr(Stages, "write", counted)
    got = {r["doc_id"]: sorted(r["places"]) for r in repeated_places(docs).collect()}
    assert {i for i in got if got[i] == list(range(48))} == set(range(4, 40)) == {i for i in got if len(got[i]) == 48}
    assert sum(texts) == 40 and max(texts) < 40 and 0 < max(places) < sum(places)
