"""SentencePiece coding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from audival.llm import pieces
from audival.llm.pieces import REMEMBERED, SHORT, PieceCoder, piece_round_trip

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", " the", "in", "abc", "Ω", "ß", "İ", "中", "文字", "0123", "=-_", "é", "é", "\x85", "\xa0", " ",
         "\x1c", "\x00", " ", "  ", "    ", "\n", "\r\n", "\t", "▁", "<s>", "</s>", "<unk>", "<0x0A>", "🙂", "👩‍👧", "ᄀ", "‍",
         "�", "﻿", "function", "ation", "heit", "ſ"]


@pytest.fixture(scope="module")
def coder():
    return PieceCoder(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def random_texts(n):
    r = random.Random(13)
    out = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 40))) for _ in range(n)]
    out += ["".join(r.choice("etaoin shrdlu"[:r.randint(1, 13)]) for _ in range(r.randint(100, 3000))) for _ in range(60)]
    out += ["".join(chr(r.choice([r.randint(0, 0x2FF), r.randint(0x3000, 0xD7FF), r.randint(0x10000, 0x1F9FF)]))
                    for _ in range(r.randint(1, 60))) for _ in range(300)]
    return out + ["", " ", "  ", "\n", "▁", " ▁ ", "a" * 20_000, "ab" * 9_000, " " * 5_000, "\x00" * 50]


def test_ids_and_text_are_those_of_the_library(coder, library):
    for text in random_texts(2500):
        want = library.encode(text, add_bos=True, add_eos=True)
        got = coder.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want, text[:80]
        assert coder.decode(got).decode() == library.decode(want)


def test_any_ids_decode_as_in_the_library(coder, library):
    r = random.Random(3)
    spaces = [library.piece_to_id(p) for p in ("▁", "▁▁", "▁a")]
    for _ in range(4000):
        ids = [r.choice([r.randint(0, 2), r.randint(3, 258), r.choice(spaces), r.randrange(32_000)])
               for _ in range(r.randint(0, 12))]
        assert coder.decode(np.array(ids, "<u4").tobytes()).decode() == library.decode(ids), ids


def test_the_agenda_takes_the_best_pair_first_and_the_leftmost_of_ties(coder):
    """The plain definition: join the best pair, the leftmost of equals, until
    there is none."""
    def plain(s):
        now = list(s)
        while True:
            best = min(((coder.order[a + b], i) for i, (a, b) in enumerate(zip(now, now[1:])) if a + b in coder.order),
                       default=None)
            if best is None:
                return now
            now[best[1]:best[1] + 2] = ["".join(now[best[1]:best[1] + 2])]
    r = random.Random(8)
    for _ in range(400):
        s = "".join(r.choice(["a", "b", "th", "e", "in", "▁", "ing", "l", "é"]) for _ in range(r.randint(0, 40)))
        assert coder.pieces(s) == plain(s)
        if s:
            three = [s, s[::-1], s]
            got = {int(i): [coder.names[n] for n in row] for who, symbols in coder.lockstep(three)
                   for i, row in zip(who, symbols)}
            assert got == {i: plain(t) for i, t in enumerate(three)}


def test_remembered_segments_are_bounded(coder):
    coder.forget()
    for i in range(3000):
        coder.encode(f"word{i} " + "x" * (SHORT + i % 3))
    assert len(coder.young) + len(coder.old) <= 2 * REMEMBERED
    coder.forget()
    texts = [f"word{i} more{i % 7}" for i in range(500)]
    small, pieces.REMEMBERED = pieces.REMEMBERED, 40
    try:
        one_by_one = [coder.encode(t) for t in texts]
        assert len(coder.young) + len(coder.old) <= 2 * (40 + 2)
    finally:
        pieces.REMEMBERED = small
    assert coder.encode_all(texts) == one_by_one
    assert max(map(len, [*coder.young, *coder.old])) <= SHORT
    coder.forget()


def test_table(spark, docs, corpus, empty, library):
    out = piece_round_trip(docs, PATH, check=True)
    rows = out.collect()
    want = []
    for i, text in corpus:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest(), True))
    assert sorted(map(tuple, rows)) == sorted(want)
    ids = {r["doc_id"]: r["ids"] for r in piece_round_trip(docs.filter("doc_id = 133"), PATH, with_ids=True).collect()}
    assert ids == {133: library.encode("one two", add_bos=True, add_eos=True)}
    assert piece_round_trip(empty, PATH, check=True).collect() == []


def test_other_vocabularies_are_refused(tmp_path, library):
    other = tmp_path / "unigram.model"
    raw = library.serialized_model_proto()
    # a second trainer field of type unigram in front of the file's own
    other.write_bytes(bytes([0x12, 2, 0x18, 1]) + raw)
    with pytest.raises(ValueError, match="merge-type"):
        PieceCoder(str(other))
