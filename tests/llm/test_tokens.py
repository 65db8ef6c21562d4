"""BPE transducer and token files against the tokenizers library."""

import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from audival.llm import token_files as T
from audival.llm.bpe import Transducer, round_trip, sufficient_lookahead
from audival.llm.shared import together
from audival.llm.token_files import ShardReader, token_digests, write_tokens

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "the", " the", "in", "abc", "Ω", "Σ", "ß", "İ", "中", "0123", "=-_", "é", "\x85", "\xa0", "\u2003", "\x1c", "\x00",
          "'s", "'LL", " ", "  ", "\n", "<|endoftext|>", "<|startoftext|>", "<|", "🙂", "ﬁ", "ǅ", "ᄀ", "ᅡ", "²", "\u200d", "\r\n"]


def random_texts(n):
    r = random.Random(6)
    out = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 30))) for _ in range(n)]
    return out + ["".join(r.choice("etaoin"[:r.randint(1, 6)]) for _ in range(r.randint(100, 2000))) for _ in range(40)]


@pytest.fixture(scope="module")
def coder():
    return Transducer(WORD)


def test_encode_and_decode_match_the_library(coder):
    library = Tokenizer.from_file(WORD)
    for text in random_texts(1500):
        want = library.encode(text, add_special_tokens=False).ids
        got = coder.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want
        decoded = b"".join(coder.decode_pieces(got, 5)).decode()
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_stream_is_stable_at_any_room(coder):
    """Long words, in pieces of any size and with the smallest buffer, give the
    ids of the whole word."""
    r, library = random.Random(2), Tokenizer.from_file(WORD)
    vocab = sorted(w for w in library.get_vocab() if w.isascii() and w.isalpha())
    for _ in range(30):
        word = "".join(r.choice(vocab) for _ in range(r.randint(50, 800))).lower()
        want = library.encode(word, add_special_tokens=False).ids
        raw, at, pieces = word.encode(), 0, []
        while at < len(raw):
            n = r.randint(1, 200)
            pieces.append(raw[at:at + n])
            at += n
        for room in (coder.lookahead + 1, 2 * coder.lookahead, None):
            assert list(coder.stream(pieces, room)) == want


def test_lookahead_of_a_small_list():
    # a b -> 3, 3 3 -> 4: a boundary may wait for one more "ab"
    assert sufficient_lookahead({(1, 2): (0, 3), (3, 3): (1, 4)}) == 2
    assert sufficient_lookahead({}) == 1


def test_decode_text_is_incremental(coder):
    ids = np.frombuffer(coder.encode("Grüße 中文 x"), "<u4").tolist()
    assert "".join(coder.decode_text(ids)) == "grüße 中文 x "


def test_round_trip(docs, corpus, empty):
    library = Tokenizer.from_file(WORD)
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip(docs, WORD).collect()}
    want = set()
    for i, t in corpus:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.add((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want
    assert round_trip(empty, WORD).collect() == []
    assert round_trip(docs.filter("doc_id = 133"), WORD, with_ids=True).first().ids == \
        library.encode("one two", add_special_tokens=False).ids


def test_token_files(spark, docs, corpus, empty):
    library = Tokenizer.from_file(BYTE)
    extra = list(enumerate(random_texts(300), 1000))
    more = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    index = write_tokens(more, BYTE, sequence=16, batch=3)
    got = sorted(tuple(r) for r in token_digests(index).collect())
    start, want, streams = 0, [], {}
    for i, t in sorted(corpus + extra, key=lambda x: (x[0], x[1] or "")):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        streams[i] = ids
        start += len(ids)
    assert got == sorted(want)
    # random access, without a copy, to any sequence of a shard
    row = index.filter("doc_id = 135").first()
    reader = ShardReader(row.shard)
    k, lo = divmod(row.at, 16)
    ids, mask = reader.sequence_of(k + 1)
    assert ids.to_pylist() == streams[135][16 - lo:32 - lo].tolist() and all(mask.to_pylist())
    assert token_digests(write_tokens(empty, BYTE)).collect() == []


def test_cut_texts_encode_as_the_library_does_whole():
    coder = T.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    parts = ["a", "b", " ", "  ", "\n", " \n", "\t", "é", "'s", "12", "...", "中", " ", "<|endoftext|>", "\U0001f600",
             " don't", "\x00", "\x1c", "Ġ", "w" * 80]
    rnd = random.Random(3)
    texts = ["", " ", "<|endoftext|> a", "a <|endoftext|>"] + [
        "".join(rnd.choices(parts, k=rnd.randint(0, 20))) for _ in range(3000)]
    got, column = [], pa.array(texts)
    for lo, n in together(column, 5000):
        got += coder.encode(column.slice(lo, n))
    assert got == coder.library_ids(texts)
    assert [n for _, n in together(pa.array(["x" * 9, "y" * 30, "", "z"]), 10)] == [1, 1, 2]
    assert list(together(pa.array([], pa.string()))) == []


def test_letters_of_a_later_unicode_encode_as_in_the_library(coder):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    r = random.Random(9)
    later = [chr(c) for c in (0x88F, 0x1C89, 0x1C8A, 0xA7CB, 0xA7CC, 0xA7DA, 0x10D50, 0x10D40, 0x323B0)]
    for _ in range(1500):
        text = "".join(r.choice([*later, "a", "B", " ", "1", "é", "!", "Σ"]) for _ in range(r.randint(1, 12)))
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == want, text.encode("unicode-escape")


def test_one_letter_beyond_ascii_does_not_slow_a_text_down(coder):
    plain = "some words that repeat " * 20_000
    for extra in ("é", "\u1c89"):
        coder.encode(plain + extra)  # words remembered, the library's view loaded
        begin = time.process_time()
        coder.encode(plain + extra)
        assert time.process_time() - begin < 1.5  # 460,000 characters at 3 microseconds
