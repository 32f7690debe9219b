"""Simple-8b round trips, and the token store against the library on whole texts."""

import struct
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import simple8b
from ledgerlens.llm.arrays import span_hashes, text_bytes
from ledgerlens.llm.token_store import digest_tokens, encoder, read_tokens, store_and_digest, write_tokens
from ledgerlens.session import scratch_path
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


def round_trip(values, group=512):
    words, offsets = simple8b.encode(np.array(values, np.uint64), group)
    assert simple8b.decode(words, len(values), offsets, group).tolist() == list(values)
    return words


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=400),
       st.sampled_from([1, 7, 64, 512]))
def test_round_trip(values, group):
    round_trip(values, group)


def test_edges_and_sizes():
    top = 2**60 - 1
    round_trip([top, top - 1, 2**64 - 1, top, 0] * 50)
    round_trip([2**64 - 1] * 3)
    round_trip([0] * 1000)
    assert len(round_trip([1] * 480, 480)) == 8           # 60 ones a word
    assert len(round_trip([0] * 480, 480)) == 2           # 240 zeros a word
    assert len(round_trip([30000] * 400, 400)) == 100     # 4 values of 15 bits a word
    # a word by hand: selector 14 (two values of 30 bits)
    words, _ = simple8b.encode(np.array([5, 2**29], np.uint64))
    assert words.tolist() == [14 << 60 | 2**29 << 30 | 5]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_words_one_by_one_equal_whole_texts(texts):
    ids, bounds = encoder(PATH).ids(*text_bytes(pa.array(texts)), 2)
    got = [ids[s:e].tolist() for s, e in zip(bounds[:-1], bounds[1:])]
    plain = Tokenizer.from_file(PATH)
    assert got == [plain.encode(t, add_special_tokens=False).ids + [2] for t in texts]


WORDS = ["Word", "word", "word.", "Word$$$", "it's", "don't.", "'s", "x'", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "a<|b", "é.", "É!",
         "H\u0331", "h\u0331", "İ", "Σ", "ΑΣ", "ǰ", "J\u030c", "中文。", "12", "1.2", "²", "½x", "ª.", "…", "ﬁ", "\x85", "\xa0", "\x1c",
         " ", "\n", "\t ", "", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", ",", " , ", "-", "~.", "µ", "\u0301a", "ß"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=12).map("".join), min_size=1, max_size=6))
def test_awkward_words(texts):
    test_words_one_by_one_equal_whole_texts.hypothesis.inner_test(texts)


def expected(rows):
    t, out, start = Tokenizer.from_file(PATH), [], 0
    for doc, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = expected((r.doc_id, r.text) for r in docs.orderBy("doc_id").collect())
    got = sorted(tuple(r) for r in store_and_digest(docs).collect())
    assert got == want


def test_small_blocks_ids_and_repeats(spark):
    rows = spark.createDataFrame([(5, "a b c", "x"), (None, "early", "x"), (5, "a b c", "y"), (1, None, "z"),
                                  (2, "", "z"), (9, "word " * 3000, "z"), (7, "\x1c a\x1fb　c <|endoftext|>d", "z")],
                                 "doc_id long, text string, part string")
    path = scratch_path(spark, "test-tokens")
    write_tokens(rows, path, PATH, 2, block_ids=3)
    order = [(None, "early"), (1, None), (2, ""), (5, "a b c"), (5, "a b c"), (7, "\x1c a\x1fb　c <|endoftext|>d"),
             (9, "word " * 3000)]
    key = lambda r: (r[1], r[2], r[3])
    assert sorted((tuple(r) for r in digest_tokens(spark, path).collect()), key=key) == expected(order)
    t = Tokenizer.from_file(PATH)
    whole = {r.doc_id: r.ids for r in read_tokens(spark, path).collect()}
    assert whole[9] == t.encode("word " * 3000, add_special_tokens=False).ids + [2]
    assert whole[None] == t.encode("early", add_special_tokens=False).ids + [2]


def test_empty_table(spark):
    rows = spark.createDataFrame([], "doc_id long, text string")
    assert store_and_digest(rows, PATH).collect() == []


def test_end_id_is_a_parameter(spark):
    rows = spark.createDataFrame([(1, "")], "doc_id long, text string")
    path = scratch_path(spark, "test-tokens")
    write_tokens(rows, path, PATH, 49407)
    assert [r.ids for r in read_tokens(spark, path).collect()] == [[49407]]


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 2000])
def test_group_borders(n):
    round_trip(np.random.default_rng(n).integers(0, 50000, n).tolist())


def thue_morse(n, a="a", b="b"):
    word = a
    while len(word) < n:
        word += word.translate(str.maketrans(a + b, b + a))
    return word, word.translate(str.maketrans(a + b, b + a))


@pytest.mark.parametrize("n", [64, 128, 256, 512, 1024, 4096])
def test_words_that_collide_in_polynomial_hashes(n):
    pair = thue_morse(n)
    data = np.frombuffer("".join(pair).encode(), np.uint8)
    one, other = span_hashes(data, np.array([0, n]), np.array([n, 2 * n]))
    assert one != other
    library = Tokenizer.from_file(PATH)
    raw, offsets = text_bytes(pa.array(list(pair)))
    ids, bounds = encoder(PATH).ids(raw, offsets, 2)
    for k, text in enumerate(pair):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids + [2]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=600), max_size=8))
def test_span_hash_depends_on_the_bytes_alone(spans):
    data = np.frombuffer(b"xyz" + b"".join(spans), np.uint8)
    ends = 3 + np.cumsum([len(s) for s in spans], dtype=np.int64) if spans else np.zeros(0, np.int64)
    got = span_hashes(data, ends - np.array([len(s) for s in spans], np.int64), ends)
    alone = [int(span_hashes(np.frombuffer(s, np.uint8), np.array([0]), np.array([len(s)]))[0]) for s in spans]
    assert got.tolist() == alone
    assert len(set(alone)) == len(set(spans))
