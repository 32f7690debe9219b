"""Token counts against the library itself."""

import random
import time

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm.token_count import count_tokens, merger
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_hand_made_texts(sp):
    texts = ["", " ", "  ", "a  b", " a", "a ", "▁▁x", "x▁y", "a" * 5000, "aaab" * 700, "the " * 3000,
             "\n\n\ta\n b", "あ一\U0001f600 é é", "<s> </s> <unk> <0x0A>", "\x00﻿", "ab" * 999 + " " * 70,
             "0123456789" * 300, "https://a.example.com/x?y=" + "abcdefgh" * 200, "==== ---- ....", "lllllllllllllllllll"]
    assert merger(PATH).count_texts(texts) == [len(x) for x in sp.encode(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcdeinorst \n▁é-.=1", max_size=60), max_size=8))
def test_random_texts(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    assert merger(PATH).count_texts(texts) == [len(x) for x in sp.encode(texts)] if texts else True


def test_random_pieces(sp):
    r = random.Random(3)
    pieces = [sp.id_to_piece(i) for i in range(259, sp.get_piece_size())]
    texts = ["".join(r.choice(pieces) for _ in range(r.randint(1, 12))) for _ in range(3000)]
    assert merger(PATH).count_texts(texts) == [len(x) for x in sp.encode(texts)]


def _blobs(n):
    r = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    return ["".join(r.choice(letters) for _ in range(n)), "".join(r.choice("ab") for _ in range(n)), "a" * n, "ab" * (n // 2),
            "".join(r.choice(letters + letters.upper() + "0123456789+/") for _ in range(n)), "=-" * (n // 2) + "x",
            "".join(r.choice("あ一é\U0001f600a") for _ in range(n)), "ing" * (n // 3), "aab" * (n // 3), "\n" * n,
            "".join(r.choice(["the", "ing", "tion", "er", "qz"]) for _ in range(n // 3))]


@pytest.mark.parametrize("n", [399, 400, 1200, 9000])
def test_long_pre_tokens(sp, n):
    blobs = _blobs(n)
    want = [len(x) for x in sp.encode(blobs)]
    assert merger(PATH).count_texts(blobs) == want
    marked = ["▁" + b for b in blobs]
    assert merger(PATH).count_long(marked).tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="abcdeinorst\n▁é-.=1", min_size=1, max_size=60), min_size=1, max_size=8))
def test_both_ways_agree(sequences):
    m = merger(PATH)
    assert m.count_long(sequences).tolist() == m.count(sequences).tolist()


def test_a_megabyte_without_a_blank(sp):
    blob = _blobs(1_000_000)[0]
    m = merger(PATH)
    m.known.clear()
    begin = time.perf_counter()
    got = m.count_texts([blob])
    assert time.perf_counter() - begin < 30         # the cost of rounds over the whole array is half an hour
    assert got == [len(sp.encode(blob))]


def test_whole_table(spark, sp):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs, "piece_bpe_32k.model").collect()}
    assert got == {r.doc_id: (len(r.text.encode()), len(sp.encode(r.text))) for r in docs.collect()}


def test_nulls_empty_table_and_extra_columns(spark):
    rows = spark.createDataFrame([(None, "a b", "x"), (1, None, "y"), (1, "", None), (1, "", None)],
                                 "doc_id long, text string, n_tokens string")
    got = sorted(tuple(r) for r in count_tokens(rows, PATH).fillna(-1, ["doc_id"]).collect())
    assert got == [(-1, 3, 2), (1, 0, 0), (1, 0, 0), (1, 0, 0)]
    assert count_tokens(rows.limit(0), PATH).collect() == []
