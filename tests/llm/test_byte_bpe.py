import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import byte_bpe as B

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ROWS = [(-1, None), (-2, ""), (-3, "  a  b\n\n\nc \n d\t e   x \x1c y\n"), (-4, "\n\nx"), (-5, " it's  we'll\n 's"), (None, "a b"), (-6, " "), (-7, "a  b \x85c  \n\n"), (1, "the same words the same"), (1, "the same words the same"), (2, "日本語 é😀 word")]


def ids_of(text):
    return B.encoder(RANKS, public_tokenizers.PATTERN).encode_ordinary(text or "")


def test_round_trip_equals_the_library(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in ROWS], "doc_id long, text string, n_tokens string")
    got = B.bpe_round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = [(i, len(ids_of(t)), np.array(ids_of(t), "<u4").tobytes(), (t or "").encode()) for i, t in ROWS]
    key = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted([(r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got], key=key) == sorted(want, key=key)


def test_digests(spark):
    docs = spark.createDataFrame([(1, "Some text.")], "doc_id long, text string")
    row = B.bpe_round_trip(docs, RANKS, public_tokenizers.PATTERN, digest=True).first()
    assert row.ids_sha256 == hashlib.sha256(np.array(ids_of("Some text."), "<u4").tobytes()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(b"Some text.").hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert B.bpe_round_trip(docs, RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\x1c\x85ab'.1é", max_size=40))
def test_words_give_the_ids_of_the_text(text):
    enc = B.encoder(RANKS, public_tokenizers.PATTERN)
    assert [i for w in B.cut(text) for i in enc.encode_ordinary(B.word_text(w))] == enc.encode_ordinary(text)


def test_packing():
    for values in ([], [0], [70000, 1], list(range(300))):
        a = np.array(values, np.uint32)
        assert (B._unpack_ints(B._pack_ints(a)) == a).all()
