import hashlib
import random

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusloom.llm import rank_bpe as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
LIBRARY = Tokenizer.from_file(PATH)
ROWS = [(-1, None), (-2, ""), (-3, "  a  b\n\n\nc \n d\t e   x \x1c y\n"), (-4, "a<|endoftext|> b<|endoftext|><|endoftext|>"), (-5, " it's  we'll\n 's <|endoftext|"), (None, "a b"), (None, None), (-6, " "), (1, "the same words the same"), (1, "the same words the same"), (2, "日本語 é😀 word́ \x85 x"), (3, "x" * 150_000), (4, "ab" * 300 + " " + "é" * 97)]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_equals_the_library(spark):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in ROWS], "doc_id long, text string, ids string, decoded string")
    got = B.rank_bpe(docs, PATH, PATTERN).collect()
    want = [(i, len(ids_of(t)), np.array(ids_of(t), "<u4").tobytes(), LIBRARY.decode(ids_of(t), skip_special_tokens=False)) for i, t in ROWS]
    key = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted([(r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got], key=key) == sorted(want, key=key)


def test_digests(spark):
    row = B.rank_bpe(spark.createDataFrame([(1, "Some text.")], "doc_id long, text string"), PATH, PATTERN, digest=True).first()
    assert row.ids_sha256 == hashlib.sha256(np.array(ids_of("Some text."), "<u4").tobytes()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(b"Some text.").hexdigest()


def test_empty_table(spark):
    assert B.rank_bpe(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t\x1c\x85abtheins'.1é日😀ß 　²")) | st.characters(blacklist_categories=["Cs"]), max_size=60), max_size=5))
def test_any_text(texts):
    voc = B.vocabulary(PATH, PATTERN)
    assert [x.tolist() for x in voc.encode(texts)] == [ids_of(t) for t in texts]


def test_matrix_heap_and_blocks_agree():
    rng, voc = random.Random(3), B.vocabulary(PATH, PATTERN)
    pieces = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, B.SHORT))).encode() for _ in range(400)]
    assert voc.merge(pieces) == [voc.merge_long(p) for p in pieces]
