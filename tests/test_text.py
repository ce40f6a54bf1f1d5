import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import segment

VALID = " ".join(["Human beings act with purpose and choose among scarce means to reach the ends they value most."] * 9)


def one(spark, f, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", f(F.col("v")).alias("r")).orderBy("i")
    return [r.r for r in rows.collect()]


def test_clean_text(spark):
    given = ["a   b\t\tc", "econom-\nics", "line one\nline two", "para one\n\npara two", "a\n\n\n\n\nb", "\n\nhello\n\n", "é-\né", "a\nb\nc", "\x1cx ", None]
    assert one(spark, T.clean_text, *given) == ["a b c", "economics", "line one line two", "para one\n\npara two", "a\n\nb", "hello", "éé", "a b c", "x", None]


def test_normalize(spark):
    assert one(spark, T.normalize, "“ﬁne” – it’s—so  x", "plain\t text", None) == ['"fine" - it\'s--so x', "plain text", None]


def test_chunk_rules(spark):
    given = ["", None, "too short to keep", "CONTENTS " + VALID, "COPYRIGHT 2020 " + VALID, "ISBN 978-0-1234 " + VALID, "123 456 789 0 " * 40, VALID]
    assert one(spark, T.is_valid_chunk, *given) == [False] * 7 + [True]


def test_junk_lines(spark):
    given = ["47", "civil", "M", "Chapter ..... 12", "Capital, 44, 88, 132-140", "in 1987 12 12", "A plain sentence.", "x" + "a" * 20000 + ", 1" * 3000 + "!"]
    assert one(spark, T.is_junk_line, *given) == [True, True, False, True, True, True, False, False]


def test_clean_paragraph(spark):
    assert one(spark, T.clean_paragraph, "said.12 so , we", "3.14 x", "1,000 x", "  a\n b  ") == ["said. so, we", "3. x", "1, x", "a b"]


def test_paragraphs(spark):
    assert one(spark, T.paragraphs, "one\n\ntwo\n\n\nthree", "  one  \n\n   \n\n two ") == [["one", "two", "three"], ["one", "two"]]


@pytest.mark.parametrize("word", "ITERATION MIXED LIVELY CIVIC DID MIMI".split())
def test_words_are_no_numerals(spark, word):
    assert [c.title for c in one(spark, segment.chapters, f"PART {word} of the rules\nbody")[0]] == ["Full Text"]


def test_chapters(spark):
    cases = {
        "no heading": ["Full Text"],
        "Preface.\nCHAPTER 1 The Origins\nContent one.\nCHAPTER 2 The Decline\nContent two.": ["Preamble", "CHAPTER 1 The Origins", "CHAPTER 2 The Decline"],
        "Intro.\nPART I\nAlpha.\nCHAPTER IV\nBeta.": ["Preamble", "PART I", "CHAPTER IV"],
        "chapter 1 informal heading\nbody": ["Full Text"],
        "\n\n\nCHAPTER 1 Origins\nBody one.": ["CHAPTER 1 Origins"],
        "CHAPTER\nCHAPTER 2 B": ["Full Text"],
        "CHAPTER\nIV": ["CHAPTER"],
        **{f"PART {n}\nbody": [f"PART {n}"] for n in "I IV IX XIV XL XC CD CM MMXXIV".split()},
    }
    got = one(spark, segment.chapters, *cases)
    assert [[c.title for c in g] for g in got] == list(cases.values())


def model_chunks(tokens, target, overlap):
    """Straight-line model of the chunk rule over token counts: lists of paragraph numbers."""
    out, now = [], []
    for k, t in enumerate(tokens):
        if sum(tokens[i] for i in now) + t > target:
            if now:
                out.append(now)
            keep = []
            for i in now[::-1]:
                if sum(tokens[j] for j in keep) + tokens[i] > overlap:
                    break
                keep = [i, *keep]
            now = keep
        now = [*now, k]
    return out + [now] if now else out


def test_chunks_equal_the_model(spark):
    import random

    rng = random.Random(5)
    docs = [(i, [rng.choice([1, 3, 10, 40, 90, 100, 101, 400, 800, 900]) for _ in range(rng.randint(0, 25))]) for i in range(120)]
    got = spark.createDataFrame(docs, "i int, t array<bigint>").select("i", segment.chunk_ranges(F.col("t"), 800, 100).alias("r")).collect()
    for r in got:
        tokens = docs[r.i][1]
        want = model_chunks(tokens, 800, 100)
        assert [(x.lo, x.hi, x.n) for x in r.r] == [(w[0], w[-1], sum(tokens[k] for k in w)) for w in want]


def test_chunk_text(spark):
    a, b, c = "a " * 800, "b " * 100, "c " * 800
    docs = spark.createDataFrame([(1, [a, b, c]), (2, ["", None, "  "]), (3, ["alpha", "", " ", "beta"])], "i int, p array<string>")
    got = segment.chunks(docs, "p").orderBy("i", "chunk_no").collect()
    assert [(r.i, r.chunk_no, r.chunk) for r in got] == [(1, 1, a), (1, 2, b), (1, 3, b + "\n\n" + c), (3, 1, "alpha\n\nbeta")]


def test_reply_and_links(spark):
    assert one(spark, T.carve_json, 'x ```json\n{"a": {"b": 1}}\n``` y', "none", '} x {') == ['{"a": {"b": 1}}', "none", ""]
    html = '<a href="https://cdn.example.org/a%20b+c.pdf">x</a>'
    assert one(spark, lambda c: T.pdf_link(c, "cdn.example.org"), html, "no") == ["a b+c.pdf".join(["https://cdn.example.org/", ""]), None]
    assert one(spark, T.stem, "a/b.c.txt", ".hidden") == ["a/b.c", ".hidden"]
    assert re.fullmatch(r"2\.50 GB", spark.range(1).select(T.human_bytes(F.lit(2.5e9)).alias("h")).first().h)
