"""Words and blanks by ranges: the same for every character, and no slower class than needed."""

import re

from pyspark.sql import functions as F

from corpusloom.functions import text as T


def test_solid_is_all_that_is_no_white_space(spark):
    solid = re.compile("[" + T.SOLID.replace("\\x{10ffff}", "\\U0010ffff") + "]")
    chars = [chr(k) for k in range(0x110000)]
    assert {c for c in chars if not solid.match(c)} == set(T.BLANKS) == {c for c in chars if c.isspace()}
    some = [chr(k) for k in [*range(0x3100), 0xD7FF, 0xE000, 0xFFFF, 0x1F600, 0x10FFFF]]
    rows = spark.createDataFrame([(f"{c}a{c} b",) for c in some], "t string").select("t", T.word_count(F.col("t")).alias("n")).collect()
    assert all(r.n == len(r.t.split()) for r in rows) and len(rows) == len(some)


def test_paragraphs_are_cleaned_at_every_blank(spark):
    rows = [(f"said.12{c}so{c}{c}, we{c}go",) for c in T.BLANKS]
    got = {r[0] for r in spark.createDataFrame(rows, "t string").select(T.clean_paragraph(F.col("t"))).collect()}
    assert got == {"said. so, we go"}


def test_few_texts_are_strings_at_once(spark):
    from unittest import mock

    import pyarrow as pa

    sizes, real = [], pa.array
    with mock.patch.object(T.pa, "array", lambda x, *a: sizes.append(len(x)) or real(x, *a)):
        got = T._nfkc.func(real(["\ufb01", None] * 500))
    assert got.to_pylist() == ["fi", None] * 500 and max(sizes) <= T.NFKC_ROWS
