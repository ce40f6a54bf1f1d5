"""Column functions over texts: cleaning, tests and counts, all as built-in expressions.

White space is listed character by character, so no expression needs the slow Unicode classes; steps
that need a rare pattern first look for a literal part of it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters that count as white space.
BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # the same in a character class
# All other characters, as ranges of which the first has most letters: a regular expression tries them in turn,
# while a negated class tries every range of white space on each letter.
SOLID = r"!-\x84\xa1-\u167f\u3001-\x{10ffff}\x86-\x9f\u1681-\u1fff\u200b-\u2027\u202a-\u202e\u2030-\u205e\u2060-\u2fff\x00-\x08\x0e-\x1b"
NO_LETTER = r"(?![!-\x84])"  # before white space: passes most characters after one test

# Thresholds and phrases of the chunk and page rules.
MIN_CHUNK_WORDS = 80
SHORT_TITLE_WORDS = 150
BANNED_PHRASES = ["CONTENTS", "COPYRIGHT", "ISBN", "HARPER & BROTHERS"]
TITLE_PHRASE = "ECONOMICS IN ONE LESSON"
JUNK_DIGIT_SHARE = 0.28
MATTER_TITLES = ["contents", "table of contents", "index", "bibliography", "references", "acknowledgments", "acknowledgements", "about the author", "copyright", "notes", "endnotes", "further reading", "appendix"]
NFKC_ROWS = 64  # texts that are Python strings at once
ROMAN = "M{0,3}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})"


def strip(c: Column) -> Column:
    """Without white space at both ends, in the Unicode sense."""
    return F.btrim(c, F.lit(BLANKS))


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a column that is evaluated once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def _where(part: str, changed: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """``changed`` texts that hold a literal part, the others as they are."""
    return lambda x: F.when(F.contains(x, F.lit(part)), changed(x)).otherwise(x)


# The patterns of the cleaning steps below.
def blanks_to_one(c: Column) -> Column:
    return F.regexp_replace(c, "[ \\t]{2,}|\\t", " ")


def join_hyphens(c: Column) -> Column:
    """Words that a hyphen breaks over two lines."""
    return bound(c, _where("-\n", lambda x: F.regexp_replace(x, r"(?U)(\w)-\n(\w)", "$1$2")))


def unwrap_lines(c: Column) -> Column:
    return bound(c, _where("\n", lambda x: F.regexp_replace(x, r"\n(?!\n)(?<!\n\n)", " ")))


def limit_blank_lines(c: Column) -> Column:
    return bound(c, _where("\n\n\n", lambda x: F.regexp_replace(x, r"\n{3,}", "\n\n")))


def clean_text(c: Column) -> Column:
    """Blanks, hyphens, wrapped lines, blank lines, ends: in this order."""
    return strip(limit_blank_lines(unwrap_lines(join_hyphens(blanks_to_one(c)))))


@F.arrow_udf(StringType())
def _nfkc(batch: pa.Array) -> pa.Array:
    """Few texts at a time are Python strings, however many a batch has."""
    made = (pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in batch.slice(k, NFKC_ROWS).to_pylist()], pa.string()) for k in range(0, len(batch), NFKC_ROWS))
    return pa.concat_arrays([pa.array([], pa.string()), *made])


def normalize(c: Column) -> Column:
    """Compatibility form, plain quotes and dashes, single blanks.  Only texts beyond ASCII go to the
    Python step; for the others it gets a null."""
    form = F.coalesce(_nfkc(F.when(F.octet_length(c) != F.char_length(c), c)), c)
    plain = lambda x: F.replace(F.translate(x, "‘’“”–", "''\"\"-"), F.lit("—"), F.lit("--"))
    return blanks_to_one(bound(form, lambda x: F.when(F.octet_length(x) != F.char_length(x), plain(x)).otherwise(x)))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(rf"[{SOLID}]++")).cast("int")


def letter_count(c: Column) -> Column:
    return F.octet_length(F.regexp_replace(c, "[^A-Za-z]+", ""))


def digit_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\p{Nd}"))


def reject_reason(c: Column) -> Column:
    """Why a chunk is no learning material; null if it may stay.  The stripped text, its words and its
    upper case are made once; cheap tests come first."""

    def reason(s: Column) -> Column:
        text, words, upper = s["text"], s["words"], s["upper"]
        found = F.when(words < MIN_CHUNK_WORDS, "short")
        for phrase in BANNED_PHRASES:
            found = found.when(F.contains(upper, F.lit(phrase)), phrase.lower())
        found = found.when(F.contains(upper, F.lit(TITLE_PHRASE)) & (words < SHORT_TITLE_WORDS), "title page")
        return found.when(~text.rlike("[A-Za-z]"), "no letters").when(digit_count(text) > letter_count(text), "numeric")

    parts = lambda t: F.struct(t.alias("text"), word_count(t).alias("words"), F.upper(t).alias("upper"))
    return F.when(c.isNull() | (c == ""), "empty").otherwise(bound(bound(strip(c), parts), reason))


def is_valid_chunk(c: Column) -> Column:
    return reject_reason(c).isNull()


def is_junk_line(c: Column) -> Column:
    """Page numbers, contents entries, index entries and lines of mostly digits."""
    # The patterns of such lines.
    number_only = c.rlike(rf"^[\p{{Nd}}ivxlcDIVXLC.\-–—{SPACE}]+$")
    dotted = F.contains(c, F.lit("...."))
    entry = F.contains(c, F.lit(",")) & c.rlike(rf"^[A-Z][^.!?]{{0,60}},(?:[{SPACE}]*+\p{{Nd}}++[\-–—]?\p{{Nd}}*+,?)+[{SPACE}]*$")
    share = F.when(F.char_length(c) > 0, digit_count(c) / F.char_length(c)).otherwise(0.0)
    return number_only | dotted | entry | (share > JUNK_DIGIT_SHARE)


def is_matter(lines: Column) -> Column:
    """Front or back matter, told by how the first three lines of a page begin."""
    head = F.lower(strip(F.array_join(F.slice(lines, 1, 3), " ")))
    return F.exists(F.array(*map(F.lit, MATTER_TITLES)), lambda t: F.startswith(head, t))


def clean_paragraph(c: Column) -> Column:
    """One line, without footnote marks after letters or stops and without blanks before punctuation."""
    # The patterns of such marks and blanks.
    one = strip(F.regexp_replace(c, rf"{NO_LETTER}(?:[{SPACE}]{{2,}}|[{SPACE}&&[^ ]])", " "))
    unmarked = F.regexp_replace(one, rf"(?=\p{{Nd}})(?<=[a-z.,)])\p{{Nd}}{{1,3}}(?=[{SPACE}]|$)", "")
    return strip(F.regexp_replace(unmarked, rf"{NO_LETTER}[{SPACE}]++([,.;:!?])", "$1"))


def paragraphs(c: Column) -> Column:
    """Parts between blank lines, stripped, without empty ones."""
    parts = F.split(c, rf"\n[{SPACE}]*\n")
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def literal_paragraphs(c: Column) -> Column:
    """Parts between double line feeds, stripped, without empty ones."""
    return F.filter(F.transform(F.split(c, "\n\n"), strip), lambda p: p != "")


def is_numeral(token: Column) -> Column:
    """Digits, or a canonical roman numeral up to 3999."""
    return (token != "") & token.rlike(rf"^(?:[\p{{Nd}}²³¹⁰⁴-⁹]+|{ROMAN})$")


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """Every ``{{name}}`` replaced by its value, literally."""
    for name, value in values.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), value)
    return template


def carve_json(reply: Column) -> Column:
    """The JSON object in a model's reply: inside a code fence if there is one, from the first opening
    brace to the last closing one."""
    fenced = F.get(F.split(reply, "```"), F.lit(1))
    inner = F.when(F.contains(reply, F.lit("```")), F.when(F.startswith(fenced, F.lit("json")), F.substr(fenced, F.lit(5))).otherwise(fenced)).otherwise(reply)
    first = F.locate("{", inner)
    last = F.char_length(inner) - F.locate("}", F.reverse(inner)) + 1
    found = (first > 0) & F.contains(inner, F.lit("}"))
    return F.when(found, F.substr(inner, first, F.greatest(last - first + 1, F.lit(0)))).otherwise(inner)


def human_bytes(n: Column) -> Column:
    return F.when(n >= 1e9, F.format_string("%.2f GB", n / 1e9)).otherwise(F.format_string("%.0f MB", n / 1e6))


def pdf_link(html: Column, host: str) -> Column:
    """First link to a PDF on a host, decoded; null if there is none."""
    found = F.regexp_extract(html, "https://" + host.replace(".", r"\.") + r"/[^\"'\s>]+?\.pdf", 0)
    return F.nullif(F.url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))), F.lit(""))


def search_url(base: str, title: Column) -> Column:
    return F.concat(F.lit(base), F.replace(F.replace(F.url_encode(title), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=[^/.])\.[^./]*$", "")


def cleaned_name(name: Column) -> Column:
    return F.replace(name, F.lit(".txt"), F.lit("_clean.txt"))
