"""Queries over texts: cleaning, paragraphs, chapters, chunks and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import segment


def docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


# The tables hold few cases of most rules, so both engines derive harder inputs by the same expression.
HARD = "replace(replace(replace(text, chr(10), chr(10) || chr(10) || chr(10)), ' th', ' t-' || chr(10) || 'h'), ' in ', '  ' || chr(9) || 'in' || chr(10))"
CURLY = "replace(replace(replace(replace(text, ' the ', ' “the” '), ' of ', ' – '), ' a', '  ﬁa'), 'on ', 'on—')"
LOOSE = "replace(text, chr(10), chr(10) || '  ' || chr(10))"
CHUNK = "CASE WHEN doc_id % 7 = 0 THEN text || ' ISBN 123' WHEN doc_id % 11 = 3 THEN 'Contents ' || text WHEN doc_id % 13 = 5 THEN repeat('12 345 a ', 100) WHEN doc_id % 17 = 2 THEN 'Copyright ' || text WHEN doc_id % 19 = 4 THEN repeat('12 345 ', 90) WHEN doc_id % 23 = 6 THEN 'Economics in one lesson ' || text WHEN doc_id % 29 = 7 THEN '' ELSE text END"


def clean_text(spark, d):
    return docs(spark, d).select("doc_id", T.clean_text(F.expr(HARD)).alias("cleaned"))


def normalize_text(spark, d):
    return docs(spark, d).select("doc_id", T.normalize(F.expr(CURLY)).alias("plain"))


def split_paragraphs(spark, d):
    parts = docs(spark, d).select("doc_id", F.posexplode(T.paragraphs(F.expr(LOOSE))).alias("k", "paragraph"))
    return parts.select("doc_id", (F.col("k") + 1).cast("bigint").alias("para_no"), "paragraph")


def _lines(spark, d):
    return docs(spark, d).select("doc_id", "source", F.split("text", "\n").alias("p"))


def chunk_budget(spark, d):
    cut = segment.chunks(_lines(spark, d), "p", target=120, overlap=25)
    return cut.select("doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), F.md5(F.col("chunk").cast("binary")).alias("chunk_md5"), F.col("n_tokens").cast("bigint").alias("n_tokens"))


def chunk_stats(spark, d):
    """Flagship: clean, cut into paragraphs, chunk, filter, count by source."""
    clean = docs(spark, d).select("doc_id", "source", T.clean_text(F.expr(LOOSE)).alias("text")).select("doc_id", "source", T.paragraphs(F.col("text")).alias("p"))
    cut = segment.chunks(clean, "p").filter(T.is_valid_chunk(F.col("chunk")))
    return cut.groupBy("source").agg(F.count("*").alias("chunks"), F.sum("n_tokens").cast("bigint").alias("tokens"), F.countDistinct("doc_id").alias("documents"))


HEADED = "array_join(transform(split(text, chr(10)), (l, i) -> CASE WHEN i % 5 = 2 THEN concat('CHAPTER ', i, ' ', l) WHEN i % 7 = 3 THEN concat('Part ', array('I', 'IV', 'IX', 'XL', 'MCM')[i % 5], chr(10), l) WHEN i % 11 = 4 THEN concat('PART MIXED ', l) WHEN i % 13 = 5 THEN concat('CHAPTER 1. ', l) ELSE l END), chr(10))"


def detect_chapters(spark, d):
    found = docs(spark, d).select("doc_id", F.posexplode(segment.chapters(F.expr(HEADED))).alias("k", "c"))
    return found.select("doc_id", (F.col("k") + 1).cast("bigint").alias("chapter_no"), "c.title", "c.content")


def valid_chunk(spark, d):
    c = docs(spark, d).select("doc_id", F.expr(CHUNK).alias("c"))
    return c.select("doc_id", T.reject_reason(F.col("c")).alias("reason")).withColumn("valid", F.col("reason").isNull())


def reject_reason_counts(spark, d):
    return valid_chunk(spark, d).groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def text_counts(spark, d):
    c = docs(spark, d).select("doc_id", F.expr(CHUNK).alias("c"))
    return c.select("doc_id", T.word_count(F.col("c")).cast("bigint").alias("words"), T.letter_count(F.col("c")).cast("bigint").alias("letters"), T.digit_count(F.col("c")).cast("bigint").alias("digits"))


def overlap_suffix(spark, d):
    """The last lines of each document that fit into the overlap."""
    tokens = F.transform(F.filter("p", lambda x: T.strip(x) != ""), lambda x: T.word_count(x).cast("bigint"))
    cut = _lines(spark, d).select("doc_id", F.reverse(tokens).alias("t"))
    zero = F.struct(F.lit(0).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("n"), F.lit(False).alias("full"))
    step = lambda a, t: F.when(a["full"] | (a["n"] + t > 100), F.struct(a["k"].alias("k"), a["n"].alias("n"), F.lit(True).alias("full"))).otherwise(F.struct((a["k"] + 1).alias("k"), (a["n"] + t).alias("n"), F.lit(False).alias("full")))
    got = cut.select("doc_id", F.aggregate("t", zero, step).alias("s"))
    return got.select("doc_id", F.col("s.k").alias("paragraphs"), F.col("s.n").alias("tokens"))


def template_fill(spark, d):
    template = F.lit("Text: {{TEXT}} / again {{TEXT}} / by {{WHO}}")
    return docs(spark, d).select("doc_id", T.fill_template(template, {"TEXT": F.concat(F.lit("$1 "), F.col("text")), "WHO": F.col("source")}).alias("prompt"))


def file_names(spark, d):
    name = F.concat(F.lit("a/b.txt.d/"), F.col("source"), F.lit("."), F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs(spark, d).select("doc_id", T.stem(name).alias("stem"), T.cleaned_name(name).alias("cleaned"))


def corpus_totals(spark, d):
    return docs(spark, d).agg(F.count("*").alias("documents"), F.sum(F.char_length("text")).cast("bigint").alias("chars"), F.round(F.sum(F.char_length("text")) / 4, 2).alias("tokens"))


_WORDS = r"len(list_filter(string_split_regex(c, '\s+'), lambda x: x <> ''))"
_REASON = rf"""CASE WHEN c IS NULL OR c = '' THEN 'empty' WHEN {_WORDS} < 80 THEN 'short' WHEN contains(upper(c), 'CONTENTS') THEN 'contents' WHEN contains(upper(c), 'COPYRIGHT') THEN 'copyright'
  WHEN contains(upper(c), 'ISBN') THEN 'isbn' WHEN contains(upper(c), 'HARPER & BROTHERS') THEN 'harper & brothers' WHEN contains(upper(c), 'ECONOMICS IN ONE LESSON') AND {_WORDS} < 150 THEN 'title page'
  WHEN len(regexp_extract_all(c, '[A-Za-z]')) = 0 THEN 'no letters' WHEN len(regexp_extract_all(c, '\d')) > len(regexp_extract_all(c, '[A-Za-z]')) THEN 'numeric' END"""
WORDS_OF_X = r"len(list_filter(string_split_regex(x, '\s+'), lambda y: y <> ''))"
_CHUNKED = r"""
tok AS (SELECT doc_id, source, l, list_transform(l, lambda x: len(list_filter(string_split_regex(x, '\s+'), lambda y: y <> ''))) AS t FROM par WHERE len(l) > 0),
pre AS (SELECT doc_id, source, l, t, list_transform(range(0, len(t) + 1), lambda k: CAST(coalesce(list_sum(t[1:k]), 0) AS BIGINT)) AS s FROM tok),
rec AS (
  SELECT doc_id, 0 AS ix, 0 AS lo, CAST(NULL AS INTEGER) AS elo, CAST(NULL AS INTEGER) AS ehi FROM pre
  UNION ALL
  SELECT doc_id, ix + 1, CASE WHEN closes THEN list_filter(range(lo, ix + 1), lambda j: s[ix + 1] - s[j + 1] <= {overlap})[1] ELSE lo END,
    CASE WHEN closes THEN lo END, CASE WHEN closes THEN ix - 1 END
  FROM (SELECT r.doc_id, r.ix, r.lo, p.s, s[r.ix + 1] - s[r.lo + 1] + t[r.ix + 1] > {target} AND r.ix > r.lo AS closes, len(p.t) AS n FROM rec r JOIN pre p ON r.doc_id = p.doc_id WHERE r.ix < len(p.t))
),
ranges AS (
  SELECT doc_id, elo AS lo, ehi AS hi FROM rec WHERE elo IS NOT NULL
  UNION ALL SELECT r.doc_id, r.lo, r.ix - 1 FROM rec r JOIN pre p ON r.doc_id = p.doc_id WHERE r.ix = len(p.t)
),
chunked AS (
  SELECT p.doc_id, p.source, row_number() OVER (PARTITION BY p.doc_id ORDER BY r.lo, r.hi) AS chunk_no, array_to_string(p.l[r.lo + 1:r.hi + 1], chr(10) || chr(10)) AS c, p.s[r.hi + 2] - p.s[r.lo + 1] AS n_tokens
  FROM ranges r JOIN pre p ON r.doc_id = p.doc_id
)"""
_CLEAN = r"""
x1 AS (SELECT doc_id, source, regexp_replace(regexp_replace(t, '[ \t]+', ' ', 'g'), '([\p{L}\p{N}_])-\n([\p{L}\p{N}_])', '\1\2', 'g') AS t FROM x0),
x2 AS (SELECT doc_id, source, array_to_string(list_transform(regexp_extract_all(t, '\n+|[^\n]+'), lambda x: CASE WHEN x = chr(10) THEN ' ' ELSE x END), '') AS t FROM x1),
x3 AS (SELECT doc_id, source, regexp_replace(regexp_replace(t, '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM x2)"""

ORACLES = {
    "clean_text": f"WITH x0 AS (SELECT doc_id, source, {HARD} AS t FROM documents), {_CLEAN} SELECT doc_id, t AS cleaned FROM x3",
    "normalize_text": f"SELECT doc_id, regexp_replace(replace(replace(replace(replace(replace({CURLY}, '“', chr(34)), '”', chr(34)), '–', '-'), '—', '--'), 'ﬁ', 'fi'), '[ \\t]+', ' ', 'g') AS plain FROM documents",
    "split_paragraphs": rf"WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex({LOOSE}, '\n\s*\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM documents) SELECT doc_id, unnest(range(1, len(l) + 1)) AS para_no, unnest(l) AS paragraph FROM s",
    "chunk_budget": "WITH RECURSIVE par AS (SELECT doc_id, source, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents), " + _CHUNKED.format(target=120, overlap=25) + " SELECT doc_id, chunk_no, md5(c) AS chunk_md5, n_tokens FROM chunked",
    "chunk_stats": f"WITH RECURSIVE x0 AS (SELECT doc_id, source, {LOOSE} AS t FROM documents), {_CLEAN}, "
    + r"par AS (SELECT doc_id, source, list_filter(list_transform(string_split_regex(t, '\n\s*\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM x3), "
    + _CHUNKED.format(target=800, overlap=100)
    + f" SELECT source, count(*) AS chunks, CAST(sum(n_tokens) AS BIGINT) AS tokens, count(DISTINCT doc_id) AS documents FROM chunked WHERE ({_REASON}) IS NULL GROUP BY source",
    "detect_chapters": r"""WITH l0 AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents),
l1 AS (SELECT doc_id, i, CASE WHEN i % 5 = 2 THEN concat('CHAPTER ', i, ' ', l) WHEN i % 7 = 3 THEN concat('Part ', (['I', 'IV', 'IX', 'XL', 'MCM'])[(i % 5) + 1], chr(10), l) WHEN i % 11 = 4 THEN concat('PART MIXED ', l) WHEN i % 13 = 5 THEN concat('CHAPTER 1. ', l) ELSE l END AS l FROM l0),
l2 AS (SELECT doc_id, i, l, (i % 5 = 2 OR i % 7 = 3) AS h FROM l1),
l3 AS (SELECT doc_id, i, l, CAST(sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS g, max(h) OVER (PARTITION BY doc_id) AS headed FROM l2),
c AS (SELECT doc_id, g, headed, string_agg(l, chr(10) ORDER BY i) AS t FROM l3 GROUP BY doc_id, g, headed)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY g) AS chapter_no, CASE WHEN NOT headed THEN 'Full Text' WHEN g = 0 THEN 'Preamble' ELSE regexp_replace(string_split(t, chr(10))[1], '^\s+|\s+$', '', 'g') END AS title,
  CASE WHEN headed THEN regexp_replace(t, '^\s+|\s+$', '', 'g') ELSE t END AS content
FROM c WHERE NOT headed OR g > 0 OR regexp_replace(t, '^\s+|\s+$', '', 'g') <> ''""",
    "valid_chunk": f"WITH s AS (SELECT doc_id, {CHUNK} AS c FROM documents) SELECT doc_id, {_REASON} AS reason, ({_REASON}) IS NULL AS valid FROM s",
    "reject_reason_counts": f"WITH s AS (SELECT doc_id, {CHUNK} AS c FROM documents) SELECT coalesce({_REASON}, 'kept') AS reason, count(*) AS n FROM s GROUP BY 1",
    "text_counts": rf"WITH s AS (SELECT doc_id, {CHUNK} AS c FROM documents) SELECT doc_id, {_WORDS} AS words, len(regexp_extract_all(c, '[A-Za-z]')) AS letters, len(regexp_extract_all(c, '\d')) AS digits FROM s",
    "overlap_suffix": r"""WITH l AS (SELECT doc_id, list_reverse(list_transform(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''), lambda x: len(list_filter(string_split_regex(x, '\s+'), lambda y: y <> '')))) AS t FROM documents),
k AS (SELECT doc_id, t, len(list_filter(range(1, len(t) + 1), lambda k: list_sum(t[1:k]) <= 100)) AS k FROM l) SELECT doc_id, k AS paragraphs, CAST(coalesce(list_sum(t[1:k]), 0) AS BIGINT) AS tokens FROM k""",
    "template_fill": "SELECT doc_id, 'Text: $1 ' || text || ' / again $1 ' || text || ' / by ' || source AS prompt FROM documents",
    "file_names": "SELECT doc_id, 'a/b.txt.d/' || source || '.' || doc_id AS stem, 'a/b_clean.txt.d/' || source || '.' || doc_id || '_clean.txt' AS cleaned FROM documents",
    "corpus_totals": "SELECT count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS chars, round(sum(length(text)) / 4, 2) AS tokens FROM documents",
}
QUERIES = {name: globals()[name] for name in ORACLES}
