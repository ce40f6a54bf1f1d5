"""Queries over page layout, on spans derived from the lines of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import layout as L

_TEXT = "CASE WHEN i % 13 = 3 THEN '12.5, 88' WHEN i % 17 = 5 THEN l || ' ......... 47' WHEN i % 70 = 20 THEN 'Contents ' || l WHEN i % 29 = 8 THEN 'Capital, 44, 88, 132-140' WHEN i % 10 = 7 THEN l || '-' WHEN i % 15 = 1 THEN l || ' said.12 so , we' ELSE l END"


def spans(spark, d):
    lines = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "l"))
    return lines.select(
        F.col("doc_id").alias("doc"), F.expr("cast(i div 10 as int)").alias("page"), F.expr("cast((i % 10) div 5 as int)").alias("block"), (F.col("i") % 5).alias("line"), F.lit(0).alias("span"),
        F.when(F.col("i") % 9 == 0, 8.0).otherwise(10.7).alias("size"), F.when(F.col("i") % 6 == 0, 84.5).otherwise(72.0).alias("x0"), F.expr(_TEXT).alias("text"),
    )


def _big(df):
    return df.select(*[F.col(c).cast("bigint") if t == "int" else F.col(c) for c, t in df.dtypes])


def body_font(spark, d):
    return L.body_font(spans(spark, d))


def page_sampling(spark, d):
    pages = spans(spark, d).groupBy("doc").agg((F.max("page") + 1).cast("bigint").alias("pages"))
    step = F.greatest(F.lit(1), F.floor(F.col("pages") / 3))
    return pages.select("doc", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pages") - 1)).alias("page"), step.alias("step")).filter(F.pmod("page", "step") == 0).select("doc", "page")


def _sampled_lines(spark, d):
    """Lines by the body font of sampled pages, as the reference takes it."""
    return L.body_lines(spans(spark, d), L.SAMPLE_PAGES)


def body_lines(spark, d):
    return _big(_sampled_lines(spark, d))


def titled_documents(spark, d):
    """Documents that begin with one of many titles: the first two words of every long one."""
    docs = spark.read.parquet(f"{d}/documents.parquet")
    titles = docs.filter("n_chars > 500").select(F.lower(F.substring_index("text", " ", 2)).alias("title"))
    return L.titled(docs.select("doc_id", F.lower("text").alias("head")), "head", titles, "title").select("doc_id")


def junk_lines(spark, d):
    lines = spans(spark, d)
    return _big(lines.select("doc", "page", "block", "line", T.is_junk_line(F.col("text")).alias("junk")))


def page_filter(spark, d):
    return _big(L.judged_pages(_sampled_lines(spark, d)))


def page_margin(spark, d):
    return _big(L.page_margin(L.kept_lines(L.body_lines(spans(spark, d)))))


def typical_length(spark, d):
    return _big(L.typical_length(L.kept_lines(_sampled_lines(spark, d))))


def indent_rate(spark, d):
    return L.indent_rate(L.kept_lines(_sampled_lines(spark, d)))


def reflow(spark, d):
    return _big(L.reflow(L.kept_lines(_sampled_lines(spark, d))))


def prose(spark, d):
    return _big(L.prose(L.kept_lines(L.body_lines(spans(spark, d)))))


def book_stats(spark, d):
    return L.book_stats(spans(spark, d))


def _junk(c):
    return rf"(regexp_matches({c}, '^[\divxlcDIVXLC.\-–—\s]+$') OR contains({c}, '....') OR regexp_matches({c}, '^[A-Z][^.!?]{{0,60}},(\s*\d+[\-–—]?\d*,?)+\s*$') OR (length({c}) > 0 AND len(regexp_extract_all({c}, '\d')) / length({c}) > 0.28))"


_MATTER = "(" + " OR ".join(f"starts_with(head, '{t}')" for t in T.MATTER_TITLES) + ")"
_SPANS = f"""l0 AS (SELECT doc_id AS doc, unnest(string_split(text, chr(10))) AS l, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents),
spans AS (SELECT doc, i // 10 AS page, (i % 10) // 5 AS block, i % 5 AS line, CASE WHEN i % 9 = 0 THEN 8.0::DOUBLE ELSE 10.7::DOUBLE END AS size, CASE WHEN i % 6 = 0 THEN 84.5::DOUBLE ELSE 72.0::DOUBLE END AS x0, {_TEXT} AS text FROM l0)"""
_FONT = r""", pg AS (SELECT doc, max(page) + 1 AS pages FROM spans GROUP BY doc),
fw AS (SELECT s.doc, size, sum(length(regexp_replace(text, '^\s+|\s+$', '', 'g'))) AS w, min(page * 10 + block * 5 + line) AS f FROM spans s JOIN pg ON s.doc = pg.doc WHERE page % greatest(1, pages // 60) = 0 AND trim(text) <> '' GROUP BY s.doc, size),
font AS (SELECT doc, size AS body_font FROM fw QUALIFY row_number() OVER (PARTITION BY doc ORDER BY w DESC, f) = 1)"""
_LINES = r""", bl AS (SELECT s.doc, page, row_number() OVER (PARTITION BY s.doc, page ORDER BY block, line) - 1 AS line_no, regexp_replace(regexp_replace(text, '[ \t]+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS text, x0
  FROM spans s JOIN font f ON s.doc = f.doc WHERE abs(size - body_font) <= 1.0 AND trim(text) <> '')"""
_PAGES = f""", hd AS (SELECT doc, page, count(*) AS lines, count(*) FILTER ({_junk("text")}) AS junk, lower(string_agg(CASE WHEN line_no < 3 THEN text END, ' ' ORDER BY line_no)) AS head FROM bl GROUP BY doc, page),
jp AS (SELECT doc, page, lines, junk, CASE WHEN {_MATTER} THEN 'matter' WHEN junk / lines > 0.34 THEN 'junk' END AS drop_reason FROM hd)"""
_KEPT = f""", kl AS (SELECT bl.* FROM bl JOIN jp ON bl.doc = jp.doc AND bl.page = jp.page WHERE drop_reason IS NULL AND NOT {_junk("text")})"""
_MARGIN = """, xs AS (SELECT doc, page, x0, count(*) AS n, sum(count(*)) OVER (PARTITION BY doc, page) AS total FROM kl GROUP BY doc, page, x0),
mg AS (SELECT doc, page, coalesce(min(CASE WHEN n >= greatest(2, total * 0.2) THEN x0 END), min(x0)) AS margin FROM xs GROUP BY doc, page)"""
_TYPICAL = """, ty AS (SELECT doc, list_sort(list(length(text)))[CAST(floor(count(*) * 0.75) AS BIGINT) + 1] AS typical FROM kl GROUP BY doc)"""
_REL = """, r0 AS (SELECT kl.*, round(x0 - margin, 1) AS rel FROM kl JOIN mg ON kl.doc = mg.doc AND kl.page = mg.page),
r1 AS (SELECT *, coalesce(abs(rel - lag(rel) OVER (PARTITION BY doc ORDER BY page, line_no)) > 4.0, false) AS indented FROM r0),
ir AS (SELECT doc, round(count(*) FILTER (indented) / greatest(count(*), 1), 3) AS indent_rate FROM r1 GROUP BY doc)"""
_FLOW = r""", f0 AS (SELECT r1.*, typical, lag(text) OVER w AS before, lag(indented) OVER w AS b_ind, lead(text) OVER w AS after FROM r1 JOIN ty ON r1.doc = ty.doc WINDOW w AS (PARTITION BY r1.doc ORDER BY page, line_no)),
f1 AS (SELECT *, before IS NULL OR (indented AND regexp_matches(before, '[.!?]["'')\]]?$')) OR (NOT b_ind AND regexp_matches(before, '[.!?]["'')]?$') AND length(before) < typical * 0.72) AS opens FROM f0),
f2 AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY doc ORDER BY page, line_no) AS para_no FROM f1),
f3 AS (SELECT *, lead(para_no) OVER (PARTITION BY doc ORDER BY page, line_no) = para_no AS goes_on FROM f2),
fl AS (SELECT doc, CAST(para_no AS BIGINT) AS para_no, string_agg(CASE WHEN coalesce(goes_on, false) AND ends_with(text, '-') AND NOT ends_with(text, '--') THEN left(text, length(text) - 1) WHEN coalesce(goes_on, false) THEN text || ' ' ELSE text END, '' ORDER BY page, line_no) AS text FROM f3 GROUP BY doc, para_no)"""
_PROSE = r""", p0 AS (SELECT doc, para_no, regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS text FROM fl),
p1 AS (SELECT doc, para_no, regexp_replace(regexp_replace(text, '([a-z.,)])\d{1,3}(\s|$)', '\1\2', 'g'), '\s+([,.;:!?])', '\1', 'g') AS text FROM p0),
pr AS (SELECT doc, para_no, trim(text) AS text FROM p1 WHERE length(trim(text)) >= 120 AND regexp_matches(text, '[a-z]{3}'))"""
_ALL = _SPANS + _FONT + _LINES + _PAGES + _KEPT
_EVERY_PAGE = _SPANS + _FONT.replace("page % greatest(1, pages // 60) = 0 AND ", "") + _LINES + _PAGES + _KEPT

ORACLES = {
    "body_font": f"WITH {_SPANS}{_FONT} SELECT doc, body_font FROM font",
    "page_sampling": "WITH pg AS (SELECT doc_id AS doc, (len(string_split(text, chr(10))) - 1) // 10 + 1 AS pages FROM documents), p AS (SELECT doc, pages, unnest(range(0, pages)) AS page FROM pg) SELECT doc, page FROM p WHERE page % greatest(1, pages // 3) = 0",
    "body_lines": f"WITH {_SPANS}{_FONT}{_LINES} SELECT doc, page, line_no, text, x0 FROM bl",
    "titled_documents": "WITH t AS (SELECT DISTINCT lower(array_to_string(string_split(text, ' ')[1:2], ' ')) AS title FROM documents WHERE n_chars > 500) SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM t WHERE title <> '' AND starts_with(lower(text), title))",
    "junk_lines": f"WITH {_SPANS} SELECT doc, page, block, line, {_junk('text')} AS junk FROM spans",
    "page_filter": f"WITH {_SPANS}{_FONT}{_LINES}{_PAGES} SELECT doc, page, lines, junk, drop_reason FROM jp",
    "page_margin": f"WITH {_EVERY_PAGE}{_MARGIN} SELECT doc, page, margin FROM mg",
    "typical_length": f"WITH {_ALL}{_TYPICAL} SELECT doc, typical FROM ty",
    "indent_rate": f"WITH {_ALL}{_MARGIN}{_REL} SELECT doc, indent_rate FROM ir",
    "reflow": f"WITH {_ALL}{_MARGIN}{_TYPICAL}{_REL}{_FLOW} SELECT doc, para_no, text FROM fl",
    "prose": f"WITH {_EVERY_PAGE}{_MARGIN}{_TYPICAL}{_REL}{_FLOW}{_PROSE} SELECT doc, para_no, text FROM pr",
    "book_stats": f"""WITH {_EVERY_PAGE}{_MARGIN}{_TYPICAL}{_REL}{_FLOW}{_PROSE}, k AS (SELECT doc, count(*) FILTER (drop_reason IS NULL) AS kept FROM jp GROUP BY doc), t AS (SELECT doc, count(*) AS paragraphs, sum(length(text)) AS chars FROM pr GROUP BY doc)
SELECT pg.doc, pages, body_font, coalesce(kept, 0) AS pages_kept, pages - coalesce(kept, 0) AS pages_dropped, coalesce(paragraphs, 0) AS paragraphs, CAST(coalesce(chars, 0) AS BIGINT) AS chars, CASE WHEN body_font IS NOT NULL THEN coalesce(indent_rate, 0.0) END AS indent_rate
FROM pg LEFT JOIN font ON pg.doc = font.doc LEFT JOIN k ON pg.doc = k.doc LEFT JOIN t ON pg.doc = t.doc LEFT JOIN ir ON pg.doc = ir.doc""",
}
QUERIES = {name: globals()[name] for name in ORACLES}
