"""Body text from page layout: ``layout_span(doc, page, block, line, span, size, x0, text)``.

Spans are dealt by ``doc`` once; what follows are windows and aggregations whose keys begin with ``doc``,
so no step exchanges rows again.  ``by`` names further columns that set rows apart, so that one pass can
hold lines of several kinds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.ranges import stored

# Layout thresholds.
SIZE_TOLERANCE = 1.0
JUNK_PAGE_RATIO = 0.34
MIN_PARAGRAPH_CHARS = 120
INDENT_MIN = 4.0
SHORT_LINE_SHARE = 0.72
SAMPLE_PAGES = 60


def body_font(spans: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``doc, body_font``: the size with most characters on evenly sampled pages, the first met on ties."""
    pages = spans.groupBy("doc").agg((F.max("page") + 1).alias("pages"))
    step = F.greatest(F.lit(1), F.floor(F.col("pages") / sample_pages))
    seen = spans.join(pages, "doc").filter((F.pmod(F.col("page"), step) == 0) & (T.strip(F.col("text")) != ""))
    place = F.struct("page", "block", "line", "span")
    weights = seen.groupBy("doc", F.round("size", 1).alias("size")).agg(F.sum(F.char_length(T.strip(F.col("text")))).alias("w"), F.min(place).alias("first"))
    return weights.groupBy("doc").agg(F.min_by("size", F.struct((-F.col("w")).alias("w"), "first")).alias("body_font"))


def book_lines(spans: DataFrame, sample_pages: int | None = None) -> DataFrame:
    """All lines with the ``pages`` and ``body_font`` of their document: ``is_line`` tells those with text
    of body size, which have a ``line_no`` in reading order, ``text`` and ``x0``.  The body font is that of
    all pages, or of evenly sampled ones if ``sample_pages`` is given."""
    doc = Window.partitionBy("doc")
    size = spans.repartition("doc").withColumns({"size1": F.round("size", 1), "n": F.char_length(T.strip(F.col("text"))), "pages": F.max("page").over(doc) + 1})
    step = F.lit(1) if sample_pages is None else F.greatest(F.lit(1), F.floor(F.col("pages") / sample_pages))
    sampled = (F.pmod(F.col("page"), step) == 0) & (F.col("n") > 0)
    alike, place = Window.partitionBy("doc", "size1"), F.struct("page", "block", "line", "span")
    weighed = size.withColumns({"w": F.sum(F.when(sampled, F.col("n"))).over(alike), "first": F.min(F.when(sampled, place)).over(alike)})
    rank = F.when(F.col("w").isNotNull(), F.struct((-F.col("w")).alias("w"), "first"))
    near = F.abs(F.col("size") - F.col("body_font")) <= SIZE_TOLERANCE
    fonts = weighed.withColumn("body_font", F.min_by("size1", rank).over(doc)).withColumn("near", F.coalesce(near, F.lit(False)))
    parts = F.array_sort(F.collect_list(F.when(F.col("near"), F.struct("span", "text"))))
    joined = fonts.groupBy("doc", "page", "block", "line").agg(F.first("pages").alias("pages"), F.first("body_font").alias("body_font"), F.array_join(F.transform(parts, lambda s: s["text"]), "").alias("text"), F.min(F.when(F.col("near"), F.col("x0"))).alias("x0"))
    clean = joined.withColumns({"text": T.strip(T.normalize(F.col("text"))), "x0": F.round("x0", 1)}).withColumn("is_line", F.col("text") != "")
    order = Window.partitionBy("doc", "page", "is_line").orderBy("block", "line")
    return clean.withColumn("line_no", F.when(F.col("is_line"), F.row_number().over(order) - 1))


def body_lines(spans: DataFrame, sample_pages: int | None = None) -> DataFrame:
    """``doc, page, line_no, text, x0``: lines of body-sized spans, in reading order."""
    return book_lines(spans, sample_pages).filter("is_line").select("doc", "page", "line_no", "text", "x0")


def judged_lines(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Lines with ``is_junk`` and, of their page, ``lines``, ``junk`` and ``drop_reason``."""
    page = Window.partitionBy("doc", "page", *by)
    marked = lines.withColumn("is_junk", T.is_junk_line(F.col("text")))
    head = F.array_compact(F.array(*[F.max(F.when(F.col("line_no") == k, F.col("text"))).over(page) for k in range(3)]))
    counted = marked.withColumns({"lines": F.count("*").over(page), "junk": F.sum(F.col("is_junk").cast("bigint")).over(page), "__head": head})
    reason = F.when(T.is_matter(F.col("__head")), "matter").when(F.col("junk") / F.col("lines") > JUNK_PAGE_RATIO, "junk")
    return counted.withColumn("drop_reason", reason).drop("__head")


def titled(heads: DataFrame, head: str, titles: DataFrame, title: str) -> DataFrame:
    """``heads`` that begin with one of many titles.  What is compared are the distinct beginnings of heads,
    as long as the longest title: each is cut to every length that a title has, and one of the cuts must be
    a title.  So no row moves more than its beginning; titles are stored first, and while they are few Spark
    sends them to the beginnings."""
    known = stored(titles.select(F.col(title).alias("__title")).filter(F.char_length("__title") > 0).distinct(), "titles")
    lengths = sorted(r[0] for r in known.select(F.char_length("__title")).distinct().collect())
    if not lengths:
        return heads.limit(0)
    begin = F.substr(F.col(head), F.lit(1), F.lit(lengths[-1]))
    cuts = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.char_length("__begin")), lambda n: F.substr(F.col("__begin"), F.lit(1), n))
    each = heads.select(begin.alias("__begin")).distinct().select("__begin", F.explode(cuts).alias("__title"))
    found = each.join(known, "__title", "left_semi").select("__begin").distinct()
    return heads.withColumn("__begin", begin).join(found, "__begin", "left_semi").drop("__begin")


def judged_pages(lines: DataFrame) -> DataFrame:
    """``doc, page, lines, junk, drop_reason`` (null: the page stays)."""
    return judged_lines(lines).filter("line_no = 0").select("doc", "page", "lines", "junk", "drop_reason")


def kept_lines(lines: DataFrame) -> DataFrame:
    """Lines that are no junk, of pages that stay."""
    return judged_lines(lines).filter("drop_reason is null and not is_junk").select(*lines.columns)


def with_margin(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Lines with ``margin``, the leftmost start that a fifth of their page's lines (at least two) share."""
    page = Window.partitionBy("doc", "page", *by)
    counted = lines.withColumns({"__n": F.count("*").over(Window.partitionBy("doc", "page", *by, "x0")), "__all": F.count("*").over(page)})
    common = F.when(F.col("__n") >= F.greatest(F.lit(2.0), F.col("__all") * 0.2), F.col("x0"))
    return counted.withColumn("margin", F.coalesce(F.min(common).over(page), F.min("x0").over(page))).drop("__n", "__all")


def page_margin(lines: DataFrame) -> DataFrame:
    """``doc, page, margin``."""
    return with_margin(lines).groupBy("doc", "page").agg(F.min("margin").alias("margin"))


def with_typical(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Lines with ``typical``, the length at three quarters of their document's sorted lengths."""
    doc, size = Window.partitionBy("doc", *by), F.char_length("text")
    ranked = lines.withColumns({"__k": F.row_number().over(doc.orderBy(size)) - 1, "__n": F.count("*").over(doc)})
    return ranked.withColumn("typical", F.max(F.when(F.col("__k") == F.floor(F.col("__n") * 0.75), size)).over(doc)).drop("__k", "__n")


def typical_length(lines: DataFrame) -> DataFrame:
    """``doc, typical``, from the counts of the lengths of each document: no lines are sorted or gathered."""
    counts = lines.groupBy("doc", F.char_length("text").alias("size")).agg(F.count("*").alias("n"))
    up = Window.partitionBy("doc").orderBy("size")
    reached = counts.withColumns({"upto": F.sum("n").over(up), "all": F.sum("n").over(Window.partitionBy("doc"))})
    return reached.filter(F.col("upto") > F.floor(F.col("all") * 0.75)).groupBy("doc").agg(F.min("size").alias("typical"))


def relative_lines(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Lines with ``rel``, their start right of the page's margin, and ``indented``, whether it changes."""
    placed = with_margin(lines, by).withColumn("rel", F.round(F.col("x0") - F.col("margin"), 1))
    before = F.lag("rel").over(Window.partitionBy("doc", *by).orderBy("page", "line_no"))
    return placed.withColumn("indented", F.coalesce(F.abs(F.col("rel") - before) > INDENT_MIN, F.lit(False)))


def indent_rate(lines: DataFrame) -> DataFrame:
    return relative_lines(lines).groupBy("doc").agg(F.round(F.count_if("indented") / F.greatest(F.count("*"), F.lit(1)), 3).alias("indent_rate"))


def _glue(parts: Column) -> Column:
    """Lines to one text: a blank between them, none (and no hyphen) after a single hyphen."""

    def add(a: Column, x: Column) -> Column:
        hyphen = F.endswith(a, F.lit("-")) & ~F.endswith(a, F.lit("--"))
        return F.when(a == "", x).when(hyphen, F.concat(F.substr(a, F.lit(1), F.char_length(a) - 1), x)).otherwise(F.concat(a, F.lit(" "), x))

    return F.aggregate(parts, F.lit(""), add)


def numbered_lines(lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Lines with ``para_no``, the paragraph that they belong to across pages.

    A line opens a paragraph if its indent changes after the end of a sentence, or if the line before
    it ended a sentence well short of the measure without an indent change.
    """
    order = Window.partitionBy("doc", *by).orderBy("page", "line_no")
    placed = with_typical(relative_lines(lines, by), by)
    before, indented = F.lag("text").over(order), F.lag("indented").over(order)
    closed = ~indented & before.rlike("[.!?][\"')]?$") & (F.char_length(before) < F.col("typical") * SHORT_LINE_SHARE)
    opens = before.isNull() | (F.col("indented") & before.rlike("[.!?][\"')\\]]?$")) | closed
    marked = placed.withColumn("opens", F.coalesce(opens, F.lit(False)).cast("int"))
    return marked.withColumn("para_no", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))


def _paragraph() -> Column:
    return _glue(F.transform(F.array_sort(F.collect_list(F.struct("page", "line_no", "text"))), lambda s: s["text"]))


def reflow(lines: DataFrame) -> DataFrame:
    """``doc, para_no, text``: lines joined to paragraphs."""
    return numbered_lines(lines).groupBy("doc", "para_no").agg(_paragraph().alias("text"))


def is_prose(text: Column) -> Column:
    return (F.char_length(text) >= MIN_PARAGRAPH_CHARS) & text.rlike("[a-z]{3}")


def prose(lines: DataFrame) -> DataFrame:
    """``doc, para_no, text``: cleaned paragraphs that are long enough and hold words."""
    return reflow(lines).withColumn("text", T.clean_paragraph(F.col("text"))).filter(is_prose(F.col("text")))


def book_stats(spans: DataFrame) -> DataFrame:
    """One row for each document: pages, kept and dropped ones, body font, paragraphs, characters and
    indent rate (null where the document has no body font).  One pass holds kept lines, other ones and
    what is no line, each apart."""
    judged = judged_lines(book_lines(spans), ("is_line",))
    kept = F.col("is_line") & F.col("drop_reason").isNull() & ~F.col("is_junk")
    marked = numbered_lines(judged.withColumn("kept", kept), ("kept",))
    page = F.col("is_line") & (F.col("line_no") == 0) & F.col("drop_reason").isNull()
    parts = marked.groupBy("doc", "kept", "para_no").agg(F.first("pages").alias("pages"), F.first("body_font").alias("body_font"), F.count_if(page).alias("pages_kept"), F.count_if("indented").alias("indented"), F.count("*").alias("lines"), _paragraph().alias("text"))
    clean = parts.withColumn("text", F.when(F.col("kept"), T.clean_paragraph(F.col("text")))).withColumn("chars", F.when(is_prose(F.col("text")), F.char_length("text")))
    own = lambda c: F.sum(F.when(F.col("kept"), F.col(c)).otherwise(0))
    rate = F.when(F.first("body_font").isNotNull(), F.round(own("indented") / F.greatest(own("lines"), F.lit(1)), 3))
    big = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    per = clean.groupBy("doc").agg(F.first("pages").cast("bigint").alias("pages"), F.first("body_font").alias("body_font"), big(F.sum("pages_kept")).alias("pages_kept"), big(F.count("chars")).alias("paragraphs"), big(F.sum("chars")).alias("chars"), rate.alias("indent_rate"))
    return per.select("doc", "pages", "body_font", "pages_kept", (F.col("pages") - F.col("pages_kept")).alias("pages_dropped"), "paragraphs", "chars", "indent_rate")
