"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Each benchmark item gives windows of ``window`` words (one shorter window if it has fewer words, none
if it has no word).  The words of a window are ordered by their count in the corpus; a window can
only be where its rarest word is, so this word is the prefix that is joined.  A match must then fit
by position (the window has to lie within the document) and is verified word by word.

The windows are joined as a broadcast table only up to ``BROADCAST_BYTES``; more windows are joined
in several parts of that size, each in a pass of its own.  A document's words are exploded and joined
within one stage and only verified windows leave it, so no document is shuffled and a frequent
passage or word costs no task more than its own documents.

Null and empty texts have no words.  Items without words never occur.  A null item_id counts as an
item named by the empty string.  Rows are judged one by one, so repeated rows and ids stay; of equally
rare words of a window the first by name, then by place, is its prefix.  Empty tables give empty ones and
no hits.  The words of a very long text are one array in one task.  Columns other than ``doc_id, text,
item_id`` pass unread, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import packed_row, written

WINDOW = 10
BROADCAST_BYTES = 48 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed by the contract: what lies between words
_EVERY = "\u0000"  # no word; joined once for every document, so that each one leaves a row


def ascii_lower(col: Column) -> Column:
    """Lower-case A to Z alone."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def words(col: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(col, F.lit(""))), BREAKS), "")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows: ``words`` and the sorted ids (as strings) of the ``items`` that have them."""
    cut = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = cut.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("words"))
    return each.groupBy("words").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select(words(F.col("text")).alias("w"))


def prefixes(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` with their rarest word and its offset; windows with an unseen word are left out."""
    parts = windows.select("words", "items", F.posexplode("words").alias("offset", "word"))
    known = parts.select("word").distinct()
    seen = _tokens(docs).select(F.explode("w").alias("word"))
    size = known.agg(F.sum(F.octet_length("word") + 40)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        counts = seen.join(F.broadcast(known), "word").groupBy("word").agg(F.count("*").alias("n"))
    else:
        counts = seen.groupBy("word").agg(F.count("*").alias("n")).join(known, "word", "left_semi")
    ranked = parts.join(counts, "word", "left")
    rarest = ranked.groupBy("words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "offset")).alias("p"), F.first("items").alias("items"))
    return rarest.filter("p.n > 0").select("words", "items", F.col("p.word").alias("word"), F.col("p.offset").alias("offset"))


def window_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``row`` (a number of the row), ``n_words`` and the other columns of ``docs``, with one row per
    verified ``start, length, items``, and one with null start for every document."""
    table = written(prefixes(docs, item_windows(items, window)), "prefixes")
    size = table.agg(F.sum(F.aggregate("words", F.lit(0), lambda a, w: a + F.octet_length(w) + 16) + F.aggregate("items", F.lit(0), lambda a, w: a + F.octet_length(w) + 16) + 80)).first()[0] or 0
    passes = max(1, -(-int(size) // BROADCAST_BYTES))
    base = docs.withColumns({"row": F.monotonically_increasing_id(), "__w": words(F.col("text"))})
    base = base.withColumns({"n_words": F.size("__w").cast("long"), "__e": F.concat(F.array(F.lit(_EVERY)), "__w")}).drop("text")
    keep = [c for c in base.columns if c not in ("__w", "__e")]
    every = docs.sparkSession.range(1).select(F.array().cast("array<string>").alias("words"), F.array().cast("array<string>").alias("items"), F.lit(_EVERY).alias("word"), F.lit(0).alias("offset"))
    out = []
    for k in range(passes):
        part = table.filter(F.pmod(F.xxhash64("words"), F.lit(passes)) == k)
        part = (part.unionByName(every) if k == 0 else part).select(F.col("words").alias("__words"), F.col("items").alias("__items"), F.col("word").alias("__word"), F.col("offset").alias("__offset"))
        tokens = base.select(*keep, "__w", F.posexplode("__e").alias("__pos", "__token"))
        start = F.col("__pos") - F.col("__offset")  # one-based: position 0 is the mark of every document
        fits = (start >= 1) & (start + F.size("__words") - 1 <= F.col("n_words"))
        same = F.when(F.col("__token") == _EVERY, F.lit(True)).when(fits, F.slice("__w", F.when(fits, start).otherwise(1), F.size("__words")) == F.col("__words")).otherwise(False)
        hit = tokens.join(F.broadcast(part), F.col("__token") == F.col("__word")).filter(same)
        out.append(hit.select(*keep, F.when(F.col("__token") != _EVERY, start - 1).alias("start"), F.size("__words").alias("length"), F.col("__items").alias("items")))
    return reduce(DataFrame.unionByName, out)


def _covered(spans: Column) -> Column:
    """Number of positions in the union of sorted (start, end) spans."""
    first = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))
    step = lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("n"), F.greatest(a["reach"], s["end"]).alias("reach"))
    return F.aggregate(spans, first, step, lambda a: a["n"].cast("long"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document, and
    ``items``, the ids (as strings) whose windows occur in it."""
    hits = window_hits(docs.select("doc_id", "text"), items.select("item_id", "text"), window)
    spans = F.sort_array(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end")))))
    per = hits.groupBy("row", "doc_id", "n_words").agg(spans.alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return per.select(
        "doc_id",
        "n_words",
        _covered(F.col("s")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("s") > 0).alias("contaminated"),
        "items",
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all columns."""
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    hit = window_hits(named, items.select("item_id", "text"), window).filter("start is not null").select(F.col("doc_id").alias("hit_id"), F.col("h").alias("hit_h")).distinct()
    rows = docs.select(packed_row(docs).alias("row"), F.col("doc_id"), F.xxhash64("text").alias("h"))
    return rows.join(hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("h") == F.col("hit_h")), "left_anti").select("row.*")


# Fixed values of the contract in SQL; windows of documents are made for each length that items have.
ORACLE = r"""
WITH item_words AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10 + 1, 1) + 1)) AS s FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), doc_windows AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), found AS (
  SELECT d.doc_id, d.s, d.n, i.item_id FROM doc_windows d JOIN item_windows i ON d.win = i.win AND d.n = i.n
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items, list(item ORDER BY item) AS item_list FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(k.n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(k.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named k ON d.doc_id = k.doc_id
"""
