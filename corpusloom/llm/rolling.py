"""Features of sliding windows, with exact ranks, by merge-sort trees over time.

A row's window of width W holds all rows of its key with a time from ``at - W`` up to, without, ``at``.

1. Rows are summed up by key, time, value and category before anything else moves, so repeated values
   of one moment are one entry with a weight, and rows of one key and time share one answer.
2. Time is cut into slabs of ``slab`` steps.  Entries go to their own slab and to the following ones in
   whose windows they may lie, so no key is held as a whole and a hot key is spread over its slabs.
3. Of each slab a merge-sort tree is built: a node covers a power of two of consecutive steps and holds
   its entries ordered by value.  For fractional cascading an array tells, for each place of a node, how
   many of the entries before it lie in the left child; the place in both children follows from it, so a
   value's place is known in all nodes on the way down from its place in the root.
4. The entries below a value in a window are those before its end less those before its start; both are
   sums over the nodes left of the way down.  The value of a rank is found by binary search over the
   root's order, with all windows of a block of slabs in step.
5. Distinct categories come from the last place before a window's end: each occurrence counts for the
   ends from behind it up to the next one of its category, as far as its window reaches.

Answers, one for each key, time and width, are joined with the rows.  A task holds the entries of some
slabs, at most as many for each step as it has distinct values and categories.

Null keys are one key.  A null value counts as a row and has no rank; a null category is none.  A row with
a null time has no window (``at`` null, counts 0, ranks null) and lies in none.  Repeated rows each count
and each get their answer; an empty table gives an empty one.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

BLOCK_ROWS = 1 << 17  # entries whose slabs are worked on together


class Tree:
    """Merge-sort tree over steps 0 .. 2 ** ``height`` - 1 of several slabs, each with a root of its own.

    ``order[0]`` has the entries by slab and value.  A node's entries are one range of its level, the left
    child's first, so of a node only the ends of its range are kept while going down.
    """

    def __init__(self, slab: np.ndarray, step: np.ndarray, value: np.ndarray, weight: np.ndarray, slabs: int):
        self.height = max(1, int(step.max(initial=0)).bit_length())
        order = np.lexsort((value, slab))
        self.value = value[order]
        self.root = np.searchsorted(slab[order], np.arange(slabs + 1))
        self.left, self.weights = [], []
        for level in range(self.height):
            right = (step[order] >> (self.height - 1 - level)) & 1
            self.left.append(np.concatenate([[0], np.cumsum(1 - right)]))
            self.weights.append(np.concatenate([[0], np.cumsum(weight[order])]))
            node = slab[order] << self.height | step[order] >> (self.height - level)
            order = order[np.lexsort((right, node))]  # stable: children keep the order by value
        self.weights.append(np.concatenate([[0], np.cumsum(weight[order])]))

    def before(self, slab: np.ndarray, end: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Weight of the entries among the first ``place`` of the root's order, at steps below ``end``."""
        low, high = self.root[slab], self.root[slab + 1]
        at = low + place
        total = np.zeros(len(slab), np.int64)
        every = end >= 1 << self.height
        total[every] = self.weights[0][at[every]] - self.weights[0][low[every]]
        for level in range(self.height):
            left = self.left[level]
            in_left, all_left = left[at] - left[low], left[high] - left[low]
            goes = ((end >> (self.height - 1 - level)) & 1).astype(bool)
            below = self.weights[level + 1]  # of the left child, which a way to the right leaves behind
            total += np.where(goes & ~every, below[low + in_left] - below[low], 0)
            middle = low + all_left
            at, low, high = np.where(goes, middle + (at - low - in_left), low + in_left), np.where(goes, middle, low), np.where(goes, high, middle)
        return total

    def window(self, slab: np.ndarray, start: np.ndarray, end: np.ndarray, place: np.ndarray) -> np.ndarray:
        return self.before(slab, end, place) - self.before(slab, start, place)

    def ranked(self, slab: np.ndarray, start: np.ndarray, end: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Value number ``rank`` (from 1) of each window, which must have so many."""
        low, high = np.zeros(len(slab), np.int64), self.root[slab + 1] - self.root[slab]
        while True:  # the least number of first entries that hold ``rank`` of the window
            todo = np.flatnonzero(low < high)
            if not len(todo):
                return self.value[self.root[slab] + low - 1]
            middle = (low[todo] + high[todo]) // 2
            enough = self.window(slab[todo], start[todo], end[todo], middle) >= rank[todo]
            high[todo[enough]] = middle[enough]
            low[todo[~enough]] = middle[~enough] + 1


def distinct_in_windows(slab: np.ndarray, step: np.ndarray, category: np.ndarray, q_slab: np.ndarray, q_end: np.ndarray, width: int, reach: int) -> np.ndarray:
    """Number of categories among the entries of each window; ``reach`` is above all steps."""
    order = np.lexsort((step, category, slab))
    slab, step, category = slab[order], step[order], category[order]
    until = step + width
    same = np.flatnonzero((slab[1:] == slab[:-1]) & (category[1:] == category[:-1]))
    until[same] = np.minimum(until[same], step[same + 1])
    begins, ends = np.sort(slab * reach + step), np.sort(slab * reach + np.minimum(until, reach - 1))
    place = q_slab * reach + q_end  # counts from the step behind an occurrence up to ``until``
    return np.searchsorted(begins, place, "left") - np.searchsorted(ends, place, "left")


def _answers(entries: dict[str, np.ndarray], slab: int, halo: int, widths: list[int], shares: list[tuple[int, int]]) -> dict[str, np.ndarray]:
    """Answers at the own steps of whole slabs.  ``group`` numbers the slabs, ``step`` counts from ``halo``
    before a slab's start."""
    group, step, weight = entries["group"], entries["step"], entries["n"]
    groups = int(group.max()) + 1
    own = np.unique((group * (slab + halo) + step)[step >= halo])
    q_group, q_end = own // (slab + halo), own % (slab + halo)
    key = group * (slab + halo) + step
    by_time = np.argsort(key, kind="stable")
    times = key[by_time]
    known, named = entries["known"], entries["named"]
    tree = Tree(group[known], step[known], entries["value"][known], weight[known], groups)
    total = tree.root[q_group + 1] - tree.root[q_group]
    out: dict[str, list] = {c: [] for c in ("group", "step", "width", "rows", "total", "categories", *(f"r{k}" for k in range(len(shares))))}
    up = lambda x: np.concatenate([[0], np.cumsum(x[by_time])])
    rows, sums = up(weight), up(np.where(known, weight * entries["value"], 0))
    for width in widths:
        q_start = np.maximum(q_end - width, 0)
        low, high = np.searchsorted(times, q_group * (slab + halo) + q_start), np.searchsorted(times, own)
        m = tree.window(q_group, q_start, q_end, total)
        some = np.flatnonzero(m > 0)
        out["group"].append(q_group)
        out["step"].append(q_end)
        out["width"].append(np.full(len(own), width))
        out["rows"].append(rows[high] - rows[low])
        out["total"].append(sums[high] - sums[low])
        out["categories"].append(distinct_in_windows(group[named], step[named], entries["category"][named], q_group, q_end, width, slab + halo + 1))
        for k, (a, b) in enumerate(shares):
            got = np.full(len(own), np.iinfo(np.int64).min)
            got[some] = tree.ranked(q_group[some], q_start[some], q_end[some], -(-a * m[some] // b))
            out[f"r{k}"].append(got)
    return {c: np.concatenate(parts) for c, parts in out.items()}


def _slabs(slab: int, halo: int, widths: list[int], shares: list[tuple[int, int]], schema: str):
    """Task side: rows ``key, slab, step, value, category, n`` ordered by key and slab; slabs are taken
    whole, some at a time."""
    names = to_arrow_schema(StructType.fromDDL(schema))

    def worked(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        pair = pc.dictionary_encode(table.column("key").combine_chunks(), null_encoding="encode")
        number = table.column("slab").to_numpy()
        keys = pair.indices.to_numpy(zero_copy_only=False)
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (number[1:] != number[:-1])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        value, category = table.column("value").combine_chunks(), table.column("category").combine_chunks()
        codes = pc.dictionary_encode(category).indices
        got = _answers(
            {
                "group": group,
                "step": table.column("step").to_numpy() - number * slab + halo,
                "n": table.column("n").to_numpy(),
                "known": value.is_valid().to_numpy(zero_copy_only=False),
                "value": pc.fill_null(value, 0).to_numpy(zero_copy_only=False),
                "named": category.is_valid().to_numpy(zero_copy_only=False),
                "category": pc.fill_null(codes, -1).to_numpy(zero_copy_only=False).astype(np.int64),
            },
            slab,
            halo,
            widths,
            shares,
        )
        at = first[got["group"]]
        none = np.iinfo(np.int64).min
        ranks = [pa.array(got[f"r{k}"], pa.int64(), mask=got[f"r{k}"] == none) for k in range(len(shares))]
        columns = [table.column("key").take(pa.array(at)).combine_chunks(), pa.array(number[at] * slab + got["step"] - halo, pa.int64()), *[pa.array(got[c], pa.int64()) for c in ("width", "rows", "total", "categories")], *ranks]
        return pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, names, strict=True)], schema=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            if count < BLOCK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            number, key = table.column("slab").to_numpy(), table.column("key")
            last = table.num_rows - 1
            same = (number == number[last]) & pc.fill_null(pc.equal(key, key[last]) if key[last].is_valid else pc.is_null(key), False).to_numpy(zero_copy_only=False)
            cut = int(np.flatnonzero(same)[0])  # the last slab may go on in the next batch
            if cut:
                yield worked(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                count = table.num_rows - cut
        if held:
            yield worked(pa.Table.from_batches(held))

    return run


def window_features(rows: DataFrame, key: str, step: str, value: str, category: str, widths: list[int], shares: list[tuple[int, int]], slab: int | None = None) -> DataFrame:
    """``key, step, width, rows, total, categories, r0, r1, ..``: for each key, step (an integer) at which it
    has a row, and width (in steps): how many rows its window has, the sum of their values (long), their
    distinct categories, and for each share ``(a, b)`` the value number ceil(a m / b) of its m values.

    ``key`` and ``category`` are strings.  A slab is ``slab`` steps long, the largest width if it is not given.
    """
    halo = max(widths)
    slab = slab or halo
    entries = rows.filter(F.col(step).isNotNull()).groupBy(F.col(key).alias("key"), F.col(step).cast("long").alias("step"), F.col(value).cast("long").alias("value"), F.col(category).alias("category")).agg(F.count("*").alias("n"))
    reach = -(-halo // slab)
    own = F.expr(f"(step - pmod(step, {slab})) div {slab}")
    cuts = F.filter(F.sequence(F.col("own"), F.col("own") + reach), lambda k: k * slab - halo <= F.col("step"))
    dealt = entries.withColumn("own", own).select("key", F.explode(cuts).alias("slab"), "step", "value", "category", "n")
    ordered = dealt.repartition("key", "slab").sortWithinPartitions("key", "slab")
    out = "key string, step long, width long, rows long, total long, categories long, " + ", ".join(f"r{k} long" for k in range(len(shares)))
    return ordered.mapInArrow(_slabs(slab, halo, widths, shares, out), out)


def rolling(rows: DataFrame, key: str, step: str, value: str, category: str, widths: list[int], shares: list[tuple[int, int]], slab: int | None = None) -> DataFrame:
    """Every row of ``rows`` (its columns as the struct ``row``), once for each width, with the features of
    its window (see :func:`window_features`); a row without a step has empty ones."""
    named = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), F.col(key).alias("key"), F.col(step).cast("long").alias("step"))
    found = window_features(rows, key, step, value, category, widths, shares, slab)
    ranks = [f"r{k}" for k in range(len(shares))]
    answer = F.struct("width", "rows", "total", "categories", *ranks)
    listed = found.groupBy(F.col("key").alias("k"), F.col("step").alias("s")).agg(F.collect_list(answer).alias("all"))  # one for each width
    none = F.array(*[F.struct(F.lit(w).cast("long").alias("width"), *[F.lit(0).cast("long").alias(c) for c in ("rows", "total", "categories")], *[F.lit(None).cast("long").alias(r) for r in ranks]) for w in widths])
    joined = named.join(listed, F.col("key").eqNullSafe(F.col("k")) & (F.col("step") == F.col("s")), "left")
    return joined.select("row", F.inline(F.coalesce("all", none)))


def event_second(doc_id: Column) -> Column:
    """60 * floor((doc_id + h mod 4000) / 6) with h the CRC-32 of the decimal id."""
    at = doc_id + F.crc32(doc_id.cast("string").cast("binary")) % 4000
    return F.call_function("div", at - F.pmod(at, F.lit(6)), F.lit(6)) * 60  # in whole numbers, so exact for ids of any size


def document_windows(docs: DataFrame, widths_s: tuple[int, ...] = (3600, 21600)) -> DataFrame:
    """Two rows a document: counts, characters, languages, median and upper quartile of the text lengths of
    its source in the hour and the six hours before it; a step is a minute."""
    at = docs.select("doc_id", "source", "lang", F.char_length("text").cast("long").alias("chars"), event_second(F.col("doc_id")).alias("event_s"))
    stepped = at.withColumn("minute", F.expr("event_s div 60"))
    found = rolling(stepped, "source", "minute", "chars", "lang", [w // 60 for w in widths_s], [(1, 2), (75, 100)])
    return found.select("row.doc_id", (F.col("width") * 60).alias("window_s"), "row.event_s", F.col("rows").alias("n_events"), F.col("total").alias("sum_chars"), F.col("categories").alias("n_langs"), F.col("r0").alias("median_chars"), F.col("r1").alias("high_chars"))


# CRC-32 bit by bit: a step takes in a byte (or 0) and shifts once.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, lang, length(text) AS n, CAST(doc_id AS VARCHAR) AS s FROM documents),
h AS (SELECT *, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(range(1, length(s) + 1), lambda i: [CAST(ascii(s[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: CASE WHEN xor(c, x) % 2 = 1 THEN xor(xor(c, x) // 2, 3988292384) ELSE xor(c, x) // 2 END)) AS h FROM d),
e AS (SELECT doc_id, source, lang, n, CAST(60 * ((doc_id + h % 4000) // 6) AS BIGINT) AS event_s FROM h),
w AS (SELECT doc_id, 3600 AS window_s, event_s, count(*) OVER a AS n_events, sum(n) OVER a AS total, list(n) FILTER (n IS NOT NULL) OVER a AS l, list(lang) FILTER (lang IS NOT NULL) OVER a AS langs FROM e WINDOW a AS (PARTITION BY source ORDER BY event_s RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING)
  UNION ALL SELECT doc_id, 21600, event_s, count(*) OVER b, sum(n) OVER b, list(n) FILTER (n IS NOT NULL) OVER b, list(lang) FILTER (lang IS NOT NULL) OVER b FROM e WINDOW b AS (PARTITION BY source ORDER BY event_s RANGE BETWEEN 21600 PRECEDING AND 1 PRECEDING))
SELECT doc_id, CAST(window_s AS BIGINT) AS window_s, event_s, n_events, CAST(coalesce(total, 0) AS BIGINT) AS sum_chars, CAST(coalesce(len(list_distinct(langs)), 0) AS BIGINT) AS n_langs,
  CAST(list_sort(l)[(len(l) + 1) // 2] AS BIGINT) AS median_chars, CAST(list_sort(l)[(75 * len(l) + 99) // 100] AS BIGINT) AS high_chars FROM w"""
