"""Chapters, paragraphs and token-budget chunks of documents."""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from corpusloom.functions import text as T
from corpusloom.operators import ranges

TARGET_TOKENS = 800
OVERLAP_TOKENS = 100
_MARK = "\u0001"
_RANGES = "array<struct<lo:int,hi:int,n:bigint>>"
_RANGES_ARROW = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int64())]))
HEADING = r"(?d)(?m)(?U)^(?:CHAPTER|Chapter|PART|Part)\s+(\S+)"


def chapters(c: Column) -> Column:
    """``array<struct<title, content>>``: text cut at headings with a numeral.

    Every heading match gets a mark, also those whose token is no numeral (they use up their text);
    the latter join the part before them.
    """
    parts = F.split(F.regexp_replace(c, HEADING, _MARK + "$0"), _MARK)
    numbered = F.transform(parts, lambda p, i: F.struct(p.alias("p"), ((i > 0) & T.is_numeral(F.regexp_extract(p, HEADING, 1))).alias("h")))
    start = F.array(F.struct(F.lit("").alias("p"), F.lit(False).alias("h")))

    def fold(done: Column, part: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.concat(last["p"], part["p"]).alias("p"), last["h"].alias("h"))))
        return F.when(part["h"], F.concat(done, F.array(part))).otherwise(grown)

    joined = F.aggregate(numbered, start, fold)
    kept = F.filter(joined, lambda x: x["h"] | (T.strip(x["p"]) != ""))
    named = F.transform(kept, lambda x: F.struct(F.when(x["h"], T.strip(F.substring_index(x["p"], "\n", 1))).otherwise("Preamble").alias("title"), T.strip(x["p"]).alias("content")))
    return F.when(F.exists(joined, lambda x: x["h"]), named).otherwise(F.array(F.struct(F.lit("Full Text").alias("title"), c.alias("content"))))


class OpenChunk:
    """The chunk that is being filled: tokens of its paragraphs, and what closes it.

    When a paragraph would pass the target, the open chunk is closed and the next one starts with the
    longest run of its last paragraphs that fits into the overlap.
    """

    def __init__(self, target: int, overlap: int):
        self.target, self.overlap = target, overlap
        self.parts: list = []
        self.sizes: list[int] = []
        self.total = 0

    def closes_before(self, size: int) -> bool:
        return bool(self.sizes) and self.total + size > self.target

    def add(self, part, size: int) -> None:
        self.parts.append(part)
        self.sizes.append(size)
        self.total += size

    def reopen(self) -> None:
        at, kept = len(self.sizes), 0
        while at and kept + self.sizes[at - 1] <= self.overlap:
            at -= 1
            kept += self.sizes[at]
        self.parts, self.sizes, self.total = self.parts[at:], self.sizes[at:], kept


def chunk_ranges(tokens: Column, target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS) -> Column:
    """``array<struct<lo, hi, n>>``: ranges of paragraphs (zero-based) with their token counts, in one pass
    over the counts.  A fold in built-in functions copies its list of ranges at every paragraph."""

    def cuts(sizes: list[int]) -> list[dict]:
        out, open_chunk = [], OpenChunk(target, overlap)
        close = lambda: out.append({"lo": open_chunk.parts[0], "hi": open_chunk.parts[-1], "n": open_chunk.total})
        for at, size in enumerate(sizes):
            if open_chunk.closes_before(size):
                close()
                open_chunk.reopen()
            open_chunk.add(at, size)
        if open_chunk.parts:
            close()
        return out

    @F.arrow_udf(_RANGES)
    def cut(counts: pa.Array) -> pa.Array:
        return pa.array([None if c is None else cuts(c) for c in counts.to_pylist()], _RANGES_ARROW)

    return cut(tokens)


def chunks(docs: DataFrame, paragraphs: str, count: Callable[[Column], Column] = T.word_count, target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS) -> DataFrame:
    """``docs`` with one row for each chunk: ``chunk_no`` (from 1), ``chunk`` and ``n_tokens``.

    ``count`` is the token counter.  Blank paragraphs are dropped; a document without any gives none.  The
    paragraphs of a document follow each other where they are, so nothing is shuffled.
    """
    keep = [c for c in docs.columns if c != paragraphs]
    each = docs.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("__doc"), F.col(paragraphs).alias("__p")).select(*keep, "__doc", F.explode("__p").alias("__text"))
    rows = each.filter(T.strip(F.col("__text")) != "").withColumn("__n", count(F.col("__text")).cast("bigint"))
    return _folded(rows, ["__doc"], target, overlap).select(*keep, "chunk_no", "chunk", "n_tokens")


def chunk_rows(paragraphs: DataFrame, doc: list[str], order: list[str], text: str, count: Callable[[Column], Column] = T.word_count, target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS) -> DataFrame:
    """The chunks of :func:`chunks` from a table with one paragraph a row: the columns of ``doc``,
    ``chunk_no``, ``chunk`` and ``n_tokens``.

    For documents of any length: paragraphs are sorted by document and stream through a task, which
    holds no more than the open chunk.  Null keys are one document.
    """
    solid = paragraphs.filter(F.col(text).isNotNull() & (T.strip(F.col(text)) != ""))
    rows = solid.select(*doc, *[c for c in order if c not in doc], F.col(text).alias("__text"), count(F.col(text)).cast("bigint").alias("__n"))
    return _folded(rows.repartition(*doc).sortWithinPartitions(*doc, *order).select(*doc, "__text", "__n"), doc, target, overlap)


def _folded(rows: DataFrame, doc: list[str], target: int, overlap: int) -> DataFrame:
    """Chunks of ``rows`` with ``__text`` and its size ``__n``; rows of one document, told by the columns of
    ``doc``, follow each other.  All other columns are those of the document's first row."""
    keep = [c for c in rows.columns if c not in ("__text", "__n")]
    schema = StructType([*(rows.schema[c] for c in keep), StructField("chunk_no", IntegerType()), StructField("chunk", StringType()), StructField("n_tokens", LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner: pa.RecordBatch | None = None  # first row of the open document
        number, open_chunk = 0, OpenChunk(target, overlap)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.select(keep)
            keys = [own.column(c) for c in doc]
            new = _changes(keys) if keys else np.arange(batch.num_rows) == 0
            if owner is not None and all(owner.column(c)[0].as_py() == k[0].as_py() for c, k in zip(doc, keys, strict=True)):
                new[0] = False
            heads = own if owner is None else pa.Table.from_batches([owner, own]).combine_chunks().to_batches()[0]
            shift = 0 if owner is None else 1
            row, done = 0, ([], [], [], [])  # row of the document in ``heads``, number, text, tokens

            def close(row: int, number: int, done: tuple, open_chunk: OpenChunk) -> None:
                for to, value in zip(done, (row, number, "\n\n".join(open_chunk.parts), open_chunk.total), strict=True):
                    to.append(value)

            for i, (starts, part, size) in enumerate(zip(new.tolist(), batch.column("__text").to_pylist(), batch.column("__n").to_pylist(), strict=True)):
                if starts:
                    if open_chunk.parts:
                        close(row, number + 1, done, open_chunk)
                    row, number, open_chunk = i + shift, 0, OpenChunk(target, overlap)
                if open_chunk.closes_before(size):
                    number += 1
                    close(row, number, done, open_chunk)
                    open_chunk.reopen()
                open_chunk.add(part, size)
            owner = heads.slice(row, 1)
            if done[0]:
                own_columns = heads.take(pa.array(done[0])).columns
                yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip([*own_columns, pa.array(done[1], pa.int32()), pa.array(done[2], pa.string()), pa.array(done[3], pa.int64())], arrow, strict=True)], schema=arrow)
        if open_chunk.parts:
            last = [*owner.columns, pa.array([number + 1], pa.int32()), pa.array(["\n\n".join(open_chunk.parts)], pa.string()), pa.array([open_chunk.total], pa.int64())]
            yield pa.RecordBatch.from_arrays([c if c.type == f.type else c.cast(f.type) for c, f in zip(last, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema)


class Shelf:
    """Next-fit over a range of sizes whose first shard is open already, for every room it may have left.

    ``next[i]`` is the item that starts the shard after the one that starts with item i.  Following it to
    the end of the range, by doubling the steps, gives for each start how many shards begin in the range
    and what the last of them holds.
    """

    def __init__(self, sizes: np.ndarray, limit: int):
        self.sums = np.concatenate([[0], np.cumsum(sizes)])
        self.limit, n = limit, len(sizes)
        at = np.arange(n)
        self.next = np.maximum(at + 1, np.searchsorted(self.sums[1:], self.sums[:-1] + limit, "right"))

    def outcomes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``room, held, shards``: with less room than ``room[k]`` (and not less than the one before it) the
        range ends with a shard that holds ``held[k]``, after ``shards[k]`` new ones.  With more room than
        any, everything fits."""
        n = len(self.next)
        step, last, count = np.append(self.next, n), np.arange(n + 1), np.append(np.ones(n, np.int64), 0)
        while (step < n).any():
            count = count + count[step]
            last = np.where(step < n, last[step], last)
            step = step[step]
        most = np.searchsorted(self.sums[1:], self.limit, "right") + 1
        room, held, shards = self.sums[1:][:most], (self.sums[-1] - self.sums[last])[:n][:most], count[:n][:most]
        same = np.zeros(len(room), bool)
        same[:-1] = (held[1:] == held[:-1]) & (shards[1:] == shards[:-1])
        return room[~same], held[~same], shards[~same]

    def shard_numbers(self, room: int, shards: int) -> np.ndarray:
        """Number of each item's shard, with ``shards`` begun before the range."""
        starts = np.zeros(len(self.next), np.int64)
        at = int(np.searchsorted(self.sums[1:], room, "right"))
        while at < len(starts):
            starts[at] = 1
            at = int(self.next[at])
        return shards + np.cumsum(starts)


def _changes(columns: list[pa.Array]) -> np.ndarray:
    """Where a row differs from the one before it; a null equals a null."""
    out = np.ones(len(columns[0]), bool) if columns else np.zeros(0, bool)
    if len(out) > 1:
        out[1:] = False
        for c in columns:
            a, b = c[1:], c[:-1]
            apart = pc.or_(pc.xor(pc.is_null(a), pc.is_null(b)), pc.fill_null(pc.not_equal(a, b), False))
            out[1:] |= apart.to_numpy(zero_copy_only=False)
    return out


def next_fit(items: DataFrame, group: list[str], order: list[str], size: str, limit: int, part_rows: int = 200_000) -> DataFrame:
    """``items`` with ``shard`` (from 1): a new shard when the next item would pass ``limit``; an item
    above the limit has a shard of its own.  A null size is 0; null groups are one group.

    A group is cut into ranges of its order that are worked on side by side.  A range tells what becomes
    of it for every room that the shard open before it may have (see :class:`Shelf`); these few steps stream
    in order through one task a group, which knows one number, and give each range its first room.
    """
    dealt = ranges.ranged(items, [*group, *order], part_rows)
    names = [f"g{i}" for i in range(len(group))]
    keys = [F.col(f"row.`{c}`").alias(n) for c, n in zip(group, names, strict=True)]
    n = F.coalesce(F.col(f"row.`{size}`"), F.lit(0)).cast("bigint")
    sized = dealt.select("part", *keys, n.alias("n"), "pos").repartition("part").sortWithinPartitions("part", "pos").drop("pos")
    longs = ArrayType(LongType())
    summary = StructType([StructField("part", IntegerType()), *(sized.schema[c] for c in names), StructField("total", LongType()), *(StructField(c, longs) for c in ("room", "held", "shards"))])

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, ["part", *names]):
            shelf = Shelf(table.column("n").to_numpy(), limit)
            row = {c: [table.column(c)[0].as_py()] for c in ("part", *names)} | {"total": [int(shelf.sums[-1])]}
            row |= {c: [v.tolist()] for c, v in zip(("room", "held", "shards"), shelf.outcomes(), strict=True)}
            yield pa.RecordBatch.from_pydict(row, schema=to_arrow_schema(summary))

    entry = StructType([*summary.fields[: 1 + len(group)], StructField("first_room", LongType()), StructField("before", LongType())])

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, room, before = None, -1, 0
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[c] for c in names)
                if (key,) != now:
                    now, room, before = (key,), -1, 0  # the first item starts a shard
                yield pa.RecordBatch.from_pylist([{c: row[c] for c in ("part", *names)} | {"first_room": room, "before": before}], schema=to_arrow_schema(entry))
                k = bisect.bisect_right(row["room"], room)
                if k < len(row["room"]):
                    room, before = limit - row["held"][k], before + row["shards"][k]
                else:
                    room -= row["total"]

    steps = sized.mapInArrow(told, summary)
    rooms = steps.repartition(*(names or [F.lit(0)])).sortWithinPartitions(*names, "part").mapInArrow(entered, entry)
    item = dealt.select("part", *keys, F.lit(None).cast("bigint").alias("first_room"), F.lit(None).cast("bigint").alias("before"), F.col("pos"), n.alias("n"), "row")
    head = rooms.select("part", *names, "first_room", "before", F.lit(-1).cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast(dealt.schema["row"].dataType).alias("row"))
    both = head.unionByName(item).repartition("part").sortWithinPartitions("part", *names, "pos")
    schema = StructType([dealt.schema["row"], StructField("shard", IntegerType())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches, ["part", *names]):
            own = Shelf(table.column("n").to_numpy()[1:], limit).shard_numbers(table.column("first_room")[0].as_py(), table.column("before")[0].as_py())
            rows = pa.table([table.column("row").slice(1), pa.array(own, pa.int32())], names=["row", "shard"])
            yield from rows.to_batches(max_chunksize=10_000)

    return both.mapInArrow(placed, schema).select("row.*", "shard")


def _whole(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of equal keys, which lie next to each other, as one table each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = [int(k) for k in np.flatnonzero(_changes([batch.column(batch.schema.get_field_index(c)) for c in keys]))]
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            if all(last.column(last.schema.get_field_index(c))[0].as_py() == batch.column(batch.schema.get_field_index(c))[0].as_py() for c in keys):
                cuts = cuts[1:]
        at = 0
        for cut in cuts:
            if cut > at:
                held.append(batch.slice(at, cut - at))
            if held:
                yield pa.Table.from_batches(held)
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)
