"""Periodic runs of words by Karp-Miller-Rosenberg naming.

A run is a stretch of consecutive words with smallest period q, of ``max(least, 2 q)`` words or more, that
no neighbouring word extends keeping period q.

1. Words get numbers.  The name of a stretch of 2 ** k words is the number of the pair of names of its
   halves, so equal stretches have equal names.  A stretch that occurs once in its block has a name that
   equals no other; only repeated ones are sorted for the next level, and levels end where none is left.
2. How far two places agree to the right, or to the left, is found by going down the levels and taking
   each step whose names are equal.
3. A run of period q and two periods or more covers two neighbours of the grid 0, q, 2 q, ..; on one side
   of them half of what the run needs must agree, so a pair of grid places is looked at only if the names
   of the largest level below that half are equal there.  Such pairs are extended both ways.
4. A stretch that is found with several periods has the least one; the others are multiples of it.

Documents of a batch are joined into blocks of about ``BLOCK_WORDS`` words with a separator between them
that equals nothing, so short texts share the work.  A longer text is a block of its own: it costs four
bytes a word and level, of which there are as many as its longest repeat has binary digits.

Words are stretches of bytes other than space and 0x09 to 0x0D.  Null, empty and blank texts have no words
and no runs.  Rows do not depend on each other: repeated rows and ids, null ids included, give a row
each, an empty table an empty one, and nothing is shuffled.  Other columns pass unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 12
BLOCK_WORDS = 1 << 17


def names(words: np.ndarray) -> list[np.ndarray]:
    """Names of the stretches of 1, 2, 4, .. words at each place, while any of them is repeated.  A name
    of 0 or more is shared by equal stretches; a negative one is a place's own."""
    n = len(words)
    alone = -1 - np.arange(n, dtype=np.int64)

    def named(places: np.ndarray, keys: np.ndarray) -> np.ndarray:
        got = alone.copy()
        _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
        some = count[number] > 1
        got[places[some]] = number[some]
        return got

    levels, now = [], named(np.arange(n), words)
    while (now >= 0).any():
        levels.append(now)
        half = 1 << (len(levels) - 1)
        places = np.flatnonzero((now[: n - half] >= 0) & (now[half:] >= 0))
        now = named(places, now[places] * n + now[places + half])
    return levels


def agree_right(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from ``a`` on equal those from ``b`` on; a separator ends the block."""
    at, to = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        step = (levels[k][at] == levels[k][to]).astype(np.int64) << k
        at += step
        to += step
    return at - a


def agree_left(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before ``a`` equal those before ``b``; a separator starts the block."""
    at, to = a.copy(), b.copy()
    for k in range(len(levels) - 1, -1, -1):
        low, high = at - (1 << k), to - (1 << k)
        step = ((low >= 0) & (levels[k][np.maximum(low, 0)] == levels[k][np.maximum(high, 0)])).astype(np.int64) << k
        at -= step
        to -= step
    return a - at


def runs_of(words: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """``start, end, period`` (rows) of all runs of a block, by start and end.  ``words`` starts and ends
    with a separator; a separator equals nothing.  ``longest`` is the longest stretch without one."""
    levels = names(words)
    n, found = len(words), []
    for q in range(1, longest // 2 + 1):
        need = max(q, least - q)  # words that agree on both sides together
        k = (-(-need // 2)).bit_length() - 1
        if k >= len(levels):
            if q >= least:
                break  # longer periods need more
            continue
        level, reach = levels[k], 1 << k
        first = -(-reach // q) * q  # first place of the grid that has so many words before it
        right = np.flatnonzero(level[0 : n - q : q] == level[q:n:q]) * q
        left = np.flatnonzero(level[first - reach : n - q - reach : q] == level[first - reach + q : n - reach : q]) * q + first
        at = np.union1d(right, left)
        if not len(at):
            continue
        f, b = agree_right(levels, at, at + q), agree_left(levels, at, at + q)
        good = f + b >= need
        if good.any():
            ends = np.unique(np.stack([at[good] - b[good], at[good] + q + f[good]], axis=1), axis=0)
            found.append(np.column_stack([ends, np.full(len(ends), q)]))
    if not found:
        return np.zeros((0, 3), np.int64)
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    return every[new]


def block_runs(docs: list[list[bytes]], least: int = LEAST) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each list of words: its runs (start, end, period by start and period) and which words stay."""
    size = np.array([len(d) for d in docs])
    number: dict[bytes, int] = {}
    flat = np.full(int(size.sum()) + len(docs) + 1, -1, np.int64)
    starts = np.cumsum(size + 1) - size
    for words, at in zip(docs, starts.tolist(), strict=True):
        flat[at : at + len(words)] = [number.setdefault(w, len(number)) for w in words]
    gaps = np.append(starts - 1, len(flat) - 1)
    flat[gaps] = len(number) + np.arange(len(gaps))
    found = runs_of(flat, int(size.max(initial=0)), least)
    marks = np.zeros(len(flat) + 1, np.int64)
    np.add.at(marks, found[:, 0] + found[:, 2], 1)
    np.add.at(marks, found[:, 1], -1)
    stays = np.cumsum(marks)[:-1] == 0
    cuts = np.searchsorted(found[:, 0], np.append(starts, len(flat)))
    out = []
    for k, at in enumerate(starts.tolist()):
        own = found[cuts[k] : cuts[k + 1]] - np.array([at, at, 0])
        out.append((own[np.lexsort((own[:, 2], own[:, 0]))], stays[at : at + size[k]]))
    return out


def _blocks(size: list[int]) -> Iterator[list[int]]:
    """Numbers of the documents of each block; those of a block have similar lengths."""
    block, held = [], 0
    for k in sorted(range(len(size)), key=lambda k: size[k]):
        if block and held + size[k] > BLOCK_WORDS:
            yield block
            block, held = [], 0
        block.append(k)
        held += size[k]
    if block:
        yield block


_RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_DIGEST = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _row(words: list[bytes], own: np.ndarray, stays: np.ndarray, digest: bool) -> tuple:
    kept = b" ".join(words if stays.all() else [w for w, s in zip(words, stays.tolist(), strict=True) if s])
    runs = [(s, e - s, q) for s, e, q in own.tolist()]
    if not digest:
        return len(words), [{"start": s, "length": n, "period": q} for s, n, q in runs], kept.decode("utf-8", "replace")
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def _found(least: int, digest: bool):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_DIGEST if digest else _RUNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [(t or b"").split() for t in batch.column(1).to_pylist()]
            rows: list[tuple] = [()] * len(docs)
            for block in _blocks([len(d) for d in docs]):
                for k, (own, stays) in zip(block, block_runs([docs[k] for k in block], least), strict=True):
                    rows[k] = _row(docs[k], own, stays, digest)
            columns = list(zip(*rows, strict=True)) or [[]] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(list(c), f.type) for c, f in zip(columns, list(schema)[1:], strict=True)]], schema=schema)

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Runs of each text: ``doc_id, n_words, runs`` (start and length in words, period; by start and period)
    and ``collapsed``, the words outside of any repetition: of a run only its first period stays.

    With ``digest``: the number of runs, the longest one (first by start, then period), and the SHA-256 of
    the list of all runs and of the collapsed text.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(_found(least, digest), _DIGEST if digest else _RUNS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in which every tenth document by the hash of its id repeats words: with n words, its
    hash h and g = h div 10, words from a = g % n on repeat those from there with a period of
    1 + (n - a) div (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    cut = docs.select("doc_id", "text", F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10").alias("g"), words.alias("w"))
    n = F.size("w")
    placed = cut.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn("p", F.expr("1 + (size(w) - a) div (3 + g % 8)"))
    repeated = F.array_join(F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))
