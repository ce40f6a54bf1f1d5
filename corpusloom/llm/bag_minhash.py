"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

A shingle of weight w (its count in the document) is the union of Poisson processes on dyadic parts
(0, 1], (1, 2], (2, 4], .. of its weight.  The process of a part has its length as rate; a point has
a time, a register and a weight coordinate, given by hashes of shingle, part and point number, and
counts if the coordinate, found by halving the part, lies below w.  A register holds the least time
of its points, so two documents agree in a register with a probability of exactly their weighted
Jaccard similarity.  Only points before a limit near (registers * log registers) / weight are made;
a document with an empty register is done again with a later limit.

1. Documents with equal multisets are copies: one node for all of them.
2. Bands of registers put nodes into buckets.  Members of a bucket meet its least one, and where classes
   stay apart those with whom they share rare shingles (see ``buckets``); the multisets of a pair that
   agrees in enough registers, and whose parities (see ``buckets.may_share``) do not rule it out, are
   compared exactly, over whole texts.
3. The components of all links are the classes.  No step makes all pairs of a group.

Words are runs of ASCII letters and digits or any other non-ASCII bytes, with ASCII lower-cased.
A text of one to four words is one shingle.  A text without words (null, empty) is in a class of its
own.  Repeated rows are copies; a tie between rows of one doc_id goes to the least multiset hash.  An
empty table gives an empty one.  Texts are read in slices of a few megabytes, so a batch of very long
ones needs no more than its own size.  Other columns pass unread, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.llm.buckets import agreed, may_share, settled, shared_buckets
from corpusloom.llm.common import forget, id_order, packed_row, spans_of, written

SHINGLE = 5
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
SIMILAR = 0.8
MEMO_WORDS = 150_000  # about 45 MB of a worker
SENT_IDS = 4_000_000
PARITIES = 2048  # bits of a document in which its shingles are counted by parity
SLICE_BYTES = 4 << 20  # of texts or bags that are worked on at once

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_table = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _Words()


def bag(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a UTF-8 text as sorted 64-bit hashes, with their counts."""
    words = (text or b"").translate(_table).split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - SHINGLE + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(w))):
        h = mix(h * _STEP + w[k : k + n])
    return np.unique(h, return_counts=True)


def jaccard(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two bags."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    whole = int(a[1].sum() + b[1].sum()) - both
    return both / whole if whole else 0.0


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """BagMinHash registers of each bag (rows); every bag must have a shingle."""
    out = np.full((len(bags), REGISTERS), np.inf)
    todo, spread = np.arange(len(bags)), 8.0
    while len(todo):
        size = np.array([len(bags[i][0]) for i in todo])
        element, weight = np.concatenate([bags[i][0] for i in todo]), np.concatenate([bags[i][1] for i in todo])
        own = np.repeat(np.arange(len(todo)), size)
        total = np.add.reduceat(weight, np.cumsum(size) - size)
        limit = spread * REGISTERS / total
        got = np.full(len(todo) * REGISTERS, np.inf)
        part = 0
        while len(element):
            low = 0 if part == 0 else 1 << (part - 1)
            rate = max(1, low)
            _poisson_part(element, weight, own, limit, part, low, rate, got)
            more = weight > (1 << part)
            element, weight, own = element[more], weight[more], own[more]
            part += 1
        got = got.reshape(len(todo), REGISTERS)
        full = np.isfinite(got).all(axis=1)
        out[todo[full]] = got[full]
        todo, spread = todo[~full], spread * 2
    return out


def _steps(k: int) -> np.uint64:
    return np.uint64(k * int(_STEP) % (1 << 64))


def _poisson_part(element, weight, own, limit, part, low, rate, got) -> None:
    """Points of one dyadic part of the weights, in rounds: the k-th point of all shingles at once."""
    seed = mix(element + _steps(part + 1))
    time, last = np.zeros(len(seed)), limit[own]
    k = 0
    while len(seed):
        k += 1
        h = mix(seed + _steps(k))
        time = time - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        alive = time < last
        seed, weight, own, time, last = seed[alive], weight[alive], own[alive], time[alive], last[alive]
        g = mix(h[alive] ^ _MIX2)
        register = (g >> np.uint64(32)).astype(np.int64) % REGISTERS
        take = np.ones(len(seed), bool)
        if part:  # halve (low, 2 low] along the bits of the point until its side of w is known
            take = low + (g & np.uint64(low - 1)).astype(np.int64) < weight
        np.minimum.at(got, own[take] * REGISTERS + register[take], time[take])


_SIGNED = "doc_id long, bag binary, weight long, bands array<long>, packs array<long>, bits array<long>"


def each(b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A multiset as a set, in which the second and later copies of a shingle are elements of their own."""
    hashes, counts = b
    copy = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    own = np.repeat(hashes, counts)
    return np.where(copy > 0, mix(own + copy.astype(np.uint64) * _STEP), own)


def parities(b: tuple[np.ndarray, np.ndarray]) -> list[int]:
    """``PARITIES`` bits as longs: whether an odd number of elements falls on each."""
    falls = np.bincount((each(b) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES)
    return np.packbits((falls & 1).astype(np.uint8)).view(np.int64).tolist()


def _name(b: tuple[np.ndarray, np.ndarray]) -> bytes:
    return hashlib.blake2b(b[0].tobytes() + b[1].tobytes(), digest_size=16).digest()


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).to_pylist()
        for low, high in spans_of(texts, SLICE_BYTES // 4):
            bags = [bag(t) for t in texts[low:high]]
            some = [k for k, b in enumerate(bags) if len(b[0])]
            names, bands, packs, sums = ([None] * len(bags) for _ in range(4))
            if some:
                bits = signatures([bags[k] for k in some]).view(np.uint64).reshape(len(some), BANDS, ROWS)
                key = np.full((len(some), BANDS), 17, np.uint64) + np.arange(BANDS, dtype=np.uint64)
                for r in range(ROWS):
                    key = mix(key * _STEP + bits[:, :, r])
                tags = (mix(bits.reshape(len(some), -1)) & np.uint64(255)).astype(np.uint8).view(np.int64)
                for k, row, tag in zip(some, key.view(np.int64).tolist(), tags.tolist(), strict=True):
                    names[k], bands[k], packs[k], sums[k] = _name(bags[k]), row, tag, parities(bags[k])
            longs = pa.list_(pa.int64())
            arrays = [batch.column(0)[low:high], pa.array(names, pa.binary()), pa.array([int(b[1].sum()) for b in bags], pa.int64()), *[pa.array(c, longs) for c in (bands, packs, sums)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "bag", "weight", "bands", "packs", "bits"])


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, node (hash of the multiset; null without words), total weight, band keys, one byte of each
    register, packed into longs, and the parities."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(_sign, _SIGNED)


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node`` of each text of ``text`` and its multiset as bytes: hashes, then counts."""
    for batch in batches:
        texts = batch.column(0).to_pylist()
        for low, high in spans_of(texts, SLICE_BYTES):
            bags = [bag(t) for t in texts[low:high]]
            yield pa.RecordBatch.from_arrays([pa.array([_name(b) if len(b[0]) else None for b in bags], pa.binary()), pa.array([b[0].tobytes() + b[1].tobytes() for b in bags], pa.binary())], names=["node", "body"])


def node_bags(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, body``, one for each ``node`` of ``nodes`` (with the least ``doc_id`` that has it).

    While the ids are few enough, they go to the texts; else the texts are shuffled to them.
    """
    wanted = nodes.select("node", F.col("doc_id").alias("id"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    ids = wanted.select("id").distinct()
    if nodes.count() <= SENT_IDS:
        ids = F.broadcast(ids)  # at most 32 MB of ids
    found = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("id"))).select("text")
    return found.mapInArrow(_bagged, "node binary, body binary").join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


def _read(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(body) // 2
    return np.frombuffer(body, np.uint64, half // 8), np.frombuffer(body, np.int64, half // 8, half)


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, n, element`` of each ``node, body``."""
    for batch in batches:
        for node, body in zip(batch.column(0), batch.column(1), strict=True):
            own = each(_read(body.as_py())).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([node.as_py()] * len(own), pa.binary()), pa.array(np.full(len(own), len(own))), pa.array(own)], names=["node", "n", "element"])


def _similar(least: float):
    """Pairs ``a, b`` whose multisets (the last two columns) are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [jaccard(_read(x.as_py()), _read(y.as_py())) >= least for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """Classes of near-duplicate documents: ``doc_id, bag, root, class_id``.

    ``class_id`` is the least doc_id of the class; ``bag`` and ``root`` name the document's multiset
    and its class (null for a text without words, which is a class of its own).
    """
    docs = docs.select("doc_id", "text")
    signs = written(signed(docs), "signatures")
    nodes = signs.filter("bag is not null").groupBy(F.col("bag").alias("node")).agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("weight", "bands", "packs", "bits")])
    shared = shared_buckets([nodes.select("node", F.explode("bands").alias("key"))], "buckets")
    involved = written(nodes.join(shared.select("node").distinct(), "node", "left_semi").drop("bands"), "nodes")
    bags = written(node_bags(docs, involved), "bags")
    own = involved.select("node", "weight", "packs", "bits")
    floor = int(REGISTERS * least - 4.2 * (REGISTERS * least * (1 - least)) ** 0.5)  # a similar pair is under it once in 70,000

    def likely(pairs: DataFrame) -> DataFrame:
        known = pairs.join(own.toDF("a", "weight_a", "packs_a", "bits_a"), "a").join(own.toDF("b", "weight_b", "packs_b", "bits_b"), "b")
        close = F.least("weight_a", "weight_b") >= least * F.greatest("weight_a", "weight_b")
        close &= may_share(F.col("bits_a"), F.col("bits_b"), F.col("weight_a"), F.col("weight_b"), least)
        return known.filter(close & (agreed(F.col("packs_a"), F.col("packs_b"), REGISTERS, 8) >= floor))

    def verify(pairs: DataFrame) -> DataFrame:
        met = pairs.join(bags.toDF("a", "body_a"), "a").join(bags.toDF("b", "body_b"), "b")
        return met.select("a", "b", "body_a", "body_b").mapInArrow(_similar(least), "a binary, b binary")

    def elements(nodes: DataFrame) -> DataFrame:
        return bags.join(nodes, "node").select("node", "body").repartition("node").mapInArrow(_elements, "node binary, n long, element long")

    classes = settled(shared, verify, likely, elements, least, "near")
    for table in (shared, involved, bags):
        forget(table)
    named = signs.select("doc_id", "bag").join(classes.toDF("bag", "root"), "bag", "left").withColumn("root", F.coalesce("root", "bag"))
    least_id = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return named.join(least_id, "root", "left").select("doc_id", "bag", "root", F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))


def _with_node(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``row`` with the node of its ``text``."""
    for batch in batches:
        texts = pc.struct_field(batch.column(0), "text")
        names = [_name(b) if len(b[0]) else None for b in (bag((t.as_py() or "").encode()) for t in texts)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary())], names=["row", "node"])


def without_near_duplicates(docs: DataFrame, least: float = SIMILAR) -> DataFrame:
    """One row of each class, with all columns: the one with the least doc_id (null first), then the
    least multiset hash; all rows without words."""
    classes = near_duplicates(docs, least)
    kept = classes.filter("root is not null").groupBy("root").agg(F.min(F.struct(id_order().alias("o"), "bag", "doc_id")).alias("k"))
    wanted = kept.select(F.col("k.bag").alias("bag"), F.col("k.doc_id").alias("id"))
    rows = docs.select(packed_row(docs).alias("row"))
    named = rows.mapInArrow(_with_node, StructType([rows.schema["row"], *StructType.fromDDL("node binary")]))
    some = named.filter("node is not null").join(wanted, (F.col("node") == F.col("bag")) & F.col("row.doc_id").eqNullSafe(F.col("id"))).dropDuplicates(["node"])
    return some.select("row").unionByName(named.filter("node is null").select("row")).select("row.*")
