"""Byte-level BPE encoding and decoding by a global distinct-word shuffle.

1. Every task cuts its documents into words and turns each document into positions in the task's
   own word list (one word list for a bounded amount of text).  Both are written once.
2. The word lists are shuffled by word hash; each distinct word of the corpus is encoded once.
3. Ids go back to the word list they came from and each document is put together by position.
4. Decoding joins the ids with the token-byte table, a fixed table of one row per vocabulary entry.

A word is a piece of text that starts at a space followed by a non-space (or at a line feed that
follows a non-space).  A match of the split pattern always starts there, and a piece is itself cut
by the tokenizer's pattern, so the ids are those of the whole text.  A hot word occurs once per word
list, so no key holds more than one row per list.

Null text counts as empty; an empty text has no ids.  Repeated rows and ids are kept as they are, an
empty table gives an empty one, other columns are not read.  A very long text is one document of a list
of its own, so it costs its own size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import delete, fresh_path, parts_for, text_bytes, written

LIST_BYTES = 24 << 20  # text behind one word list
PART_BYTES = 32 << 20
MOST_BUCKETS = 50_000  # of the table of lists, half of what Spark takes; beyond it a bucket holds more lists

_irregular = re.compile(r" \s| \Z|\s\n").search
_loose_split = re.compile(r" (?=\S)").split


def cut(text: str) -> list[str]:
    """Words of a text as keys: the first one marked by CR, others without their leading space."""
    if not text:
        return []
    parts = _loose_split(text) if _irregular(text) else text.replace("\n", " \n").split(" ")
    parts[0] = "\r" + parts[0]
    return parts


def word_text(key: str) -> str:
    """The text that a key of :func:`cut` stands for."""
    if key[0] == "\r":
        return key[1:]
    return key if key[0] == "\n" else " " + key


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_encoders: dict = {}


def encoder(path: str, pattern: str):
    """One tokenizer for a worker process."""
    if (path, pattern) not in _encoders:
        import tiktoken

        _encoders[path, pattern] = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    return _encoders[path, pattern]


def token_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Token-byte table: start offsets by id (one more than ids) and all token bytes in a row."""
    ranks = load_ranks(path)
    size = max(ranks.values(), default=-1) + 1
    by_id = [b""] * size
    for token, i in ranks.items():
        by_id[i] = token
    starts = np.zeros(size + 1, np.int64)
    np.cumsum([len(t) for t in by_id], out=starts[1:])
    return starts, np.frombuffer(b"".join(by_id), np.uint8)


def decode_ids(ids: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> bytes:
    """Join of ids with the token-byte table, in order."""
    starts, data = table
    at = starts[ids]
    length = starts[ids.astype(np.int64) + 1] - at
    total = int(length.sum())
    ends = np.cumsum(length)
    return data[np.repeat(at - (ends - length), length) + np.arange(total)].tobytes()


def _pack(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _pack_ints(values: np.ndarray) -> bytes:
    """Unsigned integers by byte planes: the high planes are nearly constant and cost little."""
    width = 2 if len(values) == 0 or int(values.max()) < 1 << 16 else 4
    return bytes([width]) + _pack(values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes())


def _unpack_ints(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(_unpack(blob[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.uint32)


def _pack_words(raw: list[bytes]) -> bytes:
    return _pack(np.array([len(r) for r in raw], np.uint32).tobytes() + b"".join(raw))


def _unpack_words(blob: bytes, n: int) -> list[bytes]:
    raw = _unpack(blob)
    ends = np.cumsum(np.frombuffer(raw, np.uint32, n), dtype=np.int64).tolist()
    body, at, out = raw[4 * n :], 0, []
    for end in ends:
        out.append(body[at:end])
        at = end
    return out


_LISTS = "list string, bucket int, n long, ids binary, sizes binary, places binary, body binary"
_LIST_NAMES = [c.split()[0] for c in _LISTS.split(", ")]


def _word_lists(buckets: int):
    """Task side of step 1: a row of documents (bucket -1) and rows of words (bucket 0 and up).

    In a list, words stand by bucket and then in byte order; documents hold ranks by frequency, and
    ``places`` of the documents' row gives the place of each rank.
    """

    def out(docs: list, index: dict[str, int]) -> pa.RecordBatch:
        name, n = uuid.uuid4().hex, len(docs)
        raw = [w.encode("utf-8", "surrogatepass") for w in index]
        flat = np.concatenate([d[1] for d in docs])
        by_use = np.argsort(-np.bincount(flat, minlength=len(raw)), kind="stable")
        rank = np.empty(len(raw), np.int64)
        rank[by_use] = np.arange(len(raw))
        keys = [zlib.crc32(w) % buckets for w in raw]
        order = sorted(range(len(raw)), key=lambda i: (keys[i], raw[i]))
        place = np.empty(len(raw), np.uint32)
        place[order] = np.arange(len(raw))
        ids = np.array([0 if d[0] is None else d[0] for d in docs], np.int64).tobytes() + np.array([d[0] is None for d in docs], np.bool_).tobytes()
        rows = [(name, -1, n, ids, _pack_ints(np.array([len(d[1]) for d in docs], np.uint32)), _pack_ints(place[by_use]), _pack_ints(rank[flat]))]
        some, first = np.unique(np.array(keys, np.int64)[order], return_index=True)  # no more than there are words
        for b, low, high in zip(some.tolist(), first.tolist(), np.append(first, len(order))[1:].tolist(), strict=True):
            rows.append((name, b, high - low, None, None, None, _pack_words([raw[i] for i in order[low:high]])))
        kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=_LIST_NAMES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, index, held = [], {}, 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = cut(text or "")
                docs.append((doc_id, np.fromiter([index.setdefault(w, len(index)) for w in words], np.uint32, len(words))))
                held += len(text or "")
                if held >= LIST_BYTES:
                    yield out(docs, index)
                    docs, index, held = [], {}, 0
        if docs:
            yield out(docs, index)

    return task


def _encode_bucket(path: str, pattern: str):
    """Step 2: all lists' words of one bucket; each distinct word is encoded once."""

    def run(rows: pa.Table) -> pa.Table:
        enc, known, sizes, bodies = encoder(path, pattern), {}, [], []
        for n, body in zip(rows.column("n").to_pylist(), rows.column("body").to_pylist(), strict=True):
            got = []
            for w in _unpack_words(body, n):
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = np.array(enc.encode_ordinary(word_text(w.decode("utf-8", "surrogatepass"))), np.uint32).tobytes()
                got.append(ids)
            sizes.append(_pack_ints(np.array([len(g) >> 2 for g in got], np.uint32)))
            bodies.append(_pack_ints(np.frombuffer(b"".join(got), np.uint32)))
        none = pa.nulls(rows.num_rows, pa.binary())
        return pa.table([rows.column("list"), rows.column("bucket"), rows.column("n"), none, pa.array(sizes, pa.binary()), none, pa.array(bodies, pa.binary())], names=_LIST_NAMES)

    return run


_OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _assemble(path: str, digest: bool):
    """Steps 3 and 4 for one word list: ids of its documents by position, then their bytes."""

    def run(lists: pa.Table, coded: pa.Table) -> pa.Table:
        table = token_table(path)
        coded = coded.sort_by("bucket")
        sizes, bodies = coded.column("sizes").to_pylist(), coded.column("body").to_pylist()
        if bodies:
            size_of = np.concatenate([_unpack_ints(x) for x in sizes]).astype(np.int64)
            data = np.concatenate([_unpack_ints(x) for x in bodies])
            start_of = np.cumsum(size_of) - size_of
        docs = []
        for n, ids, sizes, places, body in zip(*(lists.column(c).to_pylist() for c in ("n", "ids", "sizes", "places", "body")), strict=True):
            words = _unpack_ints(places)[_unpack_ints(body)] if bodies else np.zeros(0, np.uint32)
            docs.append((np.frombuffer(ids, np.int64, n), np.frombuffer(ids, np.bool_, n, 8 * n), _unpack_ints(sizes), words))
        out = {name: [] for name in (_DIGEST if digest else _OUT).names}
        for doc_ids, nulls, sizes, flat in docs:
            at = 0
            for doc_id, null, size in zip(doc_ids.tolist(), nulls.tolist(), sizes.tolist(), strict=True):
                w = flat[at : at + size]
                at += size
                if size:
                    length = size_of[w]
                    ends = np.cumsum(length)
                    ids = data[np.repeat(start_of[w] - (ends - length), length) + np.arange(int(ends[-1]))]
                else:
                    ids = np.zeros(0, np.uint32)
                back, packed = decode_ids(ids, table), ids.astype("<u4").tobytes()
                out["doc_id"].append(None if null else doc_id)
                out["n_tokens"].append(len(ids))
                if digest:
                    out["ids_sha256"].append(hashlib.sha256(packed).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(back).hexdigest())
                else:
                    out["ids"].append(packed)
                    out["decoded"].append(back)
        return pa.table(out, schema=_DIGEST if digest else _OUT)

    return run


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """Encode and decode every text.

    Returns ``doc_id, n_tokens`` and either ``ids`` (little-endian unsigned 32-bit) and ``decoded``
    (bytes), or with ``digest`` their SHA-256 in hex as ``ids_sha256`` and ``decoded_sha256``.
    ``ranks_path`` must be readable at the same place on every node.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    buckets = parts_for(text_bytes(narrow), PART_BYTES)
    name, path = f"loom_word_lists_{uuid.uuid4().hex}", fresh_path(spark, "word-lists")
    # Bucketed by list: documents are then joined with their ids where they lie, only words and ids move.
    parts = min(MOST_BUCKETS, max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    narrow.mapInArrow(_word_lists(buckets), _LISTS).write.bucketBy(parts, "list").option("path", path).saveAsTable(name)
    lists = spark.table(name)
    coded = lists.filter("bucket >= 0").groupBy("bucket").applyInArrow(_encode_bucket(ranks_path, pattern), _LISTS)
    out = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids binary, decoded binary")
    joined = lists.filter("bucket < 0").groupBy("list").cogroup(coded.groupBy("list")).applyInArrow(_assemble(ranks_path, digest), out)
    table = written(joined, "bpe")
    spark.sql(f"DROP TABLE {name}")
    delete(spark, path)
    return table
