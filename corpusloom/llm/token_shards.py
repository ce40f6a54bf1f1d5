"""Token-id shards: per-document zstandard frames that share one trained dictionary.

A shard file holds, in ascending doc_id order, one frame per document and an index, so that one
short document is read by one seek::

    magic, dictionary SHA-256, id width, frames, index, number of documents, index offset

The index has doc ids, null flags, frame offsets (one more than documents) and id counts.  The
dictionary lies beside the shards under its hash.  Documents are dealt into ranges of (doc_id, hash of
the text) and sorted; a task streams its range into one file, holding one batch and the index.  Starts
follow from one small prefix sum over shards.

Null or empty text gives a document with only the end id.  A null doc_id sorts first.  Repeated doc
ids stay separate documents, ordered by a hash of their texts, so no id is too frequent for one shard.
An empty table gives no shard; a very long text is one frame.  Other columns are not read.  A
rewritten shard replaces its file in one rename, so a repeated task is harmless.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import fresh_path, parts_for, spans_of

MAGIC = b"LOOMTOK1"
SHARD_TEXT_BYTES = 128 << 20
LEAST_SHARD_BYTES = 4 << 20  # under this a shard is not split further for the sake of more tasks
DICT_SAMPLE_DOCS = 600  # about so many documents, chosen by hash, train the dictionary
DICT_SAMPLE_CHARS = 8 << 10  # of each of them, from a place chosen by hash
DICT_PIECE = 2 << 10
DICT_BYTES = 64 << 10
MEMO_WORDS = 1_000_000
LEVEL = 3

_tokenizers: dict = {}
_memo: dict[bytes, bytes] = {}


def tokenizer(path: str):
    """One tokenizer for a worker process; strings of special tokens in a text are ordinary text."""
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made = Tokenizer.from_file(path)
        made.encode_special_tokens = True
        _tokenizers[path] = made
        _memo.clear()
    return _tokenizers[path]


def id_width(path: str) -> str:
    return "<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4"


def encode_texts(texts: list[bytes | None], path: str, end_id: int) -> list[bytes]:
    """Serialized ids with the end id for UTF-8 texts.

    The tokenizer drops white space and lower-cases, so a text is the row of its pieces between
    blanks and line feeds with ASCII lower-cased, and each distinct piece is encoded once a worker.
    """
    tok, width = tokenizer(path), id_width(path)
    if len(_memo) > MEMO_WORDS:
        _memo.clear()
    cut = [(t or b"").lower().replace(b"\n", b" ").split(b" ") for t in texts]
    new = list({p for pieces in cut for p in pieces if p not in _memo})
    for at in range(0, len(new), 20_000):
        part = new[at : at + 20_000]
        for piece, got in zip(part, tok.encode_batch_fast([p.decode("utf-8") for p in part], add_special_tokens=False), strict=True):
            _memo[piece] = np.array(got.ids, width).tobytes()
    end, known = np.array([end_id], width).tobytes(), _memo.__getitem__
    return [b"".join(map(known, pieces)) + end for pieces in cut]


def train_dictionary(samples: list[bytes], path: str) -> bytes:
    """A dictionary trained on serialized ids: pieces of the samples, and all ids of the vocabulary in
    order, so that there is enough to train on however small the corpus is."""
    width = id_width(path)
    every = np.arange(tokenizer(path).get_vocab_size()).astype(width).tobytes()
    pieces = [s[k : k + DICT_PIECE] for s in samples for k in range(0, len(s), DICT_PIECE)]
    base = [every[k : k + 128] for k in range(0, len(every), 128)]
    return zstandard.train_dictionary(DICT_BYTES, [p for p in base + pieces if len(p) >= 8]).as_bytes()


def _compressor(dictionary: bytes):
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary))


def _decompressor(dictionary: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))


def _file(uri: str):
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_file(uri: str, body: list[bytes]) -> None:
    import uuid

    fs, path = _file(uri)
    temp = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temp) as out:
        for part in body:
            out.write(part)
    fs.move(temp, path)


def shard_index(docs: list[tuple[int | None, int, int]], low: int) -> bytes:
    """Index of one shard from (doc_id, number of ids, bytes of its frame) in order; frames start at ``low``."""
    offsets = np.zeros(len(docs) + 1, "<u8")
    np.cumsum([d[2] for d in docs], out=offsets[1:])
    offsets += low
    index = [np.array([d[0] or 0 for d in docs], "<i8").tobytes(), np.array([d[0] is None for d in docs], "?").tobytes(), offsets.tobytes(), np.array([d[1] for d in docs], "<u4").tobytes()]
    return b"".join([*index, struct.pack("<QQ", len(docs), int(offsets[-1]))])


class Shard:
    """Reader of one shard file."""

    def __init__(self, uri: str):
        fs, path = _file(uri)
        self._in = fs.open_input_file(path)
        size = self._in.size()
        head = self._in.read_at(len(MAGIC) + 32 + 4, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"{uri} is no token shard")
        (width,) = struct.unpack("<I", head[-4:])
        n, at = struct.unpack("<QQ", self._in.read_at(16, size - 16))
        self.width, self.n = f"<u{width}", n
        index = self._in.read_at(size - 16 - at, at)
        ids, nulls = np.frombuffer(index, "<i8", n), np.frombuffer(index, "?", n, 8 * n)
        self.doc_ids = [None if null else i for i, null in zip(ids.tolist(), nulls.tolist(), strict=True)]
        self.offsets = np.frombuffer(index, "<u8", n + 1, 9 * n).tolist()
        self.counts = np.frombuffer(index, "<u4", n, 9 * n + 8 * (n + 1)).tolist()
        self.dict_hash = head[len(MAGIC) : len(MAGIC) + 32]
        dict_fs, dict_path = _file(uri.rsplit("/", 1)[0] + f"/{self.dict_hash.hex()}.zdict")
        with dict_fs.open_input_file(dict_path) as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != self.dict_hash:
            raise ValueError(f"the dictionary of {uri} has been changed")
        self._d = _decompressor(dictionary)

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document: one read, one frame."""
        frame = self._in.read_at(self.offsets[k + 1] - self.offsets[k], self.offsets[k])
        return np.frombuffer(self._d.decompress(frame), self.width)


def write_shards(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode all texts and write shard files; returns the manifest ``shard, path, n_docs, n_tokens,
    start`` (one small row per shard, start = ids in all shards before it)."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-shards")
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    size = docs.agg(F.count("*"), F.sum(F.octet_length(F.col(text_col)))).first()
    texts, spread = F.col(text_col), F.xxhash64(id_col, text_col)
    place = F.pmod(F.shiftright(spread, 20), F.greatest(F.char_length(texts) - DICT_SAMPLE_CHARS, F.lit(0)) + 1).cast("int")
    sample = docs.filter(texts.isNotNull() & (F.pmod(spread, F.lit(max(1, size[0]))) < DICT_SAMPLE_DOCS)).select(F.substring(texts, place + 1, F.lit(DICT_SAMPLE_CHARS)).cast("binary").alias("text")).collect()
    dictionary = train_dictionary(sorted(encode_texts([bytes(r.text) for r in sample], tokenizer_path, end_id)), tokenizer_path)
    dict_hash, width = hashlib.sha256(dictionary).digest(), id_width(tokenizer_path)
    shards = max(1, min(parts_for(size[1] or 0, LEAST_SHARD_BYTES), 3 * spark.sparkContext.defaultParallelism), parts_for(size[1] or 0, SHARD_TEXT_BYTES))
    head = MAGIC + dict_hash + struct.pack("<I", int(width[2]))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        pack, docs, out, at = _compressor(dictionary), [], None, len(head)
        shard = TaskContext.get().partitionId()
        fs, path = _file(f"{folder}/shard-{shard:06d}.ltok")
        temp = f"{path}.{uuid.uuid4().hex}"
        for batch in batches:
            ids, raw = batch.column(0).to_pylist(), batch.column(1)
            if out is None and ids:
                out = fs.open_output_stream(temp)
                out.write(head)
            for a, b in spans_of(raw.to_pylist()):
                coded = encode_texts(raw[a:b].to_pylist(), tokenizer_path, end_id)
                for doc_id, c in zip(ids[a:b], coded, strict=True):
                    frame = pack.compress(c)
                    out.write(frame)
                    docs.append((doc_id, len(c) // int(width[2]), len(frame)))
        if out is not None:
            index = shard_index(docs, at)
            out.write(index)
            out.close()
            fs.move(temp, path)
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [f"{folder}/shard-{shard:06d}.ltok"], "n_docs": pa.array([len(docs)], pa.int64()), "n_tokens": pa.array([sum(d[1] for d in docs)], pa.int64())})

    fs, local = _file(folder)
    fs.create_dir(local, recursive=True)
    write_file(f"{folder}/{dict_hash.hex()}.zdict", [dictionary])
    ordered = narrow.withColumn("h", F.xxhash64("text")).repartitionByRange(shards, "doc_id", "h").sortWithinPartitions("doc_id", "h")
    made = sorted(ordered.select("doc_id", "text").mapInArrow(write, "shard int, path string, n_docs long, n_tokens long").collect())
    rows, start = [], 0
    for r in made:
        rows.append((*r, start))
        start += r.n_tokens
    return spark.createDataFrame(rows, "shard int, path string, n_docs long, n_tokens long, start long")


def read_shards(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """Documents of the shards: ``doc_id, start, n_tokens`` and ``ids`` (array) or, with ``digest``,
    ``ids_crc32`` over the ids as little-endian unsigned 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = Shard(path)
                step = 2_000
                for at in range(0, shard.n, step):
                    span = range(at, min(at + step, shard.n))
                    ids = [shard.ids(k) for k in span]
                    if [len(i) for i in ids] != shard.counts[at : at + step]:
                        raise ValueError(f"{path}: frames and index differ")
                    sizes = np.array([len(i) for i in ids], np.int64)
                    starts = start + np.cumsum(sizes) - sizes
                    start = int(starts[-1] + sizes[-1])
                    last = pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64()) if digest else pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array([shard.doc_ids[k] for k in span], pa.int64()), pa.array(starts), pa.array(sizes), last], names=["doc_id", "start", "n_tokens", "last"])

    last = "ids_crc32 long" if digest else "ids array<long>"
    out = manifest.select("path", "start").repartition(max(1, manifest.count())).mapInArrow(read, "doc_id long, start long, n_tokens long, last " + last.split()[1])
    return out.withColumnRenamed("last", last.split()[0])
