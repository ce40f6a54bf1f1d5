"""Data source ``tensors``: files of named tensors with a JSON header, read and written.

Writing: ``df.write.format("tensors").mode("overwrite").save(folder)`` for rows ``name, dtype, shape, data,
shard`` in which rows of one shard lie together (``repartition("shard").sortWithinPartitions("shard",
"name")``, or :func:`by_shard`).  Tasks write below a folder of the job; on commit the files of the tasks
that count get their names, then the index ``model.safetensors.index.json`` (each tensor's file, and the
total of bytes) is written.  An aborted job, or a task that was lost, leaves nothing.

A file is the header's length (8 bytes, little-endian), the header (name to dtype, shape and offsets)
and the data.  Headers are read once, on the driver, and dealt out as byte ranges of about
``RANGE_BYTES``, so a file of any size is read by many tasks.  With the option ``headers`` only names,
types and shapes are read and ``data`` is null.  With the option ``tile_bytes`` a tensor comes in rows of at
most so many bytes, each with ``at``, the place of its first value, so a tensor of any size can be read;
rows with ``at`` are written as one tensor if they lie in order.
"""

from __future__ import annotations

import itertools
import json
import math
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

SCHEMA = "file string, name string, dtype string, shape array<bigint>, data binary"
RANGE_BYTES = 128 << 20


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri else (pyarrow.fs.LocalFileSystem(), uri.removeprefix("file:"))


def header_table(file: pa.NativeFile) -> pa.Table:
    """``name, dtype, shape, low, high`` of the tensors of a file, by place; ``low`` counts from its start."""
    prefix = struct.calcsize("<Q")
    length = int.from_bytes(file.read_at(prefix, 0), "little")
    named = json.loads(file.read_at(length, prefix))
    named.pop("__metadata__", None)
    base = prefix + length
    rows = [{"name": name, "dtype": t["dtype"], "shape": t["shape"], "low": base + t["data_offsets"][0], "high": base + t["data_offsets"][1]} for name, t in named.items()]
    schema = pa.schema([("name", pa.string()), ("dtype", pa.string()), ("shape", pa.list_(pa.int64())), ("low", pa.int64()), ("high", pa.int64())])
    return pa.Table.from_pylist(rows, schema).sort_by("low")


def head_bytes(tensors: list[tuple[str, str, list[int], int]], metadata: dict | None = None) -> bytes:
    """Start of a file up to the data, from (name, dtype, shape, number of bytes)."""
    header, at = ({"__metadata__": metadata} if metadata else {}), 0
    for name, dtype, shape, n in tensors:
        header[name] = {"dtype": dtype, "shape": list(shape), "data_offsets": [at, at + n]}
        at += n
    head = json.dumps(header).encode()
    return struct.pack("<Q", len(head)) + head


class _Range(InputPartition):
    """Some tensors of one file that lie next to each other."""

    def __init__(self, uri: str, rows: list[dict]):
        self.uri, self.rows = uri, rows


class _Reader(DataSourceReader):
    def __init__(self, uri: str, headers: bool, tile_bytes: int):
        self.uri, self.headers, self.tile_bytes = uri, headers, tile_bytes

    def _stretches(self, tensor: dict) -> list[dict]:
        """A tensor whole, or in stretches of whole values."""
        size = tensor["high"] - tensor["low"]
        if self.headers or not self.tile_bytes or not size:
            return [tensor | {"at": 0}]
        width = size // max(1, math.prod(tensor["shape"]))
        step = max(1, self.tile_bytes // width)
        return [tensor | {"at": at, "low": tensor["low"] + at * width, "high": min(tensor["high"], tensor["low"] + (at + step) * width)} for at in range(0, size // width, step)]

    def partitions(self) -> list[_Range]:
        fs, path = _open(self.uri)
        info = fs.get_file_info(path)
        inside = fs.get_file_info(pyarrow.fs.FileSelector(path)) if info.type == pyarrow.fs.FileType.Directory else [info]
        found = sorted(i.path for i in inside if i.type == pyarrow.fs.FileType.File and (i is info or i.path.endswith(".safetensors")))
        if not found:
            raise FileNotFoundError(f"no tensor files in {self.uri}")
        out = []
        for p in found:
            with fs.open_input_file(p) as file:
                table = header_table(file)
            first = table["low"][0].as_py() if table.num_rows else 0
            stretches = [x for r in table.to_pylist() for x in self._stretches(r)]
            for _, rows in itertools.groupby(stretches, lambda r: (r["low"] - first) // RANGE_BYTES):
                out.append(_Range(p, list(rows)))
        return out or [_Range(found[0], [])]

    def read(self, part: _Range) -> Iterator[tuple]:
        fs, _ = _open(self.uri)
        file = part.uri.rsplit("/", 1)[-1]
        if self.headers:
            yield from ((file, r["name"], r["dtype"], r["shape"], None, *([0] if self.tile_bytes else [])) for r in part.rows)
            return
        with fs.open_input_file(part.uri) as source:
            for r in part.rows:
                data = source.read_at(r["high"] - r["low"], r["low"])
                if len(data) < r["high"] - r["low"]:
                    raise OSError(f"{part.uri} ends within {r['name']}")
                yield (file, r["name"], r["dtype"], r["shape"], data, r["at"]) if self.tile_bytes else (file, r["name"], r["dtype"], r["shape"], data)


INDEX = "model.safetensors.index.json"  # fixed value
COPY_BYTES = 8 << 20


@dataclass
class _Written(WriterCommitMessage):
    """What a task has written: (shard, temporary path, names, bytes of data)."""

    shards: list[tuple[int, str, list[str], int]]


class _Shard:
    """One file in the making: data goes to a file of its own, as the header needs all sizes."""

    def __init__(self, fs: pyarrow.fs.FileSystem, folder: str, number: int):
        self.fs, self.number, self.path = fs, number, f"{folder}/{number}-{uuid.uuid4().hex}"
        self.tensors: list[tuple[str, str, list[int], int]] = []
        self.data = fs.open_output_stream(self.path + ".data")

    def add(self, name: str, dtype: str, shape: list[int], at: int, data: pa.Buffer) -> None:
        if at:
            if not self.tensors or self.tensors[-1][0] != name:
                raise ValueError(f"the stretches of {name} must lie side by side")
            self.tensors[-1] = (name, dtype, shape, self.tensors[-1][3] + data.size)
        else:
            self.tensors.append((name, dtype, shape, data.size))
        self.data.write(data)

    def close(self) -> tuple[int, str, list[str], int]:
        self.data.close()
        with self.fs.open_output_stream(self.path) as out, self.fs.open_input_stream(self.path + ".data") as data:
            out.write(head_bytes(self.tensors, {"format": "pt"}))
            while part := data.read(COPY_BYTES):
                out.write(part)
        self.fs.delete_file(self.path + ".data")
        return self.number, self.path, [t[0] for t in self.tensors], sum(t[3] for t in self.tensors)


class _Writer(DataSourceArrowWriter):
    def __init__(self, uri: str, schema: StructType, overwrite: bool):
        missing = {"name", "dtype", "shape", "data", "shard"} - set(schema.names)
        if missing:
            raise ValueError(f"tensor files need the columns {sorted(missing)}")
        self.uri, self.overwrite, self.job = uri, overwrite, f"_job-{uuid.uuid4().hex}"

    def _folder(self) -> tuple[pyarrow.fs.FileSystem, str, str]:
        fs, root = _open(self.uri)
        return fs, root, f"{root}/{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        fs, _, folder = self._folder()
        fs.create_dir(folder, recursive=True)
        done, now = [], None
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("shard", "name", "dtype", "shape", "data")]
            at = batch.schema.get_field_index("at")
            places = batch.column(at).to_pylist() if at >= 0 else [0] * batch.num_rows
            for place, shard, name, dtype, shape, data in zip(places, *columns, strict=True):
                if not (shard.is_valid and name.is_valid and data.is_valid):
                    raise ValueError("a tensor needs a shard, a name and data")
                if now is None or now.number != shard.as_py():
                    if now is not None:
                        done.append(now.close())
                    now = _Shard(fs, folder, shard.as_py())
                now.add(name.as_py(), dtype.as_py(), shape.as_py(), place, data.as_buffer())
        if now is not None:
            done.append(now.close())
        return _Written(done)

    def commit(self, messages: list[_Written | None]) -> None:
        fs, root, folder = self._folder()
        shards = sorted(s for m in messages if m is not None for s in m.shards)
        numbers = [s[0] for s in shards]
        if len(set(numbers)) < len(numbers):
            self.abort(messages)
            raise ValueError("rows of one shard must lie in one partition, side by side")
        fs.create_dir(root, recursive=True)
        old = [i.path for i in fs.get_file_info(pyarrow.fs.FileSelector(root)) if i.type == pyarrow.fs.FileType.File and (i.path.endswith(".safetensors") or i.path.endswith("/" + INDEX))]
        if old and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(f"{self.uri} holds tensor files; use the mode overwrite")
        for path in old:
            fs.delete_file(path)
        weight_map = {}
        for number, path, names, _ in shards:
            file = f"model-{number:05d}.safetensors"
            fs.move(path, f"{root}/{file}")
            weight_map |= dict.fromkeys(names, file)
        with fs.open_output_stream(f"{root}/{INDEX}") as out:  # last, so that an index names files that are there
            out.write(json.dumps({"metadata": {"total_size": sum(s[3] for s in shards)}, "weight_map": dict(sorted(weight_map.items()))}).encode())
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        fs, _, folder = self._folder()
        if fs.get_file_info(folder).type == pyarrow.fs.FileType.Directory:
            fs.delete_dir(folder)


def by_shard(tensors):
    """``tensors`` as the writer takes them: a shard in one partition, its tensors by name and place."""
    return tensors.repartition("shard").sortWithinPartitions("shard", "name", *[c for c in tensors.columns if c == "at"])


class TensorSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tensors"

    def _tile_bytes(self) -> int:
        return int(self.options.get("tile_bytes", "0"))

    def schema(self) -> str:
        return SCHEMA + (", at bigint" if self._tile_bytes() else "")

    def writer(self, schema: StructType, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], schema, overwrite)

    def reader(self, schema: StructType) -> _Reader:
        return _Reader(self.options["path"], self.options.get("headers", "false").lower() == "true", self._tile_bytes())


def write_shards(tensors, folder: str):
    """Write ``name, dtype, shape, data, shard`` in place of what is there; returns what the headers then
    tell, ``shard, file, n_tensors, bytes`` (of data)."""
    from pyspark.sql import functions as F

    from corpusloom.operators.tensors import n_bytes

    spark = tensors.sparkSession
    spark.dataSource.register(TensorSource)
    by_shard(tensors).write.format("tensors").mode("overwrite").save(folder)
    heads = spark.read.format("tensors").option("headers", "true").load(folder)
    shard = F.regexp_extract("file", r"-(\d+)\.", 1).cast("int").alias("shard")
    return heads.groupBy(shard, "file").agg(F.count("*").alias("n_tensors"), F.sum(n_bytes(F.col("dtype"), F.col("shape"))).alias("bytes"))
