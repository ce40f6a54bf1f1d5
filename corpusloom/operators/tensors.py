"""Named tensors: pairing and merging of low-rank updates, sizes and shard maps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 900 * 1024 * 1024
# Bytes of one element by type code.
WIDTHS = {"BF16": 2, "F16": 2, "F32": 4, "F64": 8, "I8": 1, "U8": 1, "I16": 2, "I32": 4, "I64": 8, "BOOL": 1}


def base_name(key: Column) -> Column:
    """Name of the tensor that an adapter key updates."""
    return F.concat(F.regexp_replace(F.substring_index(key, ".lora_A", 1), r"^base_model\.model\.", ""), F.lit(".weight"))


def _paired(adapter: DataFrame, *columns: str) -> DataFrame:
    """Down-projections with their up-projections: ``name, a_key, b_key`` and, as structs ``a`` and ``b``, the
    ``columns`` of both.  Names are as many as the tensors, so they are shuffled and never broadcast."""
    a = adapter.filter(F.contains("name", F.lit(".lora_A"))).select(F.col("name").alias("a_key"), F.replace("name", F.lit(".lora_A"), F.lit(".lora_B")).alias("b_key"), base_name(F.col("name")).alias("name"), *([F.struct(*columns).alias("a")] if columns else []))
    b = adapter.select(F.col("name").alias("b_key"), *([F.struct(*columns).alias("b")] if columns else []))
    return a.hint("merge").join(b.hint("merge"), "b_key").select("name", "a_key", "b_key", *(["a", "b"] if columns else []))


def adapter_pairs(adapter: DataFrame) -> DataFrame:
    """``name, a_key, b_key`` of all down-projections that have an up-projection."""
    return _paired(adapter)


def scaling(config: DataFrame) -> DataFrame:
    """Configurations of adapters with their ``scaling``: ``lora_alpha / r``."""
    return config.withColumn("scaling", F.col("lora_alpha").cast("double") / F.col("r"))


def trainable_share(tensors: DataFrame, trained: Column, size: str) -> DataFrame:
    """``trainable, total, percent`` of the values of all tensors."""
    own, every = F.sum(F.when(trained, F.col(size)).otherwise(0)), F.sum(size)
    return tensors.agg(own.cast("bigint").alias("trainable"), every.cast("bigint").alias("total"), F.round(100 * own / every, 4).alias("percent"))


def merge_report(merged: DataFrame) -> DataFrame:
    """``tensors, bytes, merged``: how many there are, their bytes, and how many took an update."""
    return merged.agg(F.count("*").alias("tensors"), F.sum(n_bytes(F.col("dtype"), F.col("shape"))).cast("bigint").alias("bytes"), F.count_if("merged").alias("merged"))


def n_values(shape: Column) -> Column:
    return F.aggregate(shape, F.lit(1).cast("bigint"), lambda a, x: a * x)


def n_bytes(dtype: Column, shape: Column) -> Column:
    width = F.element_at(F.create_map(*[F.lit(x) for kv in WIDTHS.items() for x in kv]), dtype)
    return n_values(shape) * width


def decode(dtype: str, raw: bytes) -> np.ndarray:
    """Values as 32-bit floats."""
    if dtype == "BF16":
        return (np.frombuffer(raw, "<u2").astype(np.uint32) << 16).view(np.float32)
    kinds = {"F16": "<f2", "F32": "<f4", "F64": "<f8", "I8": "i1", "U8": "u1", "I16": "<i2", "I32": "<i4", "I64": "<i8", "BOOL": "?"}
    return np.frombuffer(raw, kinds[dtype]).astype(np.float32)


def encode(dtype: str, values: np.ndarray) -> bytes:
    if dtype == "BF16":  # round to nearest, ties to even
        bits = values.astype(np.float32).view(np.uint32).astype(np.uint64)
        rounded = ((bits + 0x7FFF + ((bits >> 16) & 1)) >> 16).astype(np.uint16)
        return np.where(np.isnan(values), np.uint16(0x7FC0), rounded).astype("<u2").tobytes()
    kinds = {"F16": "<f2", "F32": "<f4", "F64": "<f8", "I8": "i1", "U8": "u1", "I16": "<i2", "I32": "<i4", "I64": "<i8", "BOOL": "?"}
    return values.astype(kinds[dtype]).tobytes()


def shape_mismatches(base: DataFrame, adapter: DataFrame) -> DataFrame:
    """``name, expected, found`` of the paired tensors whose product has another shape than the base; from
    names and shapes alone (``name, shape``), before anything is merged."""
    found = F.array(F.get("b.shape", F.lit(0)), F.get("a.shape", F.lit(1)))
    pairs = _paired(adapter, "shape").select("name", found.alias("found"))
    met = base.select("name", F.col("shape").alias("expected")).hint("merge").join(pairs.hint("merge"), "name")
    return met.filter(~F.col("expected").eqNullSafe(F.col("found")))


def merge_low_rank(base: DataFrame, adapter: DataFrame, scaling: float) -> DataFrame:
    """``base`` (name, dtype, shape, data) with each paired tensor plus ``scaling * B @ A``, computed in
    32-bit floats and cast back; ``merged`` tells which.  Unequal shapes are an error.

    If ``base`` has ``at`` (place of the first value, as the tensor source gives it with ``tile_bytes``), its
    rows are stretches of values, and only the rows of the product that a stretch touches are computed.
    """
    tiled = "at" in base.columns
    both = _paired(adapter, "dtype", "shape", "data").select("name", "a", "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for r in rows.itertuples(index=False):
                data = r.data
                if r.a is not None:
                    a, b = (decode(x["dtype"], x["data"]).reshape(x["shape"]) for x in (r.a, r.b))
                    if [b.shape[0], a.shape[1]] != list(r.shape):
                        raise ValueError(f"shape mismatch on {r.name}: {(b.shape[0], a.shape[1])} and {tuple(r.shape)}")
                    values = decode(r.dtype, data)
                    low, high = r.at // a.shape[1], -(-(r.at + len(values)) // a.shape[1])
                    skip = r.at - low * a.shape[1]
                    delta = ((b[low:high] @ a) * np.float32(scaling)).ravel()[skip : skip + len(values)]
                    data = encode(r.dtype, values + delta)
                out.append((r.name, r.dtype, list(r.shape), data, r.at, r.a is not None))
            yield pd.DataFrame(out, columns=["name", "dtype", "shape", "data", "at", "merged"])

    at = F.col("at") if tiled else F.lit(0).cast("bigint").alias("at")
    joined = base.select("name", "dtype", "shape", "data", at).hint("merge").join(both.hint("merge"), "name", "left")
    merged = joined.mapInPandas(run, "name string, dtype string, shape array<bigint>, data binary, at bigint, merged boolean")
    return merged if tiled else merged.drop("at")


TILE = 256  # rows and columns of a tile of a matrix of coordinates


def _tiles(cells: DataFrame, row: str, column: str, tile: int, names: tuple[str, str, str]) -> DataFrame:
    """Coordinates by tile: number of the row's and of the column's tile, and the cells within as arrays."""
    number = lambda c: F.expr(f"(`{c}` - pmod(`{c}`, {tile})) div {tile}")
    cell = F.struct(F.expr(f"int(pmod(`{row}`, {tile}))").alias("r"), F.expr(f"int(pmod(`{column}`, {tile}))").alias("c"), F.col("v").cast("double").alias("v"))
    gathered = cells.groupBy(number(row).alias(names[0]), number(column).alias(names[1])).agg(F.collect_list(cell).alias("x"))
    return gathered.select(names[0], names[1], F.struct(*[F.col(f"x.{n}").alias(n) for n in "rcv"]).alias(names[2]))


def low_rank_product(a: DataFrame, b: DataFrame, scaling: float, tile: int = TILE) -> DataFrame:
    """``i, j, v``: the matrix of the coordinates ``b(i, k, v)`` times that of ``a(k, j, v)``, times ``scaling``;
    a cell for each (i, j) that share a k.

    Coordinates are gathered into tiles, at most ``tile`` by ``tile`` cells each.  Tiles that meet in k are
    multiplied in a task, so what is shuffled for the sum are the cells of the result, once for each tile of k
    that adds to them, and not the products of single cells.
    """
    rows, columns = _tiles(b, "i", "k", tile, ("ti", "tk", "y")), _tiles(a, "k", "j", tile, ("tk", "tj", "x"))

    def dense(part: dict) -> tuple[np.ndarray, np.ndarray]:
        values, there = np.zeros((tile, tile)), np.zeros((tile, tile), np.float32)
        np.add.at(values, (part["r"], part["c"]), part["v"])
        there[part["r"], part["c"]] = 1
        return values, there

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ti, tj, y, x in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                (p, p_there), (q, q_there) = dense(y), dense(x)
                i, j = np.nonzero(p_there @ q_there)
                yield pa.RecordBatch.from_arrays([pa.array(ti * tile + i), pa.array(tj * tile + j), pa.array((p @ q)[i, j])], names=["i", "j", "v"])

    parts = rows.join(columns, "tk").select("ti", "tj", "y", "x").mapInArrow(run, "i long, j long, v double")
    return parts.groupBy("i", "j").agg((F.sum("v") * scaling).alias("v"))


def shard_index(placed: DataFrame) -> DataFrame:
    """One row ``total_size, weight_map`` from ``name, size, shard``."""
    file = F.format_string("model-%05d.safetensors", F.col("shard"))
    return placed.agg(F.sum("size").alias("total_size"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", file.alias("file"))))).alias("weight_map"))
