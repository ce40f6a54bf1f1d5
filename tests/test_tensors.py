"""Tensor files of any size, and products of matrices in tiles."""

import json
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.operators import layout as L
from corpusloom.operators import tensors as X
from corpusloom.sources import safetensors as ST

KIND = "name string, dtype string, shape array<bigint>, data binary, shard int"


def tensors(rng):
    out = []
    for k in range(9):
        shape = [int(x) for x in rng.integers(1, 12, size=2)]
        out.append((f"t{k}", "F32", shape, rng.normal(size=shape).astype(np.float32).tobytes(), k % 3 + 1))
    return [*out, ("empty", "F32", [0], b"", 2), ("bytes", "U8", [3], b"abc", 1)]


def test_sink_commits_with_an_index(spark, tmp_path):
    spark.dataSource.register(ST.TensorSource)
    rows = tensors(np.random.default_rng(1))
    frame = spark.createDataFrame(rows, KIND)
    ST.by_shard(frame).write.format("tensors").mode("overwrite").save(f"{tmp_path}/m")
    index = json.loads((tmp_path / "m" / ST.INDEX).read_text())
    assert index["metadata"]["total_size"] == sum(len(r[3]) for r in rows)
    assert index["weight_map"] == {r[0]: f"model-{r[4]:05d}.safetensors" for r in rows}
    back = spark.read.format("tensors").load(f"{tmp_path}/m").collect()
    assert sorted((r.name, r.dtype, r.shape, bytes(r.data)) for r in back) == sorted(r[:4] for r in rows)
    with pytest.raises(PySparkException, match="overwrite"):
        ST.by_shard(frame).write.format("tensors").mode("append").save(f"{tmp_path}/m")
    ST.by_shard(frame.filter("shard = 2")).write.format("tensors").mode("overwrite").save(f"{tmp_path}/m")
    assert sorted(p.name for p in (tmp_path / "m").iterdir()) == ["model-00002.safetensors", ST.INDEX]


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(ST.TensorSource)
    rows = spark.createDataFrame([("a", "U8", [1], b"x", 1), ("b", "U8", [1], None, 2)], KIND)
    with pytest.raises(PySparkException):
        rows.repartition(2, "shard").write.format("tensors").mode("overwrite").save(f"{tmp_path}/m")
    assert not (tmp_path / "m").exists() or list((tmp_path / "m").iterdir()) == []
    split = spark.createDataFrame([("a", "U8", [1], b"x", 1), ("b", "U8", [1], b"y", 1)], KIND).repartition(2, "name")
    if split.select(F.spark_partition_id()).distinct().count() == 2:
        with pytest.raises(PySparkException, match="one partition"):
            split.write.format("tensors").mode("overwrite").save(f"{tmp_path}/m")
        assert list((tmp_path / "m").iterdir()) == []


def test_tensors_in_stretches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "RANGE_BYTES", 100)
    spark.dataSource.register(ST.TensorSource)
    rows = tensors(np.random.default_rng(2))
    ST.by_shard(spark.createDataFrame(rows, KIND)).write.format("tensors").mode("overwrite").save(f"{tmp_path}/m")
    cut = spark.read.format("tensors").option("tile_bytes", "30").load(f"{tmp_path}/m")
    assert cut.agg(F.max(F.octet_length("data"))).first()[0] <= 30 and cut.count() > 40
    shard = F.regexp_extract("file", r"-(\d+)\.", 1).cast("int").alias("shard")
    ST.by_shard(cut.select("name", "dtype", "shape", "data", "at", shard)).write.format("tensors").mode("overwrite").save(f"{tmp_path}/n")
    for p in (tmp_path / "m").glob("*.safetensors"):
        assert p.read_bytes() == (tmp_path / "n" / p.name).read_bytes()


def test_merge_of_stretches_equals_the_merge(spark):
    rng = np.random.default_rng(3)
    base = [(f"l{k}.weight", "F32", [7, 5], rng.normal(size=(7, 5)).astype(np.float32).tobytes()) for k in range(3)]
    adapter = [(f"base_model.model.l{k}.lora_{x}.weight", "F32", s, rng.normal(size=s).astype(np.float32).tobytes()) for k in range(2) for x, s in (("A", [2, 5]), ("B", [7, 2]))]
    plain, own = "name string, dtype string, shape array<bigint>, data binary", spark.createDataFrame
    want = {r.name: bytes(r.data) for r in X.merge_low_rank(own(base, plain), own(adapter, plain), 2.0).collect()}
    cut = [(n, t, s, d[4 * at : 4 * at + 12], at) for n, t, s, d in base for at in range(0, 35, 3)]
    got = X.merge_low_rank(own(cut, plain + ", at bigint"), own(adapter, plain), 2.0).collect()
    for name, data in want.items():
        joined = b"".join(bytes(r.data) for r in sorted((r for r in got if r.name == name), key=lambda r: r.at))
        assert np.allclose(np.frombuffer(joined, np.float32), np.frombuffer(data, np.float32), rtol=1e-6)


@pytest.mark.parametrize("tile", [3, 256])
def test_product_of_coordinates(spark, tile):
    rng = random.Random(tile)
    cells = lambda rows, columns: {(i, j): rng.uniform(-1, 1) for i in rows for j in columns if rng.random() < 0.3}
    b, a = cells(range(-2, 14), range(10)), cells(range(10), range(8, 21))
    want = {}
    for (i, k), y in b.items():
        for (l, j), x in a.items():
            if k == l:
                want[i, j] = want.get((i, j), 0.0) + 2 * y * x
    frame = lambda m, names: spark.createDataFrame([(*k, v) for k, v in m.items()], names)
    got = X.low_rank_product(frame(a, "k long, j long, v double"), frame(b, "i long, k long, v double"), 2.0, tile).collect()
    assert {(r.i, r.j) for r in got} == set(want) and all(abs(r.v - want[r.i, r.j]) < 1e-9 for r in got)


def test_typical_length_and_titles(spark):
    rng = random.Random(9)
    lines = [(d, p, n, "x" * rng.randint(0, 30), 0.0) for d in range(20) for p in range(3) for n in range(rng.randint(1, 9))]
    got = {r.doc: r.typical for r in L.typical_length(spark.createDataFrame(lines, "doc int, page int, line_no int, text string, x0 double")).collect()}
    for d in range(20):
        sizes = sorted(len(x[3]) for x in lines if x[0] == d)
        assert got[d] == sizes[int(len(sizes) * 0.75)]
    heads = spark.createDataFrame([(1, "contents of"), (2, "con"), (3, "x index"), (4, "index"), (5, None), (4, "index")], "row int, head string")
    titles = spark.createDataFrame([("contents",), ("index",), ("index",), (None,), ("",)], "title string")
    assert sorted(r["row"] for r in L.titled(heads, "head", titles, "title").collect()) == [1, 4, 4]
    assert L.titled(heads, "head", titles.limit(0), "title").count() == 0


def test_titles_move_beginnings_only(spark):
    heads = spark.createDataFrame([(1, "capital and interest", "x"), (2, None, "y"), (3, "a capital", "z")], "row int, head string, other string")
    titles = spark.createDataFrame([("capital",), ("a c",), (None,), ("",)], "title string")
    got = L.titled(heads, "head", titles, "title")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "capital and interest", "x"), (3, "a capital", "z")]
    cut = [x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate explode" in x]
    assert cut and not any("other" in x or "row#" in x for x in cut)


def test_names_of_tensors_are_never_broadcast(spark):
    t = spark.createDataFrame([("base_model.model.l.lora_A.weight", [2, 7]), ("base_model.model.l.lora_B.weight", [4, 2])], "name string, shape array<bigint>")
    base = spark.createDataFrame([("l.weight", [5, 7])], "name string, shape array<bigint>")
    got = X.shape_mismatches(base, t)
    assert [tuple(r) for r in got.collect()] == [("l.weight", [5, 7], [4, 7])]
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
