"""Work on ranges of an order: next-fit, chunks, line numbers, offsets, hold-out and epochs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import records as R
from corpusloom.operators import segment
from corpusloom.operators import sequence as S
from corpusloom.sources import files


def model_shards(sizes, limit):
    out, shard, held = [], 0, None
    for n in sizes:
        if held is None or held + (n or 0) > limit:
            shard, held = shard + 1, 0
        held += n or 0
        out.append(shard)
    return out


@pytest.mark.parametrize("seed, sizes, limit", [(1, [1, 2, 3], 10), (2, [0, 0, 5, 40], 30), (3, [1], 7), (4, [0], 3), (5, [3, None, 100, 1], 1000)])
def test_next_fit_over_many_ranges(spark, seed, sizes, limit):
    rng = random.Random(seed)
    rows = [(g, i, rng.choice(sizes), "c") for g in ("a", None, "b") for i in range({"a": 400, None: 30, "b": 1}[g])]
    frame = spark.createDataFrame(rows, "g string, i int, n long, pos string")
    got = segment.next_fit(frame, ["g"], ["i"], "n", limit, part_rows=13)
    assert got.columns == ["g", "i", "n", "pos", "shard"]
    for g in ("a", None, "b"):
        own = sorted((r.i, r.shard) for r in got.collect() if r.g == g)
        assert [s for _, s in own] == model_shards([r[2] for r in rows if r[0] == g], limit)


def test_next_fit_of_nothing(spark):
    assert segment.next_fit(spark.createDataFrame([], "g string, i int, n long"), ["g"], ["i"], "n", 5).collect() == []


def test_next_fit_without_groups(spark):
    rows = spark.range(100).withColumn("n", F.lit(30))
    got = segment.next_fit(rows, [], ["id"], "n", 100, part_rows=7).collect()
    assert sorted((r.id, r.shard) for r in got) == [(i, i // 3 + 1) for i in range(100)]


def test_chunk_rows_equal_chunks(spark):
    rng = random.Random(4)
    docs = [(d, [" ".join(["w"] * rng.choice([0, 1, 5, 30, 60, 130])) + rng.choice(["", " x", "\n"]) for _ in range(rng.randint(0, 60))]) for d in [*range(40), None]]
    frame = spark.createDataFrame(docs, "doc int, p array<string>")
    want = segment.chunks(frame, "p", target=120, overlap=25)
    rows = frame.select("doc", F.posexplode("p").alias("k", "text")).repartition(7)
    got = segment.chunk_rows(rows, ["doc"], ["k"], "text", target=120, overlap=25)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and want.count() > 100


def test_lines_of_a_file_in_many_ranges(spark, tmp_path):
    rng = random.Random(7)
    ends = ["\n", "\r\n", "\r"]
    lines = ["".join(rng.choice('abcé {}":') for _ in range(rng.choice([0, 0, 3, 40, 900]))) for _ in range(3000)]
    whole = "".join(x + rng.choice(ends) for x in lines) + "x"
    (tmp_path / "a.jsonl").write_bytes(whole.encode())
    (tmp_path / "b.jsonl").write_bytes(b"one\n\n \n{}\n")
    got = files.numbered_lines(spark, f"file://{tmp_path}", split_bytes=4096)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")  # the reader's ranges stay as they are
    try:
        have = {r.path.rsplit("/", 1)[-1]: {} for r in got.select("path").distinct().collect()}
        for r in got.collect():
            have[r.path.rsplit("/", 1)[-1]][r.line_no] = r.value
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert have["b.jsonl"] == {1: "one", 2: "", 3: " ", 4: "{}"}
    assert have["a.jsonl"] == dict(enumerate(re.split("\r\n|\r|\n", whole), 1)) and got.rdd.getNumPartitions() > 20
    records = R.jsonl_records(spark, f"file://{tmp_path}", "b.*", 4)
    assert sorted((r.line_no, r.value) for r in records.collect()) == [(1, "one"), (4, "{}")]


def test_holdout_of_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 10)
    rows = spark.range(1000).select((F.col("id") % 20).alias("k"), "id")
    assert S.holdout(rows, "k").filter("split = 'eval'").count() == 20
    assert S.holdout(spark.range(900).select(F.lit("a").alias("k")), "k", 0.1).filter("split = 'eval'").count() == 90


def test_offsets_of_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 25)
    rows = spark.range(1000).select(F.when(F.col("id") < 900, 5).otherwise(F.col("id")).alias("k"), F.lit(2).alias("n"), F.col("id").alias("offset_"))
    dealt = S.ranges.ranged(rows, ["k"], 25)
    assert dealt.groupBy("part").count().agg(F.max("count")).first()[0] < 100
    assert sorted(r.offset for r in S.offsets(rows, "k", "n").collect()) == [2 * i for i in range(1000)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 1000, 1001])
def test_epochs_are_permutations(spark, monkeypatch, n):
    monkeypatch.setattr(S, "PART_ROWS", 64)
    orders = []
    for seed, epoch in ((42, 0), (42, 1), (42, 0), (43, 0)):
        rows = S.epoch_order(spark.range(n).select((F.col("id") * 3).alias("k")), "k", seed, epoch).collect()
        assert [r.position for r in rows] == list(range(n)) and sorted(r.k for r in rows) == [3 * i for i in range(n)]
        orders.append([r.k for r in rows])
    assert orders[0] == orders[2]
    if n > 100:
        assert orders[0] != orders[1] and orders[0] != orders[3] and abs(sum(a > b for a, b in zip(orders[0], orders[0][1:])) - n / 2) < n / 10
