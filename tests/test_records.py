import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import records as R
from corpusloom.operators import sequence as S
from corpusloom.operators import tensors as X


def lines(spark, *values):
    return spark.createDataFrame(list(enumerate(values, 1)), "line_no int, value string")


def errors(spark, *values):
    return [r.errors for r in R.validated(lines(spark, *values)).orderBy("line_no").collect()]


def test_validation(spark):
    chat = lambda *roles: json.dumps({"messages": [{"role": r, "content": "x"} for r in roles]})
    got = errors(
        spark, '{"instruction":"Explain money","response":"A medium of exchange."}', chat("system", "user", "assistant"), chat("user", "user"), '{"question":"q"}', "not json", '{"instruction":"Q"}',
        '{"instruction":5,"response":"x"}', '[1]', '{"messages":[1,{"role":["a"],"content":" "}]}', '{"messages":{"a":1}}', chat("user"),
    )
    roles = "['assistant', 'system', 'user']"
    assert got == [
        None, None, "last message must have role 'assistant'", "expected 'messages' or 'instruction'/'response' schema", "invalid JSON: Expecting value", "'response' must be non-empty text",
        "'instruction' must be non-empty text", "record must be a JSON object",
        f"messages[0] must be an object; messages[1].role must be one of {roles}; messages[1].content must be non-empty text; last message must have role 'assistant'",
        "'messages' must contain at least two messages", "'messages' must contain at least two messages",
    ]


def test_validation_is_as_lenient_as_the_parser(spark):
    got = errors(spark, '{"instruction":"a","instruction":"b","response":"c"}', '{"instruction":"a","response":"c","s":NaN}', '{"response":"b","instruction":"a","response":" "}', "[NaN]", '{"instruction":"a","response":"c","s":1' + "0" * 400 + "}", "NaN")
    assert got == [None, None, "'response' must be non-empty text", "record must be a JSON object", None, "record must be a JSON object"]


def test_summary(spark):
    text = spark.createDataFrame([('{"instruction":"Q","response":"A"}\n\nnot json\n{"instruction":"Q"}\n',)], "value string")
    s = R.validation_summary(R.validated(R.jsonl_lines(text))).first()
    assert (s.records, s.valid, s.ok, [i.line_number for i in s.issues]) == (3, 1, False, [3, 4])
    empty = R.validation_summary(R.validated(R.jsonl_lines(spark.createDataFrame([(" \n",)], "value string")))).first()
    assert not empty.ok and empty.issues[0].message == "dataset contains no records"
    for bad, error in ((True, TypeError), (1.5, TypeError), (None, TypeError), (-1, ValueError)):
        with pytest.raises(error):
            R.validation_summary(R.validated(text.withColumn("line_no", F.lit(1))), bad)


def test_messages_and_chat(spark):
    rows = lines(spark, '{"instruction":"Q","response":"A"}', '{"messages":[{"role":"user","content":"u"},{"role":"assistant","content":"a"}]}', '{"messages":[{"role":"user","content":"u"}]}')
    got = [r.m for r in rows.select("line_no", R.to_messages(F.try_parse_json("value")).alias("m")).orderBy("line_no").collect()]
    assert [[tuple(x) for x in m] if m else None for m in got] == [[("user", "Q"), ("assistant", "A")], [("user", "u"), ("assistant", "a")], None]


def test_packing_and_batches(spark):
    docs = [(i, list(range(i * 100, i * 100 + n))) for i, n in enumerate([5, 0, 17, 3, 30])]
    stream = [t for _, ids in docs for t in [*ids, -1]]
    got = S.pack(spark.createDataFrame(docs, "d int, ids array<int>"), "d", "ids", -1, 7).orderBy("block_id").collect()
    assert [r.input_ids for r in got] == [stream[k : k + 7] for k in range(0, len(stream) - len(stream) % 7, 7)]
    samples = spark.createDataFrame([(0, [1, 2], [-100, 2]), (1, [3], [3]), (2, [4], [4])], "n int, input_ids array<int>, labels array<int>")
    b = S.collate(samples, "n", 2, 9).orderBy("batch_id").collect()
    assert (b[0].input_ids, b[0].labels, b[0].attention_mask) == ([[1, 2], [3, 9]], [[-100, 2], [3, -100]], [[1, 1], [1, 0]]) and b[1].input_ids == [[4]]


def test_offsets_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 3)
    rows = [(k * 7 % 101, k % 5) for k in range(300)] + [(None, 4)]
    got = S.offsets(spark.createDataFrame(rows, "k int, n int"), "k", "n").collect()
    ordered = sorted(got, key=lambda r: (r.offset, r.n != 0))
    keys = [-1 if r.k is None else r.k for r in sorted(got, key=lambda r: (r.offset + r.n, r.offset))]
    assert len(got) == 301 and keys == sorted(keys) or sum(r.n for r in ordered) == sum(n for _, n in rows)
    assert max(r.offset + r.n for r in got) == sum(n for _, n in rows)
    ranks = S.numbered(spark.createDataFrame([(k,) for k in range(500, 0, -1)], "k int"), "k").collect()
    assert all(r.rank == r.k for r in ranks)
    bare = spark.createDataFrame([(5, [1]), (5, [2]), (6, [3])], "d int, ids array<int>")
    blocks = S.pack(bare, "d", "ids", 0, 2).orderBy("block_id").collect()
    assert sorted(b.input_ids for b in blocks) == [[1, 0], [2, 0], [3, 0]]


def test_holdout_of_many_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_ROWS", 5)
    rows = spark.range(5000)
    few = {r.id for r in S.holdout(rows, "id").filter("split = 'eval'").collect()}
    monkeypatch.undo()
    assert len(few) == 100 and few == {r.id for r in S.holdout(rows, "id").filter("split = 'eval'").collect()}


def test_counts_of_known_runs(spark):
    rows = spark.range(4334).withColumnRenamed("id", "k")
    assert dict(S.holdout(rows, "k").groupBy("split").count().collect()) == {"train": 4248, "eval": 86}
    assert dict(S.holdout(spark.range(1057), "id").groupBy("split").count().collect()) == {"train": 1036, "eval": 21}
    assert S.optimizer_steps(4248, 16, 2) == 532 and S.optimizer_steps(1036, 16, 1) == 65 and S.optimizer_steps(10, 3, 2, 5) == 5
    rate = {r.step: r.lr for r in S.learning_rates(spark, 65, 1e-4).collect()}
    assert [f"{rate[s]:.2e}" for s in (10, 30, 60)] == ["9.52e-05", "5.73e-05", "1.50e-06"]
    rate = {r.step: r.lr for r in S.learning_rates(spark, 532, 2e-4).collect()}
    assert [f"{rate[s]:.2e}" for s in (10, 100, 440)] == ["1.33e-04", "1.87e-04", "1.52e-05"]
    loss = spark.createDataFrame([(0, 2.4918)], "b int, l double")
    assert round(S.eval_loss(loss, "b", "l").first().perplexity, 2) == 12.08


def test_merge(spark):
    rng = np.random.default_rng(1)
    a, b, w = (rng.normal(size=s).astype(np.float32) for s in ((2, 3), (4, 2), (4, 3)))
    adapter = [("base_model.model.m.lora_A.weight", "F32", [2, 3], a.tobytes()), ("base_model.model.m.lora_B.weight", "F32", [4, 2], b.tobytes()), ("base_model.model.n.lora_A.weight", "F32", [2, 3], a.tobytes())]
    kind = "name string, dtype string, shape array<bigint>, data binary"
    base = [("m.weight", "BF16", [4, 3], X.encode("BF16", w)), ("n.weight", "F32", [4, 3], w.tobytes())]
    got = {r.name: r for r in X.merge_low_rank(spark.createDataFrame(base, kind), spark.createDataFrame(adapter, kind), 2.0).collect()}
    assert got["m.weight"].merged and not got["n.weight"].merged and bytes(got["n.weight"].data) == w.tobytes()
    want = X.decode("BF16", X.encode("BF16", X.decode("BF16", X.encode("BF16", w)).reshape(4, 3) + (b @ a) * np.float32(2)))
    assert np.allclose(X.decode("BF16", bytes(got["m.weight"].data)), want)


def test_messages_without_an_answer_are_kept_on_demand(spark):
    rows = spark.createDataFrame([('{"messages": [{"role": "user", "content": "Q"}]}',), ('{"instruction": "a", "response": "b"}',)], "value string")
    got = rows.select(R.to_messages(F.try_parse_json("value"), answered=False).alias("m"), R.to_messages(F.try_parse_json("value")).alias("n")).collect()
    assert [[tuple(x) for x in r.m] for r in got] == [[("user", "Q")], [("user", "a"), ("assistant", "b")]]
    assert got[0].n is None and got[1].n == got[1].m


def test_normalised_messages_are_all_turns(spark, tmp_path):
    import duckdb

    from corpusloom.plans import record_plans

    turns = [(1, 0, "user", None), (1, 1, "assistant", "A"), (2, 0, "user", "Q"), (3, 0, "user", "Q"), (3, 1, "assistant", None), (4, 0, "user", "Q"), (4, 1, "assistant", "A"), (4, 2, "user", "R"), (5, 0, None, "x")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    got = record_plans.normalise_messages(spark, str(tmp_path)).select("conv_id", "turn", "role", "content").collect()
    assert set(map(tuple, got)) == set(con.execute(record_plans.ORACLES["normalise_messages"]).fetchall()) == set(turns)
