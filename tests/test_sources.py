import json
import random

import pytest

from corpusloom.sources import files, pdf, safetensors
from corpusloom.streaming import runner

GOOD = " ".join(["People act with purpose and choose among scarce means."] * 12)


def test_progress(spark, tmp_path):
    p = tmp_path / "state" / "progress.json"
    p.parent.mkdir()
    assert files.load_progress(p) == 0
    for text in ("{not json", "[1]", '{"last_chunk": -1}', '{"last_chunk": true}', '{"last_chunk": "3"}'):
        p.write_text(text)
        assert files.load_progress(p) == 0
    p.write_text('{"last_chunk": 99}')
    assert files.load_progress(p, 12) == 12
    files.save_progress(7, p)
    assert files.load_progress(p) == 7 and [x.name for x in p.parent.iterdir() if not x.name.endswith(".crc")] == ["progress.json"]
    for bad in (-1, True):
        with pytest.raises(ValueError):
            files.save_progress(bad, p)


def test_texts_and_listing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.txt").write_bytes(b"one\r\ntwo\rthree")
    (tmp_path / "in" / "c.md").write_text("no")
    assert [(r.doc, r.text) for r in files.whole_texts(spark, str(tmp_path / "in")).collect()] == [("b.txt", "one\ntwo\nthree")]
    assert {r.file: r.bytes for r in files.listed(spark, str(tmp_path / "in")).collect()} == {"b.txt": 14, "c.md": 2}
    rows = spark.createDataFrame([(1, "é", None)], "a int, b string, c string")
    for _ in range(2):
        files.append_jsonl(rows, str(tmp_path / "out"))
    found = [json.loads(x) for f in (tmp_path / "out").glob("*.json") for x in f.read_text("utf-8").splitlines()]
    assert found == [{"a": 1, "b": "é", "c": None}] * 2


def test_tensor_files(spark, tmp_path):
    rows = [("b", "F32", [2], b"\0" * 8, 1), ("a", "U8", [3], b"abc", 1), ("c", "U8", [1], b"z", 2)]
    t = spark.createDataFrame(rows, "name string, dtype string, shape array<bigint>, data binary, shard int")
    made = safetensors.write_shards(t, f"file://{tmp_path}/s").orderBy("shard").collect()
    assert [(r.file, r.n_tensors) for r in made] == [("model-00001.safetensors", 2), ("model-00002.safetensors", 1)]
    spark.dataSource.register(safetensors.TensorSource)
    back = spark.read.format("tensors").load(str(tmp_path / "s")).collect()
    assert sorted((r.name, r.dtype, r.shape, bytes(r.data)) for r in back) == sorted(r[:4] for r in rows)


def test_pdf_spans_of_a_page_tree(spark):
    tree = {"blocks": [{}, {"lines": [{"bbox": [72.04, 1, 2, 3], "spans": [{"size": 10, "text": "x"}, {"size": 8}]}]}]}
    assert list(pdf.spans_of_page(tree)) == [(1, 0, 0, 10.0, 72.04, "x"), (1, 0, 1, 8.0, 72.04, "")]
    rows = [("d", p, 0, n, 0, 1.0, 0.0, f"{p}{n}") for p in range(2) for n in range(2)]
    assert pdf.plain_text(spark.createDataFrame(rows, pdf.SCHEMA)).first().text == "00\n01\n10\n11"


def test_text_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2, "two"), ("a", 1, "one"), ("b", 1, "x")], "doc string, para_no int, text string")
    files.write_texts(files.corpus(rows), f"{tmp_path}/t")
    back = files.whole_texts(spark, f"{tmp_path}/t", recursive=True)
    assert sorted(r.text.rstrip("\n") for r in back.collect()) == ["one\n\ntwo", "x"]
    chunks = lambda n: spark.createDataFrame([("a", k, f"c{k}") for k in range(1, n + 1)], "doc string, chunk_no int, chunk string")
    files.write_chunks(chunks(4), f"{tmp_path}/c")
    files.write_chunks(chunks(2), f"{tmp_path}/c")
    assert files.listed(spark, f"{tmp_path}/c", "*.txt").count() == 2
    for n in (1, 2):
        files.write_json(spark.range(n), f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2


def test_small_files(spark, tmp_path):
    for name, folder in (("x", "one"), ("x", "two"), ("y", "two")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(folder)
    (tmp_path / "out").mkdir()
    assert files.copy_first(spark, ["x", "y", "z"], [f"{tmp_path}/one", f"{tmp_path}/two"], f"{tmp_path}/out") == ["x", "y"]
    assert [(tmp_path / "out" / n).read_text() for n in "xy"] == ["one", "two"]
    listed = spark.createDataFrame([("/c/models--a/snapshots/1/f",), ("/c/models--a/snapshots/2/f",), ("/c/models--a/refs/main",)], "path string")
    assert files.snapshot(listed).first().path == "/c/models--a/snapshots/2" and files.snapshot(listed.limit(0)).first().path is None


def test_pdf_files_through_a_stand_in(spark, tmp_path):
    (tmp_path / "b.pdf").write_bytes(b"p one|p two")

    class Page:
        def __init__(self, text):
            self.text = text

        def get_text(self, kind=None):
            return {"blocks": [{"lines": [{"bbox": [1.0, 0, 0, 0], "spans": [{"size": 9, "text": self.text}]}]}]} if kind else self.text

    class File(list):
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

    opened = lambda content: File(map(Page, content.decode().split("|")))
    assert [tuple(r) for r in pdf.pdf_texts(spark, str(tmp_path), opened).collect()] == [("b.pdf", "p one\np two")]
    assert [(r.page, r.text) for r in pdf.pdf_spans(spark, str(tmp_path), opened).collect()] == [(0, "p one"), (1, "p two")]


def test_settings_and_command_line(spark, tmp_path):
    from corpusloom import config, validate

    assert config.TrainingConfig.from_env({"LOOM_EPOCHS": "3", "LOOM_LEARNING_RATE": "1e-4"}) == config.TrainingConfig(epochs=3, learning_rate=1e-4)
    with pytest.raises(ValueError):
        config.TrainingConfig.from_env({"LOOM_SEED": "x"})
    (tmp_path / "good.jsonl").write_text('{"instruction":"Q","response":"A"}\n')
    (tmp_path / "bad.jsonl").write_text('{"instruction":"Q"}\n')
    assert [validate.main([f"{tmp_path}/{n}"]) for n in ("good.jsonl", "bad.jsonl", "none.jsonl")] == [0, 1, 2]


def test_vocabulary_counter(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from corpusloom.functions.tokens import vocabulary_counter

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Hello there, world", "", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(vocabulary_counter(path)("t").alias("n")).collect()
    assert [r.n for r in got] == [len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_stream_resumes(spark, tmp_path):
    chunks, out, check = tmp_path / "chunks" / "book", str(tmp_path / "out"), str(tmp_path / "check")
    chunks.mkdir(parents=True)
    (chunks / "chunk_0001.txt").write_text(GOOD)
    (chunks / "chunk_0002.txt").write_text("too short")
    reply = lambda c: '```json\n{"examples": [{"instruction": "n", "response": "%d"}]}\n```' % len(c)
    runner.run(spark, str(tmp_path / "chunks"), out, check, reply)
    (chunks / "chunk_0003.txt").write_text(GOOD + " More.")
    runner.run(spark, str(tmp_path / "chunks"), out, check, reply)
    got = sorted(int(r.response) for r in spark.read.json(out).collect())
    assert got == [len(GOOD), len(GOOD) + 6]


def test_replies_are_tried_again(spark):
    rows = spark.createDataFrame([("p", GOOD)], "path string, chunk string")
    got = runner.with_replies(rows, lambda c: "no json").first()
    assert list(got.replies) == ["no json", "no json"]
    assert runner.examples(rows, lambda c: "no json").first().examples == []


def test_texts_are_put_in_place_by_tasks(spark, tmp_path):
    kind = "doc string, text string"
    first = [("a/b: 50%", "one"), ("é", "two"), (None, "three"), ("c", None), ("c", "x")]
    files.write_texts(spark.createDataFrame(first, kind).coalesce(1), f"file://{tmp_path}/t")
    files.write_texts(spark.createDataFrame([("é", "new")], kind), f"file://{tmp_path}/t")
    found = {p.parent.name: p.read_text("utf-8") for p in (tmp_path / "t").rglob("*") if p.is_file()}  # one file each, no checksums or marks of a driver's commit
    assert sum(p.is_file() for p in (tmp_path / "t").rglob("*")) == len(found) == 4
    assert found.pop("doc=c") in ("\nx\n", "x\n\n")
    assert found == {"doc=a%2Fb%3A 50%25": "one\n", "doc=é": "new\n", "doc=__HIVE_DEFAULT_PARTITION__": "three\n"}


def test_files_are_found_and_read_by_tasks(spark, tmp_path):
    rows = [(f"d{k}", f"text {k}\r\n") for k in range(40)]
    files.write_texts(spark.createDataFrame(rows, "doc string, text string"), f"file://{tmp_path}/t", spread=7)
    assert len(list((tmp_path / "t").glob("among=*"))) == 7
    (tmp_path / "t" / "_hidden").mkdir()
    for name in ("_hidden/x.txt", ".y.txt", "z.md"):
        (tmp_path / "t" / name).write_text("no")
    for folder in (f"file://{tmp_path}/t", f"{tmp_path}/t/"):
        found = files.found(spark, folder, "*.txt")
        want = {str(p.relative_to(tmp_path)): p.stat().st_size for p in (tmp_path / "t").glob("among=*/*/*.txt")}
        assert {r.path.split(f"{tmp_path}/")[1]: r.bytes for r in found.collect()} == want and len(want) == 40
        assert sorted(r.value for r in files.texts_of(found, folder).collect()) == sorted(text + "\n" for _, text in rows)


def test_the_stream_sees_tables_of_names(spark, tmp_path):
    (tmp_path / "chunks").mkdir()
    for k in range(30):
        (tmp_path / "chunks" / f"{k}.txt").write_text(f"{GOOD} {k}")
    runner.run(spark, f"file://{tmp_path}/chunks", f"{tmp_path}/out", f"{tmp_path}/check", lambda c: '{"examples": [{"instruction": "n", "response": "%s"}]}' % c.split()[-1])
    seen = "".join(p.read_text() for p in (tmp_path / "check" / "sources").rglob("*") if p.is_file() and p.suffix != ".crc")
    assert ".parquet" in seen and ".txt" not in seen  # what the source keeps on the driver
    assert sorted(int(r.response) for r in spark.read.json(f"{tmp_path}/out").collect()) == list(range(30))


def test_text_files_are_not_indexed_by_the_driver(spark):
    import __spark_entry__

    plan = __spark_entry__.queries()["text_files"](spark, "/root/testdata/sf0.001")
    assert {p.rsplit(".", 1)[-1] for p in plan.inputFiles()} == {"parquet"}


def test_written_chunks_leave_no_shuffle_files(spark, tmp_path):
    kept = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle")}
    before = kept()
    chunks = spark.createDataFrame([("a", k, random.Random(k).randbytes(20000).hex()) for k in (2, 1, 3)], "doc string, chunk_no int, chunk string")
    files.write_chunks(chunks, f"{tmp_path}/c")
    assert not {n for n in kept() - before if n.endswith(".data")}
    assert [p.read_text()[:-1] for p in sorted((tmp_path / "c" / "doc=a").iterdir())] == [random.Random(k).randbytes(20000).hex() for k in (1, 2, 3)]


def test_chunks_in_order_are_not_moved_again(spark, tmp_path):
    chunks = spark.createDataFrame([(d, k, f"{d}{k}") for d in "ab" for k in (1, 2)], "doc string, chunk_no int, chunk string").coalesce(1)
    files.write_chunks(chunks, f"{tmp_path}/c", ordered=True, spread=3)
    got = {str(p.parent.name): [] for p in (tmp_path / "c").glob("among=*/*/*.txt")}
    for p in sorted((tmp_path / "c").glob("among=*/*/*.txt"), key=lambda p: p.name):
        got[p.parent.name].append(p.read_text().strip())
    assert got == {"doc=a": ["a1", "a2"], "doc=b": ["b1", "b2"]}
