"""Queries through sources, sinks and runs: what is written is read back from the shared folder."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from corpusloom import validate
from corpusloom.functions.tokens import vocabulary_counter
from corpusloom.operators import records as R
from corpusloom.operators import segment
from corpusloom.operators import sequence as S
from corpusloom.operators import tensors as X
from corpusloom.plans import text_plans
from corpusloom.sources import files, safetensors
from corpusloom.streaming import runner, stages

PARTS = 4  # in which documents go to files


def _docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def _md5(c):
    return F.md5(F.col(c).cast("binary"))


def _paragraphs(spark, d):
    return _docs(spark, d).select(F.col("doc_id").cast("string").alias("doc"), F.posexplode(F.split("text", "\n")).alias("para_no", "text"))


def text_files(spark, d):
    """The lines of each document as paragraphs of its file, read back whole (sinks of texts and of
    paragraphs, files listed and read by tasks)."""
    folder = files.work_folder(spark, "texts")
    files.write_texts(files.corpus(_paragraphs(spark, d)), folder, spread=files.SPREAD)
    back = files.texts_of(files.found(spark, folder, "*.txt"), folder)
    name, text = F.regexp_extract("path", r"/doc=([^/]+)/", 1), F.regexp_replace("value", "\r\n?", "\n")
    return back.select(name.alias("doc"), F.md5(F.regexp_replace(text, r"\n\z", "").cast("binary")).alias("text_md5"))


def file_sizes(spark, d):
    """Number, total and largest size of the documents' files, from the listing alone."""
    folder = files.work_folder(spark, "sizes")
    files.write_texts(_docs(spark, d).select(F.col("doc_id").cast("string").alias("doc"), "text"), folder, spread=files.SPREAD)
    return files.found(spark, folder, "*.txt").agg(F.count("*").alias("files"), F.sum("bytes").cast("bigint").alias("bytes"), F.max("bytes").alias("largest"))


def chunk_files(spark, d):
    """One file for each chunk of a document; a second, shorter version leaves none of the first behind.  Documents
    are written in parts, so that shuffle files and new files beside the old ones are those of a part."""
    folder = files.work_folder(spark, "chunks")
    for target in (300, 2000):
        for part in range(PARTS):
            own = _paragraphs(spark, d).filter(F.pmod(F.xxhash64("doc"), F.lit(PARTS)) == part)
            files.write_chunks(segment.chunk_rows(own, ["doc"], ["para_no"], "text", target=target, overlap=0), folder, ordered=True, spread=files.SPREAD)
    listed = files.found(spark, folder, "*.txt").withColumn("doc", F.regexp_extract("path", r"/doc=([^/]+)/", 1))
    return listed.groupBy("doc").agg(F.count("*").alias("chunks"))


def chunk_table(spark, d):
    """Chunks of documents from a table with one paragraph a row."""
    cut = segment.chunk_rows(_paragraphs(spark, d), ["doc"], ["para_no"], "text", target=120, overlap=25)
    return cut.select(F.col("doc").cast("bigint").alias("doc_id"), F.col("chunk_no").cast("bigint").alias("chunk_no"), _md5("chunk").alias("chunk_md5"), "n_tokens")


def _records(spark, d):
    return _docs(spark, d).select("doc_id", F.concat(F.lit("Q"), F.col("doc_id").cast("string")).alias("instruction"), F.col("source").alias("response"))


def jsonl_lines(spark, d):
    """Records in files of a hundred, a blank line before every third; files are read in ranges of 2 KB and
    each record has the number of its line."""
    folder = files.work_folder(spark, "records")
    line = F.concat(F.when(F.col("doc_id") % 3 == 0, "\n").otherwise(""), F.to_json(F.struct("doc_id", "instruction", "response")))
    rows = _records(spark, d).select(F.expr("doc_id div 100").alias("file"), "doc_id", line.alias("value")).repartition("file").sortWithinPartitions("file", "doc_id")
    rows.select("file", "value").write.partitionBy("file").text(folder)
    checked = R.validated(R.jsonl_records(spark, folder, "*.txt", split_bytes=2048))
    doc = F.try_variant_get(F.try_parse_json("value"), "$.doc_id", "bigint").alias("doc_id")
    return checked.select(doc, "line_no", F.col("errors").isNull().alias("valid"))


def appended_records(spark, d):
    """Records appended in two turns; all of both are there."""
    folder = files.work_folder(spark, "records")
    for part in (0, 1):
        files.append_jsonl(_records(spark, d).filter(F.col("doc_id") % 2 == part), folder)
    read = F.from_json("value", "doc_id bigint, instruction string, response string")
    return R.jsonl_records(spark, folder, "*.json").select(read.alias("r")).select("r.*")


def validator_status(spark, d):
    """Exit status of the command line for the records of each source: 1 for those with a broken line (every
    hundredth document is cut short), 2 for a file that is not there."""
    folder = files.work_folder(spark, "validate")
    line = F.to_json(F.struct("instruction", "response"))
    value = F.when(F.col("doc_id") % 100 == 0, F.substring(line, 1, 10)).otherwise(line)
    _records(spark, d).select("doc_id", F.col("response").alias("source"), value.alias("value")).select("source", "value").write.partitionBy("source").text(folder)
    names = sorted(r[0] for r in _docs(spark, d).select("source").distinct().collect())
    with contextlib.redirect_stdout(io.StringIO()), contextlib.redirect_stderr(io.StringIO()):
        found = [(n, validate.main([f"{folder}/source={n}"])) for n in names] + [("missing", validate.main([f"{folder}/missing"]))]
    return spark.createDataFrame(found, "source string, status bigint")


def sidecar_files(spark, d):
    """A file of each source, copied from the first of two folders that has it: sources with a document
    whose id is divisible by seven have one in the first."""
    folder = files.work_folder(spark, "sidecars")
    docs = _docs(spark, d)
    for name, rows in (("model", docs.filter("doc_id % 7 = 0")), ("adapter", docs)):
        files.write_texts(rows.groupBy(F.col("source").alias("doc")).agg(F.concat(F.lit(f"{name} "), F.count("*").cast("string")).alias("text")), f"{folder}/{name}")
    names = [f"doc={r[0]}" for r in docs.select("source").distinct().collect()]
    copied = files.copy_first(spark, [*names, "doc=nobody"], [f"{folder}/model", f"{folder}/adapter"], f"{folder}/out")
    back = files.whole_texts(spark, f"{folder}/out", recursive=True)
    return back.select(F.regexp_extract("path", r"/doc=([^/]+)/", 1).alias("source"), F.regexp_replace("text", r"\n\z", "").alias("body"), F.lit(len(copied)).cast("bigint").alias("copied"))


def strict_records(spark, d):
    """Repeated keys, numbers without a strict form and broken lines, as the validator takes them."""
    value = F.expr("""CASE doc_id % 5 WHEN 0 THEN '{"instruction": "a", "instruction": "b", "response": "c"}' WHEN 1 THEN '{"instruction": "a", "response": "c", "score": NaN}'
      WHEN 2 THEN '{"instruction": "a", "response": "c"' WHEN 3 THEN '{"instruction": "a", "response": "b", "response": " "}' ELSE '[NaN]' END""")
    return R.validated(_docs(spark, d).select("doc_id", value.alias("value"))).select("doc_id", "errors")


def adapter_config(spark, d):
    """Scaling that the configuration files of adapters name, one adapter for each source."""
    folder = files.work_folder(spark, "config")
    made = _docs(spark, d).groupBy(F.col("source").alias("base_model")).agg(F.count("*").alias("lora_alpha"), (F.max("n_chars") % 32 + 1).alias("r"))
    files.write_json(made, folder, per_file=1)
    return X.scaling(files.config(spark, folder)).select("base_model", F.round("scaling", 6).alias("scaling"))


def newest_snapshot(spark, d):
    """The last folder by name of those that a listing holds."""
    paths = _docs(spark, d).select(F.concat(F.lit("/cache/models--a--b/snapshots/"), F.format_string("%08d", "doc_id"), F.lit("/config.json")).alias("path"))
    return files.snapshot(paths)


def _tensors(spark, d):
    t = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_name").alias("name"), F.lit("U8").alias("dtype"), F.array(F.length("n_name").cast("bigint")).alias("shape"), F.col("n_name").cast("binary").alias("data"), (F.col("n_regionkey") + 1).cast("int").alias("shard"))
    return t


def _stored_tensors(spark, d):
    folder = files.work_folder(spark, "tensors")
    spark.dataSource.register(safetensors.TensorSource)
    safetensors.by_shard(_tensors(spark, d)).write.format("tensors").mode("overwrite").save(folder)
    return folder


def tensor_index(spark, d):
    """The index that the tensor sink writes on commit: file of each tensor, and the bytes of all."""
    index = F.from_json("value", "metadata struct<total_size: bigint>, weight_map map<string, string>")
    read = spark.read.text(f"{_stored_tensors(spark, d)}/{safetensors.INDEX}", wholetext=True).select(index.alias("i"))
    return read.select("i.metadata.total_size", F.explode("i.weight_map").alias("name", "file"))


def tensor_files(spark, d):
    """Tensors written as sharded files and read back."""
    back = spark.read.format("tensors").load(_stored_tensors(spark, d))
    return back.select("file", "name", "dtype", F.col("shape")[0].alias("n"), F.col("data").cast("string").alias("body"))


def tensor_headers(spark, d):
    """Names and shapes alone, from the headers of the files."""
    return spark.read.format("tensors").option("headers", "true").load(_stored_tensors(spark, d)).select("file", "name", F.col("shape")[0].alias("n"), F.col("data").isNull().alias("bare"))


def merged_tensors(spark, d):
    """Adapter files and base files, read, paired and merged; what the merge reports."""
    one = lambda name, v: F.struct(name.alias("name"), F.lit("F32").alias("dtype"), F.array(F.lit(1).cast("bigint"), F.lit(1).cast("bigint")).alias("shape"), F.unhex(F.lit(v)).alias("data"))
    nations = spark.read.parquet(f"{d}/nation.parquet")
    layer = F.concat(F.lit("layers."), F.col("n_nationkey").cast("string"))
    base = nations.select(one(F.concat(layer, F.lit(".weight")), "0000803F").alias("t")).select("t.*")
    keys = [one(F.concat(F.lit("base_model.model."), layer, F.lit(f".lora_{x}.weight")), "00000040") for x in "AB"]
    adapter = nations.filter("n_nationkey % 2 = 0").select(F.inline(F.array(*keys)))
    return X.merge_report(X.merge_low_rank(base, adapter, 2.0))


def saved_progress(spark, d):
    """An index that is saved twice and read with a bound."""
    path = files.work_folder(spark, "state") + "/progress.json"
    missing = files.load_progress(path)
    for index in (3, _docs(spark, d).count()):
        files.save_progress(index, path)
    return spark.createDataFrame([(missing, files.load_progress(path), files.load_progress(path, 5))], "missing bigint, saved bigint, bounded bigint")


def target_files(spark, d):
    """Wanted files, and which of them are there."""
    docs = _docs(spark, d)
    wanted = docs.select(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("file"))
    there = docs.filter("n_chars > 500").select(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf")).alias("file"))
    return files.targets(wanted, there)


def usable_tokenizer(spark, d):
    """The first vocabulary, by name, that is large enough and has a chat template."""
    c = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_name").alias("name"), (F.col("c_acctbal") * 100).cast("bigint").alias("size"), (F.col("c_custkey") % 3 == 0).alias("template"))
    return files.first_usable(c, (F.col("size") >= 500_000) & F.col("template"), "name").select("name")


def epoch_shuffle(spark, d):
    """The place of every document in the orders of two epochs."""
    ids = _docs(spark, d).select("doc_id")
    orders = [S.epoch_order(ids, "doc_id", 42, e).withColumn("epoch", F.lit(e)) for e in (0, 1)]
    return orders[0].unionByName(orders[1]).select("epoch", "position", "doc_id")


def literal_paragraphs(spark, d):
    """Parts between double line feeds alone, as packing cuts them."""
    from corpusloom.functions import text as T

    text = F.replace("text", F.lit("\n"), F.lit("\n \n\n"))
    return _docs(spark, d).select("doc_id", F.size(T.literal_paragraphs(text)).cast("bigint").alias("parts"))


def generated_files(spark, d):
    """A stream over the documents' files, resumed once; every one is answered once."""
    folder = files.work_folder(spark, "stream")
    docs = _docs(spark, d).select("doc_id", F.col("doc_id").cast("string").alias("doc"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    answer = lambda c: '{"examples": [{"instruction": "length?", "response": "%d"}]}' % len(c.strip())
    for part in (0, 1):
        files.write_texts(docs.filter(F.col("doc_id") % 2 == part), f"{folder}/in", spread=files.SPREAD)
        runner.run(spark, f"{folder}/in", f"{folder}/out", f"{folder}/check", answer)
    done = spark.read.option("recursiveFileLookup", "true").schema("path string, instruction string, response string").json(f"{folder}/out")
    return done.select(F.regexp_extract("path", r"/doc=([^/]+)/", 1).alias("doc"), "response")


def tried_replies(spark, d):
    """A generator that fails at first, then answers, or never does."""

    def generate(chunk: str) -> str:
        n = int(chunk.split()[0])
        generate.seen[n] = generate.seen.get(n, 0) + 1
        if n % 3 == 0:
            raise RuntimeError("busy")
        return '{"examples": []}' if n % 3 == 1 or generate.seen[n] > 1 else "no object"

    generate.seen = {}
    chunks = _docs(spark, d).select(F.col("doc_id").cast("string").alias("path"), F.concat(F.col("doc_id").cast("string"), F.lit(" words")).alias("chunk"))
    return runner.with_replies(chunks, generate).select("path", F.size("replies").cast("bigint").alias("tries"))


def compared_models(spark, d):
    """Answers of two models side by side."""
    models = {"tuned": lambda p: p.upper(), "base": lambda p: p[::-1]}
    return runner.compared(_docs(spark, d).select("doc_id", "source"), "source", models).select("doc_id", "tuned", "base")


def gated_stages(spark, d):
    """A run whose stages are tests of the tables: an optional one fails, then a required one; the log holds
    the same."""
    log = files.work_folder(spark, "log")
    n = lambda t: spark.read.parquet(f"{d}/{t}.parquet").count()
    plan = [
        stages.Stage("documents", lambda: n("documents") > 0),
        stages.Stage("labels", lambda: n("labels") >= n("documents"), required=False),
        stages.Stage("benchmark", lambda: n("benchmark") > 0),
        stages.Stage("pages", lambda: n("pages") > n("documents") + n("events")),
        stages.Stage("train", lambda: True),
    ]
    states = stages.run_stages(spark, plan, log)
    logged = spark.read.schema("stage string, message string").json(log).select("stage", F.split("message", " ")[0].alias("state"))
    return logged.join(spark.createDataFrame(list(states.items()), "stage string, state string"), ["stage", "state"])


def stall_states(spark, d):
    """Users as runs: a watcher over the stream of their events, resumed twice, tells when one is running,
    gone (error), finished (some sign-ups) or stalled for twelve hours."""
    kind = F.expr("CASE WHEN event_type = 'error' THEN 'exit' WHEN event_type = 'signup' AND event_id % 10 = 0 THEN 'done' ELSE 'log' END")
    events = spark.read.parquet(f"{d}/events.parquet").select(F.col("user_id").cast("string").alias("run"), F.date_trunc("second", "ts").alias("at"), kind.alias("kind"))
    folder = files.work_folder(spark, "watch")
    for part, (low, high) in enumerate([("2000-01-01", "2024-01-10"), ("2024-01-10", "2024-01-20"), ("2024-01-20", "2100-01-01")]):
        events.filter(F.col("at").between(low, F.lit(high).cast("timestamp") - F.expr("interval 1 second"))).write.parquet(f"{folder}/in/part={part}")
        stream = spark.readStream.schema("run string, at timestamp, kind string, part int").parquet(f"{folder}/in")
        stages.watch(stream, f"{folder}/out", f"{folder}/check", 12 * 3600)
    return spark.read.parquet(f"{folder}/out").select("run", F.unix_timestamp("at").alias("at_s"), "state")


def run_states(spark, d):
    """What a watcher tells of runs: finished, then gone, then stalled."""
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", stages.run_state(F.col("event_id") % 7 == 0, F.col("event_id") % 5 != 0, F.when(F.col("event_id") % 3 != 0, F.col("event_id") * 10)).alias("state"))


_WORDS = '{"version": "1.0", "added_tokens": [], "normalizer": null, "pre_tokenizer": {"type": "Whitespace"}, "post_processor": null, "decoder": null, "model": {"type": "WordLevel", "vocab": {"?": 0}, "unk_token": "?"}}'


def counted_by_vocabulary(spark, d):
    """Chunks by a vocabulary's counts in the place of word counts; the vocabulary cuts words and marks."""
    cut = segment.chunk_rows(_paragraphs(spark, d), ["doc"], ["para_no"], "text", vocabulary_counter(text=_WORDS), target=120, overlap=25)
    return cut.select(F.col("doc").cast("bigint").alias("doc_id"), F.col("chunk_no").cast("bigint").alias("chunk_no"), _md5("chunk").alias("chunk_md5"), "n_tokens")


def _feistel() -> str:
    """SQL of one step of the permutation, from ``x`` to ``x``, over ``epoch, doc_id, a, b, n, k``."""
    keys = [S.Permutation(1, 42, e).keys for e in (0, 1)]
    step = "SELECT epoch, doc_id, a, b, n, k, x // b AS l, x % b AS r FROM w WHERE k = 0 OR x >= n"
    for i, key in enumerate(zip(*keys, strict=True)):
        side, other, size = ("r", "l", "b") if i % 2 else ("l", "r", "a")
        u = f"(({other} + CASE epoch WHEN 0 THEN {key[0]} ELSE {key[1]} END) % 2147483648 * 1103515245 % 2147483648)"
        step = f"SELECT epoch, doc_id, a, b, n, k, ({side} + xor({u}, {u} // 8192) * 69069 % 2147483647) % {size} AS {side}, {other} FROM ({step})"
    return f"SELECT epoch, doc_id, a, b, n, k + 1, l * b + r FROM ({step})"


_LINES = "par AS (SELECT doc_id, source, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents)"

ORACLES = {
    "chunk_files": f"WITH RECURSIVE {_LINES}, " + text_plans._CHUNKED.format(target=2000, overlap=0) + " SELECT CAST(doc_id AS VARCHAR) AS doc, count(*) AS chunks FROM chunked GROUP BY doc_id",
    "chunk_table": f"WITH RECURSIVE {_LINES}, " + text_plans._CHUNKED.format(target=120, overlap=25) + " SELECT doc_id, chunk_no, md5(c) AS chunk_md5, n_tokens FROM chunked",
    "text_files": "SELECT CAST(doc_id AS VARCHAR) AS doc, md5(replace(text, chr(10), chr(10) || chr(10))) AS text_md5 FROM documents",
    "jsonl_lines": "SELECT doc_id, CAST(sum(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END) OVER (PARTITION BY doc_id // 100 ORDER BY doc_id) AS BIGINT) AS line_no, true AS valid FROM documents",
    "appended_records": "SELECT doc_id, 'Q' || doc_id AS instruction, source AS response FROM documents",
    "strict_records": "SELECT doc_id, CASE doc_id % 5 WHEN 2 THEN 'invalid JSON: Expecting '','' delimiter' WHEN 3 THEN '''response'' must be non-empty text' WHEN 4 THEN 'record must be a JSON object' END AS errors FROM documents",
    "validator_status": "SELECT source, CAST(max(CASE WHEN doc_id % 100 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS status FROM documents GROUP BY source UNION ALL SELECT 'missing', 2",
    "sidecar_files": "SELECT source, CASE WHEN count(*) FILTER (doc_id % 7 = 0) > 0 THEN 'model ' || count(*) FILTER (doc_id % 7 = 0) ELSE 'adapter ' || count(*) END AS body, (SELECT count(DISTINCT source) FROM documents) AS copied FROM documents GROUP BY source",
    "adapter_config": "SELECT source AS base_model, round(CAST(count(*) AS DOUBLE) / (max(n_chars) % 32 + 1), 6) AS scaling FROM documents GROUP BY source",
    "newest_snapshot": "SELECT '/cache/models--a--b/snapshots/' || lpad(CAST(max(doc_id) AS VARCHAR), 8, '0') AS path FROM documents",
    "tensor_files": "SELECT printf('model-%05d.safetensors', n_regionkey + 1) AS file, n_name AS name, 'U8' AS dtype, length(n_name) AS n, n_name AS body FROM nation",
    "tensor_headers": "SELECT printf('model-%05d.safetensors', n_regionkey + 1) AS file, n_name AS name, length(n_name) AS n, true AS bare FROM nation",
    "merged_tensors": "SELECT count(*) AS tensors, CAST(4 * count(*) AS BIGINT) AS bytes, count(*) FILTER (n_nationkey % 2 = 0) AS merged FROM nation",
    "tensor_index": "SELECT (SELECT CAST(sum(length(n_name)) AS BIGINT) FROM nation) AS total_size, n_name AS name, printf('model-%05d.safetensors', n_regionkey + 1) AS file FROM nation",
    "file_sizes": "SELECT count(*) AS files, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes, max(strlen(text) + 1) AS largest FROM documents",
    "saved_progress": "SELECT CAST(0 AS BIGINT) AS missing, count(*) AS saved, CAST(least(count(*), 5) AS BIGINT) AS bounded FROM documents",
    "target_files": "SELECT doc_id || '.pdf' AS file, n_chars > 500 AS found FROM documents",
    "usable_tokenizer": "SELECT c_name AS name FROM customer WHERE CAST(trunc(c_acctbal * 100) AS BIGINT) >= 500000 AND c_custkey % 3 = 0 ORDER BY c_name LIMIT 1",
    "epoch_shuffle": f"""WITH RECURSIVE g AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM documents),
w(epoch, doc_id, a, b, n, k, x) AS (SELECT epoch, doc_id, a, (n + a - 1) // a, n, 0, row_number() OVER (PARTITION BY epoch ORDER BY doc_id) - 1 FROM documents, g, (SELECT unnest([0, 1]) AS epoch) UNION ALL {_feistel()})
SELECT epoch, x AS position, doc_id FROM w WHERE k > 0 AND x < n""",
    "literal_paragraphs": r"SELECT doc_id, CAST(len(list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || ' ' || chr(10) || chr(10)), chr(10) || chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')) AS BIGINT) AS parts FROM documents",
    "generated_files": r"WITH g AS (SELECT CAST(doc_id AS VARCHAR) AS doc, replace(text, chr(10), ' ') AS text FROM documents) SELECT doc, CAST(length(trim(text)) AS VARCHAR) AS response FROM g WHERE len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) >= 80 AND NOT (contains(upper(text), 'CONTENTS') OR contains(upper(text), 'COPYRIGHT') OR contains(upper(text), 'ISBN') OR contains(upper(text), 'HARPER & BROTHERS')) AND len(regexp_extract_all(text, '\d')) <= len(regexp_extract_all(text, '[A-Za-z]'))",
    "tried_replies": "SELECT CAST(doc_id AS VARCHAR) AS path, CAST(CASE WHEN doc_id % 3 = 1 THEN 1 ELSE 2 END AS BIGINT) AS tries FROM documents",
    "compared_models": "SELECT doc_id, upper(source) AS tuned, reverse(source) AS base FROM documents",
    "gated_stages": """WITH n AS (SELECT (SELECT count(*) FROM documents) AS d, (SELECT count(*) FROM labels) AS l, (SELECT count(*) FROM benchmark) AS b, (SELECT count(*) FROM pages) AS p, (SELECT count(*) FROM events) AS e),
s AS (SELECT unnest(['documents', 'labels', 'benchmark', 'pages', 'train']) AS stage, unnest([d > 0, l >= d, b > 0, p > d + e, true]) AS good, unnest(range(1, 6)) AS k FROM n),
f AS (SELECT min(k) AS k FROM s WHERE NOT good AND stage <> 'labels') SELECT stage, CASE WHEN s.k > f.k THEN 'skipped' WHEN good THEN 'done' ELSE 'failed' END AS state FROM s, f""",
    "stall_states": """WITH e AS (SELECT CAST(user_id AS VARCHAR) AS run, date_trunc('second', ts) AS tm, CASE WHEN event_type = 'error' THEN 'exit' WHEN event_type = 'signup' AND event_id % 10 = 0 THEN 'done' ELSE 'log' END AS kind FROM events),
o AS (SELECT run, tm, kind, row_number() OVER (PARTITION BY run ORDER BY tm, kind) AS k, max(tm) OVER () AS now FROM e),
d AS (SELECT o.* FROM o LEFT JOIN (SELECT run, min(k) AS last FROM o WHERE kind = 'done' GROUP BY run) x ON o.run = x.run WHERE last IS NULL OR k <= last),
s AS (SELECT run, tm, CASE kind WHEN 'log' THEN 'running' WHEN 'exit' THEN 'gone' ELSE 'finished' END AS state, k * 2 AS k, coalesce(lead(tm) OVER (PARTITION BY run ORDER BY k), now) AS until FROM d),
u AS (SELECT run, tm, state, k FROM s UNION ALL SELECT run, tm + INTERVAL 12 HOUR, 'stalled', k + 1 FROM s WHERE state = 'running' AND until - tm > INTERVAL 12 HOUR),
c AS (SELECT *, lag(state) OVER (PARTITION BY run ORDER BY k) AS before FROM u)
SELECT run, CAST(epoch(tm) AS BIGINT) AS at_s, state FROM c WHERE before IS NULL OR before <> state""",
    "run_states": "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'finished' WHEN event_id % 5 = 0 THEN 'gone' WHEN event_id % 3 <> 0 AND event_id * 10 > 1500 THEN 'stalled' ELSE 'running' END AS state FROM events",
    "counted_by_vocabulary": f"WITH RECURSIVE {_LINES}, " + text_plans._CHUNKED.replace(text_plans.WORDS_OF_X, r"len(regexp_extract_all(x, '[\p{{L}}\p{{M}}\p{{N}}_]+|[^\p{{L}}\p{{M}}\p{{N}}_\s]+'))").format(target=120, overlap=25) + " SELECT doc_id, chunk_no, md5(c) AS chunk_md5, n_tokens FROM chunked",
}
QUERIES = {name: globals()[name] for name in ORACLES}
