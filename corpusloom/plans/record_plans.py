"""Queries over training records, token sequences and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import records as R
from corpusloom.operators import sequence as S
from corpusloom.streaming import runner


def _chats(spark, d):
    turns = spark.read.parquet(f"{d}/conversations.parquet")
    return turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))


def _records(spark, d):
    """One JSON line of each conversation, with faults in six of seven."""
    c = _chats(spark, d)
    first, rest = F.get("messages", F.lit(0)), F.slice("messages", 2, F.greatest(F.size("messages"), F.lit(1)))
    robot = F.concat(F.array(F.struct(F.lit("bot").alias("role"), first["content"].alias("content"))), rest)
    blank = F.concat(F.array(F.struct(first["role"].alias("role"), F.lit(" \t").alias("content"))), rest)
    chat = lambda m: F.to_json(F.struct(m.alias("messages")))
    k = F.col("conv_id") % 7
    line = F.when(k == 1, "not json").when(k == 2, '{"question": "x"}').when(k == 3, '{"instruction": 5, "response": "ok"}').when(k == 4, chat(robot)).when(k == 5, chat(blank)).when(k == 6, chat(F.slice("messages", 1, 1))).otherwise(chat(F.col("messages")))
    return c.select("conv_id", (F.col("conv_id") + 1).alias("line_no"), line.alias("value"))


def validate_records(spark, d):
    return R.validated(_records(spark, d)).select("conv_id", "errors")


def validation_summary(spark, d):
    s = R.validation_summary(R.validated(_records(spark, d)), 5)
    return s.select("records", "valid", "ok", F.array_join(F.transform("issues", lambda i: F.concat_ws("=", i["line_number"].cast("string"), i["message"])), " | ").alias("issues"))


def _record(m):
    """JSON of messages: question and answer in two turns as a pair, others as the list."""
    first, last = F.get(m, F.lit(0)), F.get(m, F.lit(1))
    pair = F.to_json(F.struct(first["content"].alias("instruction"), last["content"].alias("response")))
    two = (F.size(m) == 2) & (first["role"] == "user") & (last["role"] == "assistant") & first["content"].isNotNull() & last["content"].isNotNull()  # JSON leaves nulls out
    return F.when(two, pair).otherwise(F.to_json(F.struct(m.alias("messages"))))


def _messages(spark, d):
    """Every conversation up to its last answer, through a record: in one of two turns the question and
    the answer, in others the list of messages."""
    c = _chats(spark, d)
    end = F.array_max(F.transform("messages", lambda m, i: F.when(m["role"] == "assistant", i + 1)))
    cut = c.select("conv_id", F.slice("messages", 1, end).alias("m")).filter("m is not null")
    return cut.select("conv_id", T.bound(F.try_parse_json(_record(F.col("m"))), lambda v: R.to_messages(v)).alias("m")).filter("m is not null")


def normalise_messages(spark, d):
    """Every turn of every conversation, through a record: messages as they are, one of two turns as a pair
    where the pair says the same."""
    c = _chats(spark, d).withColumnRenamed("messages", "m")
    m = c.select("conv_id", T.bound(F.try_parse_json(_record(F.col("m"))), lambda v: R.to_messages(v, answered=False)).alias("m"))
    return m.select("conv_id", F.posexplode("m").alias("k", "x")).select("conv_id", F.col("k").cast("bigint").alias("turn"), "x.role", "x.content")


def render_chat(spark, d):
    return _messages(spark, d).select("conv_id", R.render_chat(F.col("m")).alias("full"), R.render_chat(F.slice("m", 1, F.size("m") - 1), prompt=True).alias("prompt"))


def _ids(text):
    return F.transform(F.split(text, " "), lambda w: F.char_length(w))


def _masked(spark, d):
    both = lambda m: F.struct(_ids(R.render_chat(m)).alias("ids"), F.size(_ids(R.render_chat(F.slice(m, 1, F.size(m) - 1), prompt=True))).alias("n"))
    turns = _messages(spark, d).select("conv_id", T.bound(F.col("m"), both).alias("x"))
    cut = lambda x: F.struct(*[c.alias(n) for c, n in zip(S.mask_prompt(x["ids"], x["n"]), ("input_ids", "labels"), strict=True)])
    return turns.select("conv_id", T.bound(F.col("x"), cut).alias("y")).select("conv_id", "y.*").filter(S.trainable(F.col("labels")))


def _flat(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), " ")


def mask_prompt(spark, d):
    return _masked(spark, d).select("conv_id", _flat("input_ids").alias("input_ids"), _flat("labels").alias("labels"))


def collate(spark, d):
    rows = S.numbered(_masked(spark, d), "conv_id").withColumn("n", F.col("rank") - 1)
    b = S.collate(rows, "n", 4, 0)
    return b.select(F.col("batch_id").cast("bigint").alias("batch_id"), *[_flat(F.flatten(c)).alias(c) for c in ("input_ids", "labels", "attention_mask")])


def _token_docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", _ids(F.col("text")).alias("ids"))


def pack_blocks(spark, d):
    return S.pack(_token_docs(spark, d), "doc_id", "ids", 0).select("block_id", F.md5(_flat("input_ids").cast("binary")).alias("ids_md5"), F.expr("aggregate(labels, 0L, (a, x) -> a + x)").alias("total"))


def token_counts(spark, d):
    return S.token_counts(_token_docs(spark, d).select(F.col("doc_id").cast("string").alias("doc"), F.size("ids").alias("n")), "doc", "n")


def holdout_split(spark, d):
    return S.holdout(spark.read.parquet(f"{d}/documents.parquet").select("doc_id"), "doc_id")


def lr_schedule(spark, d):
    """The schedule of two epochs over all documents, 16 of them a step."""
    n = spark.read.parquet(f"{d}/documents.parquet").count()
    return S.learning_rates(spark, S.optimizer_steps(n, 16, 2), 1e-4).select("step", F.round("lr", 10).alias("lr"))


def loss_windows(spark, d):
    losses = spark.read.parquet(f"{d}/events.parquet").select((F.col("event_id") + 1).alias("step"), F.col("value").alias("loss"))
    return S.loss_windows(losses).select("step", F.round("loss", 6).alias("loss"))


def eval_loss(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet").select((F.col("user_id") % 17).alias("b"), (F.col("value") / 100).alias("l"))
    return S.eval_loss(e, "b", "l").select(F.round("loss", 6).alias("loss"), F.round("perplexity", 4).alias("perplexity"))


_REPLY = """CASE doc_id % 5 WHEN 0 THEN 'Here:' || chr(10) || '```json' || chr(10) || '{"examples": [{"instruction": "Q' || doc_id || '", "response": "A"}, {"instruction": "Q2", "response": "é"}]}' || chr(10) || '```' || chr(10) || 'Bye {}'
  WHEN 1 THEN 'Sure! {"examples": []} done' WHEN 2 THEN 'no object here' WHEN 3 THEN '{"other": 1}' ELSE 'x } y { z' END"""


def extract_json_reply(spark, d):
    r = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.expr(_REPLY).alias("reply"))
    return r.select("doc_id", T.strip(T.carve_json(F.col("reply"))).alias("body"), F.coalesce(F.size(R.reply_examples(F.col("reply"))), F.lit(-1)).cast("bigint").alias("examples"))


def explode_examples(spark, d):
    r = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", F.explode(R.reply_examples(F.expr(_REPLY))).alias("e"))
    return r.select("doc_id", "e.instruction", "e.response")


def run_counters(spark, d):
    r = spark.read.parquet(f"{d}/documents.parquet").select(F.coalesce(R.reply_examples(F.expr(_REPLY)), F.array().cast("array<struct<instruction:string,response:string>>")).alias("examples"))
    return runner.run_counters(r)


def chunk_examples(spark, d):
    """Chunks through the filter and a stand-in generator that answers with the chunk's length."""
    chunks = spark.read.parquet(f"{d}/documents.parquet").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("chunk"))
    done = runner.examples(chunks, lambda c: '```json\n{"examples": [{"instruction": "length?", "response": "%d"}]}\n```' % len(c))
    return done.select("path", F.explode("examples").alias("e")).select("path", "e.instruction", "e.response")


def resume_range(spark, d):
    """Chunks in path order that a run resumed at index 37 still has to do."""
    paths = spark.read.parquet(f"{d}/documents.parquet").select(F.format_string("%s/chunk_%04d.txt", "source", "doc_id").alias("path"))
    ranked = S.numbered(paths, "path").select("path", (F.col("rank") - 1).alias("index"))
    return ranked.filter("index >= 37")


_CONV = "c AS (SELECT conv_id, list(role ORDER BY turn) AS r, list(text ORDER BY turn) AS t FROM conversations GROUP BY conv_id)"
_CHAT_ERR = r"""CASE WHEN len(r) < 2 THEN '''messages'' must contain at least two messages' ELSE concat_ws('; ', CASE WHEN conv_id % 7 = 4 THEN 'messages[0].role must be one of [''assistant'', ''system'', ''user'']' END, CASE WHEN conv_id % 7 = 5 THEN 'messages[0].content must be non-empty text' END, CASE WHEN r[-1] <> 'assistant' THEN 'last message must have role ''assistant''' END) END"""
_ERR = rf"""e AS (SELECT conv_id, nullif(CASE conv_id % 7 WHEN 1 THEN 'invalid JSON: Expecting value' WHEN 2 THEN 'expected ''messages'' or ''instruction''/''response'' schema' WHEN 3 THEN '''instruction'' must be non-empty text' WHEN 6 THEN '''messages'' must contain at least two messages' ELSE {_CHAT_ERR} END, '') AS errors FROM c)"""
_MSG = "k0 AS (SELECT conv_id, r, t, list_max(list_filter(range(1, len(r) + 1), lambda i: r[i] = 'assistant')) AS k FROM c), m AS (SELECT conv_id, r[1:k] AS r, t[1:k] AS t FROM k0 WHERE k IS NOT NULL)"
_REND = "f AS (SELECT conv_id, array_to_string(list_transform(range(1, len(r) + 1), lambda i: '<|im_start|>' || r[i] || chr(10) || t[i] || '<|im_end|>' || chr(10)), '') AS full_text, array_to_string(list_transform(range(1, len(r)), lambda i: '<|im_start|>' || r[i] || chr(10) || t[i] || '<|im_end|>' || chr(10)), '') || '<|im_start|>assistant' || chr(10) AS prompt_text FROM m)"
_MASK = "k AS (SELECT conv_id, list_transform(string_split(full_text, ' '), lambda x: length(x))[1:192] AS ids, len(string_split(prompt_text, ' ')) AS n FROM f), kk AS (SELECT conv_id, ids, list_transform(range(1, len(ids) + 1), lambda i: CASE WHEN i <= n THEN -100 ELSE ids[i] END) AS labels FROM k WHERE len(ids) > least(n, 192))"
_CHATS = f"WITH {_CONV}, {_MSG}, {_REND}, {_MASK}"
_PACK = "t AS (SELECT doc_id, list_append(list_transform(string_split(text, ' '), lambda x: length(x)), 0) AS ids FROM documents), o AS (SELECT doc_id, ids, coalesce(sum(len(ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM t), u AS (SELECT CAST(p AS BIGINT) + unnest(range(0, len(ids))) AS pos, unnest(ids) AS id FROM o)"

ORACLES = {
    "validate_records": f"WITH {_CONV}, {_ERR} SELECT conv_id, errors FROM e",
    "validation_summary": f"WITH {_CONV}, {_ERR}, i AS (SELECT (conv_id + 1) || '=' || errors AS x, conv_id FROM e WHERE errors IS NOT NULL ORDER BY conv_id LIMIT 5) SELECT (SELECT count(*) FROM e) AS records, (SELECT count(*) FROM e WHERE errors IS NULL) AS valid, (SELECT count(*) > 0 AND count(*) = count(*) FILTER (errors IS NULL) FROM e) AS ok, (SELECT string_agg(x, ' | ' ORDER BY conv_id) FROM i) AS issues",
    "normalise_messages": f"WITH {_CONV} SELECT conv_id, unnest(range(0, len(r))) AS turn, unnest(r) AS role, unnest(t) AS content FROM c",
    "render_chat": f'WITH {_CONV}, {_MSG}, {_REND} SELECT conv_id, full_text AS "full", prompt_text AS prompt FROM f',
    "mask_prompt": f"{_CHATS} SELECT conv_id, array_to_string(ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels FROM kk",
    "collate": f"{_CHATS}, z AS (SELECT (row_number() OVER (ORDER BY conv_id) - 1) // 4 AS batch_id, conv_id, ids, labels FROM kk), w AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS w FROM z), v AS (SELECT batch_id, conv_id, array_to_string(list_concat(ids, list_transform(range(0, w - len(ids)), lambda i: 0)), ' ') AS a, array_to_string(list_concat(labels, list_transform(range(0, w - len(ids)), lambda i: -100)), ' ') AS b, array_to_string(list_concat(list_transform(ids, lambda i: 1), list_transform(range(0, w - len(ids)), lambda i: 0)), ' ') AS c FROM w) SELECT batch_id, string_agg(a, ' ' ORDER BY conv_id) AS input_ids, string_agg(b, ' ' ORDER BY conv_id) AS labels, string_agg(c, ' ' ORDER BY conv_id) AS attention_mask FROM v GROUP BY batch_id",
    "pack_blocks": f"WITH {_PACK} SELECT pos // 384 AS block_id, md5(string_agg(CAST(id AS VARCHAR), ' ' ORDER BY pos)) AS ids_md5, CAST(sum(id) AS BIGINT) AS total FROM u GROUP BY 1 HAVING count(*) = 384",
    "token_counts": "SELECT CAST(doc_id AS VARCHAR) AS doc, CAST(sum(len(string_split(text, ' ')) + 1) AS BIGINT) AS n_tokens FROM documents GROUP BY ROLLUP (CAST(doc_id AS VARCHAR))",
    "holdout_split": "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) <= greatest(1, CAST(floor(count(*) OVER () * 0.02) AS BIGINT)) THEN 'eval' ELSE 'train' END AS split FROM documents",
    "lr_schedule": "WITH n AS (SELECT (count(*) + 15) // 16 * 2 AS total FROM documents), w AS (SELECT total, greatest(1, CAST(floor(total * 0.03) AS BIGINT)) AS w FROM n) SELECT s AS step, round(CASE WHEN s < w THEN s / w ELSE greatest(0.0, 0.5 * (1 + cos(pi() * (s - w) / greatest(1, total - w)))) END * 1e-4, 10) AS lr FROM (SELECT total, w, unnest(range(0, total + 1)) AS s FROM w)",
    "loss_windows": "SELECT max(event_id + 1) AS step, round(avg(value), 6) AS loss FROM events GROUP BY event_id // 10",
    "eval_loss": "SELECT round(avg(m), 6) AS loss, round(exp(least(avg(m), 20)), 4) AS perplexity FROM (SELECT avg(value / 100) AS m FROM events GROUP BY user_id % 17)",
    "extract_json_reply": """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '{"examples": [{"instruction": "Q' || doc_id || '", "response": "A"}, {"instruction": "Q2", "response": "é"}]}' WHEN 1 THEN '{"examples": []}' WHEN 2 THEN 'no object here' WHEN 3 THEN '{"other": 1}' ELSE '' END AS body, CAST(CASE doc_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE -1 END AS BIGINT) AS examples FROM documents""",
    "explode_examples": "SELECT doc_id, 'Q' || doc_id AS instruction, 'A' AS response FROM documents WHERE doc_id % 5 = 0 UNION ALL SELECT doc_id, 'Q2', 'é' FROM documents WHERE doc_id % 5 = 0",
    "run_counters": "SELECT count(*) AS processed, count(*) FILTER (doc_id % 5 <> 0) AS skipped, CAST(2 * count(*) FILTER (doc_id % 5 = 0) AS BIGINT) AS examples FROM documents",
    "chunk_examples": r"SELECT CAST(doc_id AS VARCHAR) AS path, 'length?' AS instruction, CAST(length(text) AS VARCHAR) AS response FROM documents WHERE len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) >= 80 AND NOT (contains(upper(text), 'CONTENTS') OR contains(upper(text), 'COPYRIGHT') OR contains(upper(text), 'ISBN') OR contains(upper(text), 'HARPER & BROTHERS')) AND len(regexp_extract_all(text, '\d')) <= len(regexp_extract_all(text, '[A-Za-z]'))",
    "resume_range": "SELECT path, index FROM (SELECT path, row_number() OVER (ORDER BY path) - 1 AS index FROM (SELECT source || '/chunk_' || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(4, length(CAST(doc_id AS VARCHAR))) AS INTEGER), '0') || '.txt' AS path FROM documents)) WHERE index >= 37",
}
QUERIES = {name: globals()[name] for name in ORACLES}
