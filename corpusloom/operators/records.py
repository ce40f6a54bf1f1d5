"""Training records: JSONL lines, validation, normalisation to messages and chat rendering.

A record is kept as a JSON string until its schema is known; types are told from the variant, so a
number is never taken for text.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusloom.functions import text as T
from corpusloom.sources import files

ROLES = ["assistant", "system", "user"]  # fixed value, in the order of the messages about it


def jsonl_records(spark: SparkSession, path: str, suffix: str = "*", split_bytes: int = 128 << 20) -> DataFrame:
    """``path, line_no, value`` of the lines of JSONL files of any size that are not blank (blank ones count)."""
    return files.numbered_lines(spark, path, suffix, split_bytes).filter(T.strip(F.col("value")) != "")


def jsonl_lines(files: DataFrame, text: str = "value") -> DataFrame:
    """The same for whole texts in rows: lines that are not blank, with their number from 1."""
    keep = [c for c in files.columns if c != text]
    each = files.select(*keep, F.posexplode(F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")).alias("pos", "value"))
    return each.filter(T.strip(F.col("value")) != "").select(*keep, (F.col("pos") + 1).alias("line_no"), "value")


def _kind(v: Column) -> Column:
    return F.schema_of_variant(v)


def _has_text(v: Column, path: str) -> Column:
    got = F.try_variant_get(v, path, "variant")
    return F.coalesce((_kind(got) == "STRING") & (T.strip(F.try_variant_get(v, path, "string")) != ""), F.lit(False))


def record_errors(v: Column) -> Column:
    """``array<string>`` of the faults of one parsed record, in order; empty for a valid one."""
    messages = F.try_variant_get(v, "$.messages", "array<variant>")
    is_object = F.startswith(_kind(v), F.lit("OBJECT"))
    has = lambda k: F.coalesce(F.array_contains(F.json_object_keys(F.to_json(v)), k), F.lit(False))
    role = lambda m: F.when(_kind(F.try_variant_get(m, "$.role", "variant")) == "STRING", F.try_variant_get(m, "$.role", "string"))
    name = lambda i: F.concat(F.lit("messages["), i.cast("string"), F.lit("]"))

    def faults(m: Column, i: Column) -> Column:
        thing = F.coalesce(F.startswith(_kind(m), F.lit("OBJECT")), F.lit(False))
        bad_role = F.when(~F.coalesce(role(m).isin(ROLES), F.lit(False)), F.concat(name(i), F.lit(f".role must be one of {ROLES}")))
        no_text = F.when(~_has_text(m, "$.content"), F.concat(name(i), F.lit(".content must be non-empty text")))
        return F.when(~thing, F.array(F.concat(name(i), F.lit(" must be an object")))).otherwise(F.array_compact(F.array(bad_role, no_text)))

    last = F.element_at(messages, -1)
    not_answer = ~F.coalesce(F.startswith(_kind(last), F.lit("OBJECT")) & (role(last) == "assistant"), F.lit(False))
    chat = F.concat(F.flatten(F.transform(messages, faults)), F.when(not_answer, F.array(F.lit("last message must have role 'assistant'"))).otherwise(F.array().cast("array<string>")))
    pair = F.array_compact(F.array(*[F.when(~_has_text(v, f"$.{k}"), F.lit(f"'{k}' must be non-empty text")) for k in ("instruction", "response")]))
    return (
        F.when(~F.coalesce(is_object, F.lit(False)), F.array(F.lit("record must be a JSON object")))
        .when(has("messages") & (messages.isNull() | (F.size(messages) < 2)), F.array(F.lit("'messages' must contain at least two messages")))
        .when(has("messages"), chat)
        .when(has("instruction") | has("response"), pair)
        .otherwise(F.array(F.lit("expected 'messages' or 'instruction'/'response' schema")))
    )


@F.pandas_udf(StructType([StructField("body", StringType()), StructField("fault", StringType())]))
def _parsed(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The line as strict JSON, of a repeated key the last value alone, or the parser's message.  Numbers
    keep their kind and not their value, as NaN and huge ones have no strict form."""
    number = lambda _: 0
    for part in parts:
        bodies, faults = [], []
        for line in part:
            body = fault = None
            try:
                body = json.dumps(json.loads(line, parse_constant=number, parse_int=number, parse_float=number)) if line is not None else None
            except json.JSONDecodeError as e:
                fault = e.msg
            bodies.append(body)
            faults.append(fault)
        yield pd.DataFrame({"body": bodies, "fault": faults}, dtype=object)


def validated(lines: DataFrame, exact_messages: bool = True) -> DataFrame:
    """``lines`` with ``errors`` joined by ``"; "``; null for a valid record.

    ``exact_messages`` takes what Python's parser takes and words its faults as it does; without it the
    test is Spark's parser, which wants strict JSON without repeated keys, and no Python runs.
    """
    if exact_messages:
        rows = lines.withColumn("__j", _parsed("value"))
    else:
        rows = lines.withColumn("__j", F.struct(F.col("value").alias("body"), F.when(F.try_parse_json("value").isNull(), F.lit("no JSON")).alias("fault")))
    errors = T.bound(F.try_parse_json(F.col("__j.body")), lambda v: F.array_join(record_errors(v), "; "))
    fault = F.when(F.col("__j.fault").isNotNull(), F.concat(F.lit("invalid JSON: "), "__j.fault")).otherwise(F.nullif(errors, F.lit("")))
    return rows.withColumn("errors", fault).drop("__j")


def validation_summary(checked: DataFrame, max_issues: int = 20) -> DataFrame:
    """One row: ``records, valid, ok`` and the first ``max_issues`` issues in line order."""
    if isinstance(max_issues, bool) or not isinstance(max_issues, int):
        raise TypeError("max_issues must be an integer")
    if max_issues < 0:
        raise ValueError("max_issues must be non-negative")
    first = checked.filter("errors is not null").orderBy("line_no").limit(max_issues)
    issues = first.agg(F.array_sort(F.collect_list(F.struct(F.col("line_no").cast("bigint").alias("line_number"), F.col("errors").alias("message")))).alias("issues"))
    counts = checked.agg(F.count("*").alias("records"), F.count_if(F.col("errors").isNull()).alias("valid"))
    none = F.array(F.struct(F.lit(0).cast("bigint").alias("line_number"), F.lit("dataset contains no records").alias("message")))
    listed = F.when((F.col("records") == 0) & F.lit(max_issues > 0), none).otherwise(F.col("issues"))
    return counts.crossJoin(issues).select("records", "valid", ((F.col("records") > 0) & (F.col("records") == F.col("valid"))).alias("ok"), listed.alias("issues"))  # one row by one row


def to_messages(v: Column, answered: bool = True) -> Column:
    """Both record schemas as ``array<struct<role, content>>``; null for what cannot be trained on, which is
    with ``answered`` also a list whose last message is no answer."""
    kind = "array<struct<role:string,content:string>>"
    chat = F.try_variant_get(v, "$.messages", kind)
    pair = F.array(*[F.struct(F.lit(r).alias("role"), F.try_variant_get(v, f"$.{k}", "string").alias("content")) for r, k in (("user", "instruction"), ("assistant", "response"))])
    keys = F.json_object_keys(F.to_json(v))
    return F.when(F.array_contains(keys, "messages"), F.when(F.element_at(chat, -1)["role"] == "assistant", chat) if answered else chat).when(F.array_contains(keys, "instruction") & F.array_contains(keys, "response"), pair)


def render_chat(messages: Column, before: str = "<|im_start|>", after: str = "<|im_end|>", prompt: bool = False) -> Column:
    """Messages in a chat template; with ``prompt`` the opening of the assistant's turn is added."""
    turns = F.array_join(F.transform(messages, lambda m: F.concat(F.lit(before), m["role"], F.lit("\n"), m["content"], F.lit(after + "\n"))), "")
    return F.concat(turns, F.lit(f"{before}assistant\n")) if prompt else turns


def reply_examples(reply: Column) -> Column:
    """Examples of a generator's reply; null where it has no JSON object with ``examples``."""
    v = F.try_parse_json(T.carve_json(reply))
    return F.try_variant_get(v, "$.examples", "array<struct<instruction:string,response:string>>")
