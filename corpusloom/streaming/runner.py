"""Resumable generation of examples from chunk files, on Structured Streaming.

Each file is a chunk.  Chunks that are no learning material are not sent to the generator; a reply
that cannot be read is tried again and then counts as skipped.  The checkpoint advances only after a
batch is written, and a batch is written below its number, so a repeated batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.records import reply_examples
from corpusloom.sources import files

ATTEMPTS = 2
_REPLIES = "path string, chunk string, replies array<string>"


def with_replies(chunks: DataFrame, generate: Callable[[str], str], attempts: int = ATTEMPTS) -> DataFrame:
    """``path, chunk, replies``: the replies of all attempts needed, the usable one last."""

    def usable(reply: str) -> bool:
        import json

        body = reply.split("```")[1].removeprefix("json") if "```" in reply else reply
        low, high = body.find("{"), body.rfind("}")
        try:
            return "examples" in json.loads(body[low : high + 1] if low >= 0 and high >= 0 else body)
        except (ValueError, TypeError):
            return False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for chunk in rows["chunk"]:
                tried = []
                for _ in range(attempts):
                    try:
                        tried.append(generate(chunk))
                    except Exception as e:  # noqa: BLE001  a generator may fail in any way; the reply says how
                        tried.append(f"error: {e}")
                    if usable(tried[-1]):
                        break
                out.append(tried)
            yield rows.assign(replies=out)

    return chunks.select("path", "chunk").mapInPandas(run, _REPLIES)


def examples(chunks: DataFrame, generate: Callable[[str], str]) -> DataFrame:
    """``path, examples`` of every chunk; empty for one that is skipped."""
    good = T.is_valid_chunk(F.col("chunk"))
    replied = with_replies(chunks.filter(good), generate).select("path", F.coalesce(reply_examples(F.element_at("replies", -1)), F.array().cast("array<struct<instruction:string,response:string>>")).alias("examples"))
    return replied.unionByName(chunks.filter(~good).select("path", F.array().cast("array<struct<instruction:string,response:string>>").alias("examples")))


def run_counters(done: DataFrame) -> DataFrame:
    return done.agg(F.count("*").alias("processed"), F.count_if(F.size("examples") == 0).alias("skipped"), F.coalesce(F.sum(F.size("examples")), F.lit(0)).cast("bigint").alias("examples"))


def run(spark: SparkSession, chunks: str, out: str, checkpoint: str, generate: Callable[[str], str]) -> None:
    """Work off all chunk files that no earlier run has finished.

    Tasks list the files; names that no earlier run has listed are added to a table beside the checkpoint, and the
    stream is that table's, so its source on the driver sees tables of names and never the files.
    """
    names = f"{checkpoint.rstrip('/')}-names"
    listed = files.found(spark, chunks, "*.txt").select("path")
    if files.exists(spark, names):
        listed = listed.join(spark.read.schema("path string").parquet(names), "path", "left_anti")
    listed.write.mode("append").parquet(names)
    stream = spark.readStream.schema("path string").parquet(names)

    def write(batch: DataFrame, number: int) -> None:
        done = examples(files.texts_of(batch, chunks).withColumnRenamed("value", "chunk"), generate)
        rows = done.select("path", F.explode("examples").alias("e")).select("path", "e.instruction", "e.response")
        rows.write.mode("overwrite").json(f"{out}/batch={number}")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def compared(prompts: DataFrame, prompt: str, models: dict[str, Callable[[str], str]]) -> DataFrame:
    """``prompts`` with one column for each model, its answer or how it failed."""
    out = prompts
    for name, generate in models.items():
        out = out.withColumn(name, _answers(generate)(F.col(prompt)))
    return out


def _answers(generate: Callable[[str], str]) -> Callable:
    def one(prompt: str) -> str:
        try:
            return generate(prompt)
        except Exception as e:  # noqa: BLE001  a model may fail in any way; the answer says how
            return f"error: {e}"

    @F.pandas_udf("string")
    def answers(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for prompts in parts:
            yield prompts.map(one)

    return answers


def stalled(ages: DataFrame, limit_s: float = 1500) -> DataFrame:
    """One row: age of the newest log, and whether the run has stalled (null age: nothing to tell)."""
    return ages.agg(F.min("age_s").alias("age_s")).withColumn("stalled", F.coalesce(F.col("age_s") > limit_s, F.lit(False)))
