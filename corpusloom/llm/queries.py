"""Queries over the whole driver tables, one for each training-data operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontaminate, rolling
from corpusloom.llm.bag_minhash import near_duplicates
from corpusloom.llm.byte_bpe import bpe_round_trip
from corpusloom.llm.common import documents
from corpusloom.llm.fuzzy_lines import fuzzy_lines
from corpusloom.llm.language_id import languages
from corpusloom.llm.license_scan import license_scan
from corpusloom.llm.periodic_runs import periodic_runs, with_planted_runs
from corpusloom.llm.pii_crf import personal_data
from corpusloom.llm.quality_mcd import quality
from corpusloom.llm.rank_bpe import rank_bpe
from corpusloom.llm.suffix_dedup import suffix_dedup
from corpusloom.llm.token_shards import read_shards, write_shards


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(documents(spark, sf_dir), digest=True)


def op2_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id")


def op3_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(documents(spark, sf_dir), items).drop("items")


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_shards(documents(spark, sf_dir), _tokenizer("word_bpe_49k.json"), end_id=2)
    return read_shards(manifest, digest=True)


def op6_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(documents(spark, sf_dir))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe_round_trip(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digest=True)


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return fuzzy_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_removed", kept.alias("kept_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(documents(spark, sf_dir))
    listed = F.array_join(F.transform("found", lambda f: F.concat_ws(":", f["paragraph"].cast("string"), f["family"])), ",")
    return found.select("doc_id", "n_paragraphs", "n_licensed", F.array_join("families", ",").alias("families"), listed.alias("paragraphs"))


def op11_rolling_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling.document_windows(documents(spark, sf_dir))


def op12_rank_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return rank_bpe(documents(spark, sf_dir), _tokenizer("byte_bpe_50k.json"), public_tokenizers.PATTERN, digest=True)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(with_planted_runs(documents(spark, sf_dir)), digest=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_bag_minhash": op2_bag_minhash,
    "op3_quality_mcd": op3_quality_mcd,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_shards": op5_token_shards,
    "op6_pii_crf": op6_pii_crf,
    "op7_language_id": op7_language_id,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_fuzzy_lines": op9_fuzzy_lines,
    "op10_license_scan": op10_license_scan,
    "op11_rolling_ranks": op11_rolling_ranks,
    "op12_rank_bpe": op12_rank_bpe,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op4_decontaminate": decontaminate.ORACLE,
    "op11_rolling_ranks": rolling.ORACLE,
}
