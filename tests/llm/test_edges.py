"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for every
operator and every stage."""

import random

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bag_minhash, byte_bpe, decontaminate, fuzzy_lines, language_id, license_scan, periodic_runs, pii_crf, quality_mcd, rank_bpe, rolling, suffix_dedup, token_shards

CLASH = "row text_ h node bag root score rejected lang_pred held_out n_lines n_removed k o t own lines key hub a b packs hit_id hit_h start length items words w __w __h __id __k __text d2 n q0_0 m0 kept feature f paragraph line first".split()
BPE, PATTERN, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("word_bpe_49k.json")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n))


def rows():
    rng = random.Random(5)
    texts = [None, "", " \n\t\n", "123 !", prose(rng, 60), prose(rng, 80), "\n".join(prose(rng, 12) for _ in range(8))]
    long = "\n".join(prose(rng, 400) for _ in range(60))  # about 130,000 characters
    out = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(50, long, "en", "s"), (51, "x" * 150_000, None, None)]
    out += [(4, texts[4], "en", "s"), (4, texts[4], "en", "s"), (4, texts[5], "en", None), (None, texts[6], None, "s"), (None, None, None, None)]
    return out


def docs(spark, of=None):
    frame = spark.createDataFrame(rows() if of is None else of, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.char_length("text").cast("long"))
    return frame.withColumns({c: F.lit(c) for c in CLASH})


def items(spark):
    return spark.createDataFrame([(1, "seven quite unusual words that nobody else has"), (2, None)], "item_id long, text string").withColumns({c: F.lit(c) for c in CLASH})


OPERATORS = {
    "suffix": lambda s, d: suffix_dedup.suffix_dedup(d, digest=True),
    "minhash": lambda s, d: bag_minhash.near_duplicates(d),
    "quality": lambda s, d: quality_mcd.quality(d),
    "decontaminate": lambda s, d: decontaminate.decontaminate(d, items(s)),
    "shards": lambda s, d: token_shards.read_shards(token_shards.write_shards(d, WORDS, 2), digest=True),
    "pii": lambda s, d: pii_crf.personal_data(d),
    "language": lambda s, d: language_id.languages(d),
    "bpe": lambda s, d: byte_bpe.bpe_round_trip(d, BPE, PATTERN, digest=True),
    "lines": lambda s, d: fuzzy_lines.fuzzy_lines(d),
    "licence": lambda s, d: license_scan.license_scan(d),
    "windows": lambda s, d: rolling.document_windows(d, (3600,)),
    "ranks": lambda s, d: rank_bpe.rank_bpe(d, VOCABULARY, PATTERN, digest=True),
    "runs": lambda s, d: periodic_runs.periodic_runs(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_every_row(spark, name):
    got = OPERATORS[name](spark, docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows())


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, docs(spark, [])).collect() == []


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage(spark, tmp_path, name):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    full = docs(spark)
    got = stage(spark, full, str(tmp_path))
    kept = got.collect()
    none = stage(spark, docs(spark, []), str(tmp_path))
    assert none.collect() == []
    if name != "tokens":
        assert got.columns == full.columns == none.columns
        assert all(r[c] == c for r in kept for c in CLASH)
    ids = sorted(str(r.doc_id) for r in kept)
    want = {
        "language": ["4", "4", "4", "5", "50", "51", "6", "None"],  # what has a letter, as no language is learned well enough to reject
        "decontamination": sorted(str(r[0]) for r in rows()),
        "tokens": sorted(str(r[0]) for r in rows()),
    }
    if name in want and name != "language":
        assert ids == want[name]
    if name == "line_dedup":  # texts without lines stay, of equal lines the first place does
        assert {"0", "1", "2", "None"} <= set(ids) and ids.count("4") == 2
    if name == "near_dedup":  # without words: two nulls, an empty and a blank text
        assert sum(not (r.text or "").strip() for r in kept) == 4 and len(kept) == 4 + len({r[1] for r in rows() if (r[1] or "").strip()})
