"""Queries over tensors, shards, files, sources and logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import segment
from corpusloom.operators import tensors as X
from corpusloom.sources import files


def _table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _adapter(spark, d):
    """Names in the form of adapter files; every tenth one lacks."""
    v = _table(spark, d, "embeddings").filter("vec_id % 10 <> 3")
    name = F.expr("concat('base_model.model.layers.', vec_id div 2, '.attn', CASE WHEN vec_id % 2 = 0 THEN '.lora_A.weight' ELSE '.lora_B.weight' END)")
    return v.select(name.alias("name"))


def adapter_pairs(spark, d):
    return X.adapter_pairs(_adapter(spark, d))


def unmatched_adapters(spark, d):
    base = _table(spark, d, "embeddings").filter("vec_id % 3 <> 0").select(F.expr("concat('layers.', vec_id, '.attn.weight')").alias("name"))
    return adapter_pairs(spark, d).hint("merge").join(base.hint("merge"), "name", "left_anti").select("name")


def shape_mismatches(spark, d):
    """Every part as a layer: base of its size by 7, factors whose product fits for three of four."""
    p = _table(spark, d, "part").select("p_partkey", F.col("p_size").cast("bigint").alias("n"))
    layer = F.concat(F.lit("layers."), F.col("p_partkey").cast("string"))
    base = p.select(F.concat(layer, F.lit(".weight")).alias("name"), F.array("n", F.lit(7).cast("bigint")).alias("shape"))
    key = lambda x: F.concat(F.lit("base_model.model."), layer, F.lit(f".lora_{x}.weight")).alias("name")
    wrong = F.when(F.col("p_partkey") % 4 == 0, 1).otherwise(0)
    a = p.select(key("A"), F.array(F.lit(2).cast("bigint"), F.lit(7).cast("bigint")).alias("shape"))
    b = p.select(key("B"), F.array(F.col("n") + wrong, F.lit(2).cast("bigint")).alias("shape"))
    return X.shape_mismatches(base, a.unionByName(b)).select("name", F.array_join(F.col("expected").cast("array<string>"), "x").alias("expected"), F.array_join(F.col("found").cast("array<string>"), "x").alias("found"))


def _cells(spark, d, low, i, j):
    """Coordinates of four of every twelve vectors; ``l`` numbers the twelves."""
    e = _table(spark, d, "embeddings").filter(f"vec_id % 12 between {low} and {low + 3}").select(F.expr("vec_id div 12").alias("l"), (F.col("vec_id") % 4).alias("m"), F.posexplode("embedding").alias("pos", "x"))
    return e.select(F.expr(i).cast("bigint").alias("p"), F.expr(j).cast("bigint").alias("q"), F.col("x").cast("double").alias("v"))


def lora_merge(spark, d):
    """Every twelve vectors are a layer: four rows of A, four of B and four of the base, which gets twice
    the product of B and A, over coordinates."""
    a = _cells(spark, d, 0, "l * 4 + m", "pos").toDF("k", "j", "v")
    b = _cells(spark, d, 4, "l * 4 + m", "l * 4 + pos % 4").toDF("i", "k", "v")
    base = _cells(spark, d, 8, "l * 4 + m", "pos").toDF("i", "j", "w")
    merged = base.join(X.low_rank_product(a, b, 2.0), ["i", "j"], "left")
    return merged.select("i", "j", F.round(F.col("w") + F.coalesce("v", F.lit(0.0)), 6).alias("v"))


def tensor_sizes(spark, d):
    t = _table(spark, d, "part").select("p_partkey", F.expr("array('BF16','F32','I8','F64')[p_partkey % 4]").alias("dtype"), F.array(F.col("p_size").cast("bigint"), (F.col("p_partkey") % 7 + 1).cast("bigint")).alias("shape"))
    return t.select("p_partkey", X.n_values(F.col("shape")).alias("n_values"), X.n_bytes(F.col("dtype"), F.col("shape")).cast("bigint").alias("n_bytes"))


def trainable_share(spark, d):
    t = _table(spark, d, "part").select((F.col("p_partkey") % 10 == 0).alias("trained"), (F.col("p_size") * 1000).cast("bigint").alias("n"))
    return X.trainable_share(t, F.col("trained"), "n")


def _placed(spark, d):
    return segment.next_fit(_table(spark, d, "documents").select("source", "doc_id", "n_chars"), ["source"], ["doc_id"], "n_chars", 20_000)


def shard_assign(spark, d):
    return _placed(spark, d).select("source", "doc_id", F.col("shard").cast("bigint").alias("shard"))


def series_shards(spark, d):
    """Next-fit over all documents as one series, in ranges."""
    placed = segment.next_fit(_table(spark, d, "documents").select("doc_id", "n_chars"), [], ["doc_id"], "n_chars", 5_000, part_rows=100)
    return placed.select("doc_id", F.col("shard").cast("bigint").alias("shard"))


def shard_index(spark, d):
    one = segment.next_fit(_table(spark, d, "nation").select(F.lit(0).alias("g"), F.col("n_name").alias("name"), (F.col("n_nationkey") * 100 + 7).cast("bigint").alias("size")), ["g"], ["name"], "size", 3_000)
    return X.shard_index(one).select("total_size", F.explode("weight_map").alias("name", "file"))


_HOST = "cdn.example.org"
_HTML = "CASE WHEN page_id % 3 = 0 THEN html || '<a href=\"https://cdn.example.org/files/p' || page_id || '%20x+y.pdf\">get</a> https://cdn.example.org/other.pdf' ELSE html END"


def resolve_source(spark, d):
    p = _table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("direct-"), F.col("page_id").cast("string"))).alias("pdf"), F.expr(_HTML).alias("h"))
    return p.select("page_id", F.coalesce("pdf", T.pdf_link(F.col("h"), _HOST)).alias("url"), T.search_url("https://library.example.org/search?query=", F.concat(F.lit("Book & page "), F.col("page_id").cast("string"))).alias("search"))


def pending_sources(spark, d):
    """Sources that are neither skipped nor there already."""
    p = _table(spark, d, "pages")
    name = F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(".pdf")).alias("filename")
    skip, there = p.filter("page_id in (1, 2)").select(name), p.filter("page_id % 4 = 0").select(name)
    return p.select(name).join(skip, "filename", "left_anti").join(there, "filename", "left_anti")


def manifest(spark, d):
    f = _table(spark, d, "documents").select("source", (F.col("n_chars") * 100_000).cast("bigint").alias("size"))
    per = f.rollup("source").agg(F.count("*").alias("files"), F.sum("size").cast("bigint").alias("bytes"))
    return per.select("source", "files", "bytes", T.human_bytes(F.col("bytes").cast("double")).alias("size"))


def tail_n(spark, d):
    return files.tail(_table(spark, d, "events").select(F.col("event_id").alias("line_no"), F.col("event_type").alias("value")))


def first_candidate(spark, d):
    """The first customer segment, by priority, that has a customer with enough balance."""
    c = _table(spark, d, "customer").filter("c_acctbal > 9000").groupBy("c_nationkey").agg(F.min_by("c_name", F.struct("c_mktsegment", "c_custkey")).alias("chosen"))
    return c.select(F.col("c_nationkey").cast("bigint").alias("nation"), "chosen")


def largest_shard(spark, d):
    return _placed(spark, d).groupBy("source", "shard").agg(F.sum("n_chars").alias("n")).agg(F.max("n").cast("bigint").alias("largest"), F.min("n").cast("bigint").alias("smallest"), F.count("*").alias("shards"))


_PAIRS = "ad AS (SELECT 'base_model.model.layers.' || (vec_id // 2) || '.attn' || CASE WHEN vec_id % 2 = 0 THEN '.lora_A.weight' ELSE '.lora_B.weight' END AS name FROM embeddings WHERE vec_id % 10 <> 3), pairs AS (SELECT replace(string_split(a.name, '.lora_A')[1], 'base_model.model.', '') || '.weight' AS name, a.name AS a_key, b.name AS b_key FROM ad a JOIN ad b ON replace(a.name, '.lora_A', '.lora_B') = b.name WHERE contains(a.name, '.lora_A'))"
_CELL = "u AS (SELECT vec_id, unnest(range(0, len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"
_NEXT = """d AS (SELECT source, doc_id, n_chars AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
s AS (SELECT source, doc_id, k, n, CAST(1 AS BIGINT) AS shard FROM d WHERE k = 1 UNION ALL SELECT d.source, d.doc_id, d.k, CASE WHEN s.n + d.n > 20000 THEN d.n ELSE s.n + d.n END, CASE WHEN s.n + d.n > 20000 THEN s.shard + 1 ELSE s.shard END FROM s JOIN d ON s.source = d.source AND d.k = s.k + 1)"""

ORACLES = {
    "adapter_pairs": f"WITH {_PAIRS} SELECT name, a_key, b_key FROM pairs",
    "unmatched_adapters": f"WITH {_PAIRS} SELECT name FROM pairs WHERE name NOT IN (SELECT 'layers.' || vec_id || '.attn.weight' FROM embeddings WHERE vec_id % 3 <> 0)",
    "shape_mismatches": "SELECT 'layers.' || p_partkey || '.weight' AS name, CAST(p_size AS BIGINT) || 'x7' AS expected, (CAST(p_size AS BIGINT) + 1) || 'x7' AS found FROM part WHERE p_partkey % 4 = 0",
    "lora_merge": f"WITH {_CELL}, c AS (SELECT vec_id // 12 AS l, vec_id % 12 // 4 AS s, vec_id % 4 AS m, pos, x FROM u), p AS (SELECT b.l, b.m, a.pos, sum(b.x * a.x) * 2.0 AS v FROM c b JOIN c a ON a.s = 0 AND b.s = 1 AND a.l = b.l AND a.m = b.pos % 4 GROUP BY b.l, b.m, a.pos) SELECT CAST(c.l * 4 + c.m AS BIGINT) AS i, CAST(c.pos AS BIGINT) AS j, round(x + coalesce(v, 0), 6) AS v FROM c LEFT JOIN p ON p.l = c.l AND p.m = c.m AND p.pos = c.pos WHERE s = 2",
    "tensor_sizes": "SELECT p_partkey, CAST(p_size AS BIGINT) * (p_partkey % 7 + 1) AS n_values, CAST(p_size AS BIGINT) * (p_partkey % 7 + 1) * ([2, 4, 1, 8])[p_partkey % 4 + 1] AS n_bytes FROM part",
    "trainable_share": "SELECT CAST(sum(CASE WHEN p_partkey % 10 = 0 THEN p_size * 1000 ELSE 0 END) AS BIGINT) AS trainable, CAST(sum(p_size * 1000) AS BIGINT) AS total, round(100 * sum(CASE WHEN p_partkey % 10 = 0 THEN p_size * 1000 ELSE 0 END) / sum(p_size * 1000), 4) AS percent FROM part",
    "shard_assign": f"WITH RECURSIVE {_NEXT} SELECT source, doc_id, shard FROM s",
    "series_shards": "WITH RECURSIVE d AS (SELECT doc_id, n_chars AS n, row_number() OVER (ORDER BY doc_id) AS k FROM documents), s AS (SELECT doc_id, k, n, CAST(1 AS BIGINT) AS shard FROM d WHERE k = 1 UNION ALL SELECT d.doc_id, d.k, CASE WHEN s.n + d.n > 5000 THEN d.n ELSE s.n + d.n END, CASE WHEN s.n + d.n > 5000 THEN s.shard + 1 ELSE s.shard END FROM s JOIN d ON d.k = s.k + 1) SELECT doc_id, shard FROM s",
    "shard_index": "WITH RECURSIVE d AS (SELECT n_name AS name, n_nationkey * 100 + 7 AS n, row_number() OVER (ORDER BY n_name) AS k FROM nation), s AS (SELECT name, k, n, 1 AS shard FROM d WHERE k = 1 UNION ALL SELECT d.name, d.k, CASE WHEN s.n + d.n > 3000 THEN d.n ELSE s.n + d.n END, CASE WHEN s.n + d.n > 3000 THEN s.shard + 1 ELSE s.shard END FROM s JOIN d ON d.k = s.k + 1) SELECT (SELECT CAST(sum(n) AS BIGINT) FROM d) AS total_size, name, printf('model-%05d.safetensors', shard) AS file FROM s",
    "resolve_source": f"WITH h AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'direct-' || page_id END AS pdf, {_HTML} AS h FROM pages) SELECT page_id, coalesce(pdf, CASE WHEN page_id % 3 = 0 THEN 'https://cdn.example.org/files/p' || page_id || ' x+y.pdf' END) AS url, 'https://library.example.org/search?query=Book+%26+page+' || page_id AS search FROM h",
    "pending_sources": "SELECT 'p' || page_id || '.pdf' AS filename FROM pages WHERE page_id NOT IN (1, 2) AND page_id % 4 <> 0",
    "manifest": "SELECT source, count(*) AS files, CAST(sum(n_chars * 100000) AS BIGINT) AS bytes, CASE WHEN sum(n_chars * 100000) >= 1e9 THEN printf('%.2f GB', CAST(sum(n_chars * 100000) AS DOUBLE) / 1e9) ELSE printf('%.0f MB', CAST(sum(n_chars * 100000) AS DOUBLE) / 1e6) END AS size FROM documents GROUP BY ROLLUP (source)",
    "tail_n": "SELECT event_id AS line_no, event_type AS value FROM events ORDER BY event_id DESC LIMIT 12",
    "first_candidate": "SELECT CAST(c_nationkey AS BIGINT) AS nation, first(c_name ORDER BY c_mktsegment, c_custkey) AS chosen FROM customer WHERE c_acctbal > 9000 GROUP BY c_nationkey",
    "largest_shard": f"WITH RECURSIVE {_NEXT}, g AS (SELECT s.source, s.shard, sum(d.n) AS n FROM s JOIN d ON s.doc_id = d.doc_id GROUP BY s.source, s.shard) SELECT CAST(max(n) AS BIGINT) AS largest, CAST(min(n) AS BIGINT) AS smallest, count(*) AS shards FROM g",
}
QUERIES = {name: globals()[name] for name in ORACLES}
